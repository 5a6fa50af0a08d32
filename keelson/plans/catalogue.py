"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, over the driver's tables (mapped by
:mod:`keelson.sources.driver_tables`). Queries that exercise a sink write
into a fresh folder under the shared checkpoint folder and read back.

Every query reads whole tables; the only ``limit`` is the sample query,
where the limit is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson import schemas
from keelson.functions import expressions as X
from keelson.operators import checks, rollup, summary
from keelson.operators.enrich import enrich_left_join, merge_source
from keelson.operators.merge import ACTION, INSERT, KEEP, NOOP, UPDATE, action_counts, change_flags, merge_plan
from keelson.plans import jobs
from keelson.session import work_dir
from keelson.sinks import bucketed, publish, tables
from keelson.sinks import versions as version_sink
from keelson.sinks.merge_partitions import merge_into_partitions
from keelson.sources import external, versions
from keelson.sources import driver_tables as D

# Fixed values used to build object-store URIs from customer keys.
URI_CONTAINERS = 7
URI_ACCOUNT = "lakeacct"


# -- inputs ------------------------------------------------------------------
def _src(spark, sf):
    return merge_source(D.merge_staging(spark, sf), D.known_customers(spark, sf), D.MERGE_AS_OF)


def _merged(spark, sf):
    return merge_plan(D.existing_target(spark, sf), _src(spark, sf), jobs.FINAL_MERGE)


def _even(col):
    return col % 2 == 0


def _odd(col):
    return col % 2 == 1


# -- merge (J2, M1-M6, K11) ------------------------------------------------------
def merge_upsert(spark, sf):
    return _merged(spark, sf).select(*D.FINAL_COLUMNS)


def _by_action(action):
    def q(spark, sf):
        return _merged(spark, sf).where(F.col(ACTION) == action).select(*D.FINAL_COLUMNS)

    return q


def _order_no(col: str = "transaction_id"):
    return F.substring(F.col(col), 5, 20).cast("bigint")


def _repeated(spark, sf):
    """Target and source with duplicate keys: target rows of every
    third order appear twice; orders divisible by 8 get a second source
    row whose compare columns are NULL (it never qualifies, but it makes
    the key's source rows differ, so the exact pair-free path runs). Orders
    with remainder 4 get two such rows, one with the customer's name and no
    country, one the other way round."""
    tgt = D.existing_target(spark, sf)
    tgt2 = tgt.unionByName(tgt.where(_order_no() % 3 == 0))
    src = _src(spark, sf)
    dup = src.where(_order_no() % 8 == 0).select(
        "transaction_id",
        "customer_id",
        F.lit(None).cast("string").alias("customer_name"),
        "country",
        F.lit(None).cast("decimal(38,9)").alias("amount"),
        "transaction_date",
        F.lit(None).cast("string").alias("status"),
        "last_updated",
    )
    shift = src.where(_order_no() % 8 == 4).withColumn("amount", F.lit(None).cast("decimal(38,9)")).withColumn("status", F.lit(None).cast("string"))
    no_name = shift.withColumn("customer_name", F.lit(None).cast("string"))
    no_country = shift.withColumn("country", F.lit(None).cast("string"))
    return tgt2, src.unionByName(dup).unionByName(no_name).unionByName(no_country)


def merge_duplicate_keys(spark, sf):
    """The merge with duplicate keys on both sides."""
    return merge_plan(*_repeated(spark, sf), jobs.FINAL_MERGE).select(*D.FINAL_COLUMNS, ACTION)


def merge_action_counts(spark, sf):
    return action_counts(_merged(spark, sf))


def merge_affected_rows(spark, sf):
    """The affected-row count observed while the merge is written."""
    wh = jobs.Warehouse.create(spark, work_dir(spark, "affected"))
    tables.full_refresh(D.merge_staging(spark, sf), wh.name(wh.staging))
    tables.full_refresh(D.known_customers(spark, sf), wh.name(wh.customers))
    tables.create_table_if_not_exists(spark, wh.name(wh.final), schemas.FINAL_TABLE, path=f"{wh.root}/final-v0")
    tables.insert_append(D.existing_target(spark, sf), wh.name(wh.final), schemas.required(schemas.FINAL_TABLE))
    m = jobs.merge_into_final(spark, wh, D.MERGE_AS_OF)
    return spark.createDataFrame([(int(m["affected_rows"]),)], "affected_rows bigint")


def merge_delta(spark, sf):
    """A small source, the staged transactions that are pending: target rows that its key
    filter rules out are kept without a shuffle."""
    src = merge_source(D.staging(spark, sf), D.known_customers(spark, sf), D.MERGE_AS_OF)
    return merge_plan(D.existing_target(spark, sf), src.where(F.col("status") == "pending"), jobs.FINAL_MERGE)


def merge_partitioned(spark, sf):
    """The merge into a table partitioned by quarter: only quarters with a change are rewritten."""
    quarter = F.concat(F.year("transaction_date"), F.lit("Q"), F.quarter("transaction_date"))
    target = D.existing_target(spark, sf).withColumn("quarter", quarter)
    wh = jobs.Warehouse.create(spark, work_dir(spark, "partitioned"))
    name = wh.name(wh.final)
    tables.create_table_if_not_exists(spark, name, target.schema, path=f"{wh.root}/final", partitioned_by=["quarter"])
    tables.insert_append(target.hint("rebalance", "quarter"), name, schemas.required(schemas.FINAL_TABLE))
    merge_into_partitions(spark, name, _src(spark, sf).withColumn("quarter", quarter), jobs.FINAL_MERGE)
    return spark.table(name).select(*D.FINAL_COLUMNS)


def merge_bucketed(spark, sf):
    """Staging and target bucketed by the merge key, the master by its own."""
    wh = jobs.Warehouse.create(spark, work_dir(spark, "bucketed"))
    jobs.stage_bucketed(spark, wh, D.merge_staging(spark, sf), D.known_customers(spark, sf))
    bucketed.replace_rows(D.existing_target(spark, sf), wh.name(wh.final))
    jobs.merge_bucketed(spark, wh, D.MERGE_AS_OF)
    return spark.table(wh.name(wh.final))


# -- enrichment, projections, predicates (J1, P1-P5, F2, C1, C2) ------------------
def merge_source_q(spark, sf):
    return merge_source(D.staging(spark, sf), D.known_customers(spark, sf), D.MERGE_AS_OF)


def enriched_star(spark, sf):
    return enrich_left_join(D.staging(spark, sf), D.known_customers(spark, sf))


def enrich_left_join_q(spark, sf):
    return enrich_left_join(D.staging(spark, sf), D.known_customers(spark, sf)).select(
        "transaction_id", "customer_id", "customer_name"
    )


def change_detect(spark, sf):
    return change_flags(D.existing_target(spark, sf), _src(spark, sf), jobs.FINAL_MERGE)


def change_detect_repeated(spark, sf):
    """The change test with repeated keys on both sides: a row per target row."""
    return change_flags(*_repeated(spark, sf), jobs.FINAL_MERGE)


def cast_numeric(spark, sf):
    return D.staging(spark, sf).select("transaction_id", X.to_numeric("amount").alias("amount"))


def to_date_q(spark, sf):
    return D.staging(spark, sf).select("transaction_id", X.to_date_strict("transaction_date").alias("transaction_date"))


def not_null_check(spark, sf):
    return checks.not_null_rows(D.staging(spark, sf), "transaction_id").select("transaction_id")


def pk_duplicates(spark, sf):
    doubled = summary.union_versions(D.staging(spark, sf), D.staging(spark, sf, where=F.col("o_orderkey") % 9 == 0))
    return checks.duplicate_keys(doubled, "transaction_id")


# -- summaries, samples (A1-A3, O1, O2) ----------------------------------------
def status_summary(spark, sf):
    return summary.status_summary(_merged(spark, sf).select(*D.FINAL_COLUMNS))


def status_totals(spark, sf):
    return summary.status_totals(_merged(spark, sf).select(*D.FINAL_COLUMNS))


def row_count(spark, sf):
    parts = {
        "orders": D.table(spark, sf, "orders"),
        "customer": D.table(spark, sf, "customer"),
        "nation": D.table(spark, sf, "nation"),
        "transactions_staging": D.staging(spark, sf),
        "customers": D.customers(spark, sf),
        "final_table": D.existing_target(spark, sf),
    }
    out = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def sample_rows(spark, sf):
    return summary.sample_rows(D.staging(spark, sf), 10, ["transaction_id"])


def summary_by_version(spark, sf):
    """A2 kept up by version: an overwrite, summed up, then a second one and an append."""
    path = work_dir(spark, "lake")
    version_sink.commit_overwrite(D.staging(spark, sf, where=_odd(F.col("o_orderkey"))), path)
    rollup.catch_up(spark, path, jobs.STATUS_ROLLUP)
    version_sink.commit_overwrite(D.staging(spark, sf, where=_even(F.col("o_orderkey"))), path)
    version_sink.commit_append(D.staging(spark, sf, where=_odd(F.col("o_orderkey"))), path)
    return rollup.summary(spark, path, jobs.STATUS_ROLLUP).select("status", "total", F.col("sum_amount").alias("total_amount"))


# -- writes (K3, K4, K6, K7) ------------------------------------------------------
def seed_if_empty(spark, sf):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "seed"))
    name = wh.name(wh.customers)
    cust = D.customers(spark, sf)
    tables.create_table_if_not_exists(spark, name, schemas.CUSTOMERS)
    for _ in range(2):
        tables.seed_if_empty(spark, cust, name, schemas.CUSTOMERS.names, schemas.required(schemas.CUSTOMERS))
    return spark.table(name)


def insert_append(spark, sf):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "append"))
    name = wh.name(wh.customers)
    cust = D.customers(spark, sf)
    tables.create_table_if_not_exists(spark, name, schemas.CUSTOMERS)
    for _ in range(2):
        tables.insert_append(cust, name, schemas.required(schemas.CUSTOMERS))
    return spark.table(name)


def staging_full_refresh(spark, sf):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "refresh"))
    name = wh.name(wh.staging)
    for _ in range(2):
        tables.full_refresh(D.staging(spark, sf), name)
    return spark.table(name)


def snapshot_export(spark, sf):
    folder = work_dir(spark, "export")
    tables.export_snapshot(D.staging(spark, sf), folder)
    return spark.read.parquet(folder)


def export_range_scan(spark, sf):
    """A sorted export, scanned for one year."""
    folder = work_dir(spark, "export")
    tables.export_sorted(D.staging(spark, sf), folder, "transaction_date", rows_per_file=20_000)
    view = external.parquet_view(spark, "transactions_sorted", folder)
    return view.where(F.col("transaction_date").between("1995-01-01", "1995-12-31"))


def external_parquet_scan(spark, sf):
    folder = work_dir(spark, "export")
    tables.export_snapshot(D.staging(spark, sf), folder)
    return external.parquet_view(spark, "transactions_snapshot", folder)


def external_table_refresh(spark, sf):
    """A managed table of the staged rows gives way to an external
    table over their exported snapshot."""
    wh = jobs.Warehouse.create(spark, work_dir(spark, "replace"))
    name = wh.name("transactions")
    tables.full_refresh(D.staging(spark, sf), name)
    folder = work_dir(spark, "export")
    tables.export_snapshot(spark.table(name), folder)
    return external.parquet_external_table(spark, name, folder)


# -- versioned table (S1-S5, K1, K2, U1) -----------------------------------------
def _two_commits(spark, sf) -> str:
    path = work_dir(spark, "lake")
    version_sink.commit_overwrite(D.staging(spark, sf, where=_even(F.col("o_orderkey"))), path)
    version_sink.commit_append(D.staging(spark, sf, where=_odd(F.col("o_orderkey"))), path)
    return path


def commit_append(spark, sf):
    return versions.snapshot(spark, _two_commits(spark, sf))


def snapshot_latest(spark, sf):
    path = work_dir(spark, "lake")
    version_sink.commit_overwrite(D.staging(spark, sf, where=_odd(F.col("o_orderkey"))), path)
    version_sink.commit_overwrite(D.staging(spark, sf, where=_even(F.col("o_orderkey"))), path)
    version_sink.commit_append(D.staging(spark, sf, where=_odd(F.col("o_orderkey"))), path)
    return versions.snapshot(spark, path)


def commit_overwrite(spark, sf):
    path = work_dir(spark, "lake")
    version_sink.commit_overwrite(D.staging(spark, sf, where=_even(F.col("o_orderkey"))), path)
    version_sink.commit_overwrite(D.staging(spark, sf, where=_odd(F.col("o_orderkey"))), path)
    return versions.snapshot(spark, path)


def external_lake_scan(spark, sf):
    return external.lake_view(spark, "transactions_lake", _two_commits(spark, sf))


def external_lake_catalog(spark, sf):
    """The live commits as catalog partitions, published after each commit."""
    wh = jobs.Warehouse.create(spark, work_dir(spark, "published"))
    path, view = work_dir(spark, "lake"), wh.name("transactions")
    version_sink.commit_overwrite(D.staging(spark, sf, where=_odd(F.col("o_orderkey"))).drop("status"), path)
    publish.publish(spark, view, path)
    version_sink.commit_overwrite(D.staging(spark, sf, where=_even(F.col("o_orderkey"))), path)
    publish.publish(spark, view, path)
    version_sink.commit_append(D.staging(spark, sf, where=_odd(F.col("o_orderkey"))), path)
    return publish.published(spark, view, path)


def union_versions(spark, sf):
    path = _two_commits(spark, sf)
    return summary.union_versions(versions.versions(spark, path, 0, 0), versions.versions(spark, path, 1, 1))


# -- scalar helpers over driver tables (P8-P11) ---------------------------------
def version_from_name(spark, sf):
    o = D.table(spark, sf, "orders")
    padded = F.lpad(F.col("o_orderkey").cast("string"), 20, "0")
    name = F.when(F.col("o_orderkey") % 10 == 0, F.concat(padded, F.lit(".checkpoint.parquet"))).otherwise(
        F.concat(padded, F.lit(".json"))
    )
    return o.select(name.alias("name")).select("name", X.version_from_name("name").alias("version"))


def path_basename(spark, sf):
    p = D.table(spark, sf, "pages")
    return p.select("page_id", X.path_basename("url").alias("basename"))


def path_trim(spark, sf):
    p = D.table(spark, sf, "pages")
    return p.select("page_id", X.trim_slashes("url").alias("trimmed"), X.rtrim_slashes("url").alias("rtrimmed"))


def uri_rewrite(spark, sf):
    c = D.table(spark, sf, "customer")
    uri = F.concat(
        F.lit("abfss://container"),
        (F.col("c_custkey") % URI_CONTAINERS).cast("string"),
        F.lit("@acct"),
        F.col("c_nationkey").cast("string"),
        F.lit(".dfs.core.windows.net/data/"),
        F.col("c_custkey").cast("string"),
        F.lit("/"),
    )
    return c.select("c_custkey", X.azure_blob_uri(uri, URI_ACCOUNT).alias("blob_uri"))


# -- jobs (B1 + B4) and table metadata (S12) -------------------------------------
def run_jobs(spark, sf):
    """B1 then B4 over the driver tables; returns the warehouse."""
    root = work_dir(spark, "job")
    lake = f"{root}/lake"
    jobs.write_lake_table(
        D.merge_staging(spark, sf, where=_even(F.col("o_orderkey"))),
        D.merge_staging(spark, sf, where=_odd(F.col("o_orderkey"))),
        lake,
        f"{root}/snapshot",
    )
    wh = jobs.Warehouse.create(spark, root)
    tables.create_table_if_not_exists(spark, wh.name(wh.final), schemas.FINAL_TABLE, path=f"{root}/final-v0")
    tables.insert_append(D.existing_target(spark, sf), wh.name(wh.final), schemas.required(schemas.FINAL_TABLE))
    jobs.stage_and_merge(spark, lake, wh, D.known_customers(spark, sf), "dev", D.MERGE_AS_OF)
    return wh


def job_final_table(spark, sf):
    wh = run_jobs(spark, sf)
    return spark.table(wh.name(wh.final))


def table_info(spark, sf):
    from keelson.sources.catalog import table_info as info

    wh = run_jobs(spark, sf)
    return info(spark, [wh.name(t) for t in (wh.staging, wh.customers, wh.final)])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "merge_upsert": merge_upsert,
    "merge_inserts": _by_action(INSERT),
    "merge_updates": _by_action(UPDATE),
    "merge_noop": _by_action(NOOP),
    "merge_kept": _by_action(KEEP),
    "merge_duplicate_keys": merge_duplicate_keys,
    "merge_delta": merge_delta,
    "merge_partitioned": merge_partitioned,
    "merge_bucketed": merge_bucketed,
    "merge_action_counts": merge_action_counts,
    "merge_affected_rows": merge_affected_rows,
    "merge_source": merge_source_q,
    "enriched_star": enriched_star,
    "enrich_left_join": enrich_left_join_q,
    "change_detect": change_detect,
    "change_detect_repeated": change_detect_repeated,
    "cast_numeric": cast_numeric,
    "to_date": to_date_q,
    "not_null_check": not_null_check,
    "pk_duplicates": pk_duplicates,
    "status_summary": status_summary,
    "status_totals": status_totals,
    "summary_by_version": summary_by_version,
    "row_count": row_count,
    "sample_rows": sample_rows,
    "seed_if_empty": seed_if_empty,
    "insert_append": insert_append,
    "staging_full_refresh": staging_full_refresh,
    "snapshot_export": snapshot_export,
    "export_range_scan": export_range_scan,
    "external_parquet_scan": external_parquet_scan,
    "external_table_refresh": external_table_refresh,
    "commit_append": commit_append,
    "snapshot_latest": snapshot_latest,
    "commit_overwrite": commit_overwrite,
    "external_lake_scan": external_lake_scan,
    "external_lake_catalog": external_lake_catalog,
    "union_versions": union_versions,
    "version_from_name": version_from_name,
    "path_basename": path_basename,
    "path_trim": path_trim,
    "uri_rewrite": uri_rewrite,
    "job_final_table": job_final_table,
    "table_info": table_info,
}
