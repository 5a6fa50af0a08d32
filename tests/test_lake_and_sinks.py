import os
import uuid

import pytest
from pyspark.sql import functions as F

from fixture_a import CUSTOMERS, CUSTOMER_SCHEMA, FIRST_COMMIT, SECOND_COMMIT, customers_df, txn_df
from keelson import schemas
from keelson.plans import jobs
from keelson.session import checkpoint_dir, work_dir
from keelson.sinks import labels, tables
from keelson.sinks import versions as lake_commit
from keelson.sources import catalog, external
from keelson.sources import versions as lake_log


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_overwrite_then_append_gives_eight_rows_seven_keys(spark):
    path = work_dir(spark, "t-lake")
    assert lake_commit.commit_overwrite(txn_df(spark, FIRST_COMMIT), path) == 0
    assert lake_commit.commit_append(txn_df(spark, SECOND_COMMIT), path) == 1
    snap = lake_log.snapshot(spark, path)
    assert snap.count() == 8
    assert snap.select("transaction_id").distinct().count() == 7
    assert lake_log.latest_version(spark, path) == 1
    assert sorted(snap.columns) == sorted(txn_df(spark, FIRST_COMMIT).columns)


def test_later_overwrite_replaces_rows(spark):
    path = work_dir(spark, "t-lake")
    lake_commit.commit_overwrite(txn_df(spark, FIRST_COMMIT), path)
    lake_commit.commit_append(txn_df(spark, SECOND_COMMIT), path)
    lake_commit.commit_overwrite(txn_df(spark, SECOND_COMMIT), path)
    snap = lake_log.snapshot(spark, path)
    assert snap.count() == 3
    assert lake_log.latest_version(spark, path) == 2


def test_append_with_other_schema_fails(spark):
    path = work_dir(spark, "t-lake")
    lake_commit.commit_overwrite(txn_df(spark, FIRST_COMMIT), path)
    with pytest.raises(ValueError):
        lake_commit.commit_append(txn_df(spark, SECOND_COMMIT).drop("status"), path)


def test_views_over_lake_and_parquet(spark):
    path = work_dir(spark, "t-lake")
    lake_commit.commit_overwrite(txn_df(spark, FIRST_COMMIT), path)
    lake_commit.commit_append(txn_df(spark, SECOND_COMMIT), path)
    external.lake_view(spark, "t_lake_view", path)
    assert spark.sql("SELECT count(*) AS n FROM t_lake_view").first()["n"] == 8
    lake_commit.commit_append(txn_df(spark, SECOND_COMMIT[:2]), path)  # the view shows what is latest when it is queried
    assert spark.sql("SELECT count(*) AS n FROM t_lake_view").first()["n"] == 10
    lake_commit.commit_overwrite(txn_df(spark, FIRST_COMMIT + SECOND_COMMIT), path)
    assert spark.sql("SELECT count(*) AS n FROM t_lake_view").first()["n"] == 8
    folder = work_dir(spark, "t-snap")
    tables.export_snapshot(lake_log.snapshot(spark, path), folder)
    external.parquet_view(spark, "t_parquet_view", folder)
    assert spark.sql("SELECT count(*) AS n FROM t_parquet_view").first()["n"] == 8


def test_seed_if_empty_twice_and_unconditional_insert(spark):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))
    name = wh.name("customers")
    tables.create_table_if_not_exists(spark, name, CUSTOMER_SCHEMA)
    seed = customers_df(spark)
    cols = [f.name for f in CUSTOMER_SCHEMA.fields]
    tables.seed_if_empty(spark, seed, name, cols)
    tables.seed_if_empty(spark, seed, name, cols)
    assert spark.table(name).count() == 4
    tables.insert_append(seed, name)
    assert spark.table(name).count() == 8


def test_not_null_enforced_in_write_plan(spark):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))
    name = wh.name("customers")
    tables.create_table_if_not_exists(spark, name, CUSTOMER_SCHEMA)
    bad = spark.createDataFrame([(None, "x", "y", "z", None)], "customer_id string, customer_name string, email string, country string, updated_at timestamp_ntz")
    with pytest.raises(Exception, match="NOT NULL"):
        tables.insert_append(tables.enforce_not_null(bad, ["customer_id"]), name)


def test_full_refresh_is_idempotent_and_kind_lookup(spark):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))
    name = wh.name("transactions_staging")
    df = txn_df(spark, FIRST_COMMIT + SECOND_COMMIT)
    assert tables.full_refresh(df, name) == 8
    assert tables.full_refresh(df, name) == 8
    assert spark.table(name).count() == 8
    assert tables.table_type(spark, name) == "MANAGED"
    assert tables.drop_if_managed(spark, name) is True
    assert tables.table_type(spark, name) is None
    assert tables.drop_if_managed(spark, name) is False


def test_labels_replace_and_lookup(spark):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))
    name = wh.name("customers")
    tables.create_table_if_not_exists(spark, name, CUSTOMER_SCHEMA)
    labels.set_labels(spark, name, {"stale": "x", "owner": "someone"})
    done = labels.apply_labels(spark, [name, wh.name("missing_table")], labels.standard_labels("dev"))
    assert done == {name: True, wh.name("missing_table"): False}
    assert labels.current_labels(spark, name) == labels.standard_labels("dev")
    rows = catalog.label_lookup(spark, [name]).collect()
    assert len(rows) == 1 and rows[0]["table_name"] == "customers" and rows[0]["option_name"] == "labels"
    assert rows[0]["option_value"] == (
        '[STRUCT("classification", "internal"), STRUCT("domain", "commerce"), '
        'STRUCT("environment", "dev"), STRUCT("owner", "data-team")]'
    )


def test_inline_and_values_rows(spark):
    rows = [(c[0], c[1], c[2], c[3]) for c in CUSTOMERS]
    df = external.inline_rows(spark, rows, ["customer_id", "customer_name", "email", "country"])
    assert df.columns == ["customer_id", "customer_name", "email", "country"]
    assert df.count() == 4
    v = external.values_rows(spark, CUSTOMERS, CUSTOMER_SCHEMA)
    assert v.count() == 4 and v.schema == CUSTOMER_SCHEMA


def test_stage_and_merge_job_on_reference_fixture(spark):
    root = work_dir(spark, "t-job")
    lake = f"{root}/lake"
    res = jobs.write_lake_table(txn_df(spark, FIRST_COMMIT), txn_df(spark, SECOND_COMMIT), lake, f"{root}/snap")
    assert res["version"] == 1
    wh = jobs.Warehouse.create(spark, root)
    out = jobs.stage_and_merge(spark, lake, wh, customers_df(spark), "dev")
    assert out["staged_rows"] == 8
    assert out["merge"]["insert"] == 8 and out["merge"]["affected_rows"] == 8
    assert all(out["labelled"].values())
    summary = {r["status"]: r["total_records"] for r in jobs.final_summary(spark, wh).collect()}
    assert summary == {"completed": 6, "refunded": 1, "pending": 1}
    # rerun: staging identical; seed does not duplicate; TXN-003 rows swap status
    out2 = jobs.stage_and_merge(spark, lake, wh, customers_df(spark), "dev")
    assert spark.table(wh.name("customers")).count() == 4
    assert out2["merge"]["update"] == 2 and out2["merge"]["noop"] == 6
    info = {r["table_name"]: (r["table_type"], r["num_rows"]) for r in catalog.table_info(spark, [wh.name(t) for t in ("customers", "final_table", "transactions_staging")]).collect()}
    assert info == {"customers": ("MANAGED", 4), "final_table": ("EXTERNAL", 8), "transactions_staging": ("MANAGED", 8)}


def test_refresh_view_job_requires_commits(spark):
    root = work_dir(spark, "t-job")
    with pytest.raises(lake_log.NoCommitsError):
        jobs.refresh_parquet_view(spark, "t_refresh_view", f"{root}/lake", f"{root}/snap")
    jobs.write_lake_table(txn_df(spark, FIRST_COMMIT), txn_df(spark, SECOND_COMMIT), f"{root}/lake", f"{root}/snap")
    r = jobs.refresh_parquet_view(spark, "t_refresh_view", f"{root}/lake", f"{root}/snap")
    assert r["version"] == 1 and spark.table("t_refresh_view").count() == 8
    # a newer commit without its snapshot: the view is not silently stale
    lake_commit.commit_append(txn_df(spark, SECOND_COMMIT), f"{root}/lake")
    with pytest.raises(FileNotFoundError):
        jobs.refresh_parquet_view(spark, "t_refresh_view", f"{root}/lake", f"{root}/snap")


def test_publish_lake_view_rewrites_uri(spark):
    root = work_dir(spark, "t-job")
    jobs.write_lake_table(txn_df(spark, FIRST_COMMIT), txn_df(spark, SECOND_COMMIT), f"{root}/lake", f"{root}/snap")
    r = jobs.publish_lake_view(
        spark, "t_lake_view2", f"{root}/lake", "abfss://lake@acct.dfs.core.windows.net/sales/tx/", "myacct"
    )
    assert r["blob_uri"] == "azure://myacct.blob.core.windows.net/lake/sales/tx/"
    assert spark.table("t_lake_view2").count() == 8
    with pytest.raises(Exception, match="invalid ADLS URI"):
        jobs.publish_lake_view(spark, "t_lake_view2", f"{root}/lake", "https://not-adls/x", "myacct")


def test_merge_job_without_as_of_keeps_table_types(spark):
    from fixture_a import FINAL_SCHEMA

    root = work_dir(spark, "t-job")
    jobs.write_lake_table(txn_df(spark, FIRST_COMMIT), txn_df(spark, SECOND_COMMIT), f"{root}/lake", f"{root}/snap")
    wh = jobs.Warehouse.create(spark, root)
    jobs.stage_and_merge(spark, f"{root}/lake", wh, customers_df(spark), "dev")
    final = spark.table(wh.name("final_table"))
    assert final.schema["last_updated"].dataType == FINAL_SCHEMA["last_updated"].dataType
    assert spark.read.parquet(tables.table_location(spark, wh.name("final_table"))).schema["last_updated"].dataType == FINAL_SCHEMA["last_updated"].dataType
    assert final.where(F.col("last_updated").isNull()).count() == 0


def test_merge_into_named_table_twice(spark):
    from fixture_a import FINAL_SCHEMA
    from keelson.operators.enrich import merge_source
    from keelson.sinks.merge_into import merge_into

    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))
    name = wh.name("final_table")
    tables.create_table_if_not_exists(spark, name, FINAL_SCHEMA, path=f"{wh.root}/final/v-0")
    src = merge_source(txn_df(spark, FIRST_COMMIT + SECOND_COMMIT), customers_df(spark))
    first = merge_into(spark, name, src, jobs.FINAL_MERGE)
    assert first["insert"] == 8 and first["affected_rows"] == 8 and first["rows"] == 8
    loc1 = tables.table_location(spark, name)
    second = merge_into(spark, name, src, jobs.FINAL_MERGE, remove_previous=True)
    assert second["update"] == 2 and second["noop"] == 6 and second["affected_rows"] == 2
    assert tables.table_location(spark, name) != loc1
    assert spark.table(name).count() == 8
    from keelson.sinks import fs

    assert not fs.exists(spark, loc1)

    before = scratch_folders(spark)
    merge_into(spark, name, src, jobs.FINAL_MERGE)  # its repeated keys need scratch folders
    assert scratch_folders(spark) == before


def scratch_folders(spark):
    folder = os.path.join(_local(checkpoint_dir(spark)), "keelson-work")
    return [x for x in os.listdir(folder) if x.startswith("merge-")]


def test_a_failing_merge_leaves_no_scratch(spark):
    from fixture_a import FINAL_SCHEMA
    from keelson.operators.enrich import merge_source
    from keelson.sinks.merge_into import merge_into

    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))
    name = wh.name("final_table")
    tables.create_table_if_not_exists(spark, name, FINAL_SCHEMA, path=f"{wh.root}/final/v-0")
    merge_into(spark, name, merge_source(txn_df(spark, FIRST_COMMIT), customers_df(spark)), jobs.FINAL_MERGE)
    key, customer, amount, date, _ = FIRST_COMMIT[0]
    clash = [(key, customer, amount, date, "x1"), (key, customer, amount, date, "x2")]
    before = scratch_folders(spark)
    with pytest.raises(Exception, match="at most one"):
        merge_into(spark, name, merge_source(txn_df(spark, clash), customers_df(spark)), jobs.FINAL_MERGE)
    assert scratch_folders(spark) == before


def test_external_parquet_table_replaces_a_managed_table(spark):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))
    name = wh.name("transactions_ext")
    tables.full_refresh(txn_df(spark, FIRST_COMMIT), name)  # a managed table of that name
    assert tables.table_type(spark, name) == "MANAGED"
    folder = work_dir(spark, "t-snap")
    tables.export_snapshot(txn_df(spark, FIRST_COMMIT + SECOND_COMMIT), folder)
    df = external.parquet_external_table(spark, name, folder)
    assert tables.table_type(spark, name) == "EXTERNAL" and df.count() == 8
    external.parquet_external_table(spark, name, folder)  # again: replaced, still external
    assert spark.table(name).count() == 8


def test_swap_writes_aside_and_repoints(spark):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))
    name = wh.name("t_replace")
    tables.create_table_if_not_exists(spark, name, txn_df(spark, FIRST_COMMIT).schema, path=f"{wh.root}/rep/v0")
    tables.insert_append(txn_df(spark, FIRST_COMMIT), name)
    before = tables.table_location(spark, name)
    grown = spark.table(name).unionByName(txn_df(spark, SECOND_COMMIT))  # reads the table it replaces
    m = tables.write_observed_and_swap(grown, None, name, f"{wh.root}/rep/v1", [])
    assert m["rows"] == 8 and spark.table(name).count() == 8
    assert tables.table_location(spark, name) != before


def test_inline_rows_quote_nulls_and_types(spark):
    import datetime as dt
    from decimal import Decimal

    rows = [("O'Brien", None, Decimal("1.50"), dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5)), ("b\\c", 7, None, None, None)]
    df = external.inline_rows(spark, rows, ["name", "n", "amount", "d", "ts"])
    got = df.collect()
    assert [r["name"] for r in got] == ["O'Brien", "b\\c"]
    assert got[0]["n"] is None and got[1]["n"] == 7
    assert got[0]["amount"] == Decimal("1.50") and got[0]["d"] == dt.date(2024, 1, 2)
    assert got[0]["ts"] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_full_refresh_keeps_labels_and_retires_the_old_folder(spark):
    from keelson.sinks import fs

    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))
    name = wh.name("transactions_staging")
    assert tables.full_refresh(txn_df(spark, FIRST_COMMIT), name) == 5
    labels.set_labels(spark, name, {"environment": "dev"})
    before = tables.table_location(spark, name)
    assert tables.full_refresh(txn_df(spark, SECOND_COMMIT), name) == 3
    assert spark.table(name).count() == 3 and labels.current_labels(spark, name) == {"environment": "dev"}
    assert fs.exists(spark, before)
    tables.full_refresh(txn_df(spark, SECOND_COMMIT), name, keep_seconds=0)
    assert not fs.exists(spark, before)


def test_null_key_insert_fails(spark):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))
    name = wh.name("customers")
    tables.create_table_if_not_exists(spark, name, CUSTOMER_SCHEMA)
    rows = customers_df(spark).withColumn("customer_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="customer_id"):
        tables.insert_append(rows, name, not_null=["customer_id"])
    assert spark.table(name).count() == 0


def test_seed_refuses_null_keys_and_tables_are_labelled_at_creation(spark):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))
    bad = customers_df(spark).withColumn("customer_id", F.when(F.col("customer_id") != "CUST-B", F.col("customer_id")))
    with pytest.raises(Exception, match="customer_id"):
        jobs.setup_tables(spark, wh, bad, "prod")
    assert spark.table(wh.name("customers")).count() == 0
    jobs.setup_tables(spark, wh, customers_df(spark), "prod")
    jobs.setup_tables(spark, wh, customers_df(spark), "prod")
    assert spark.table(wh.name("customers")).count() == 4 and spark.table(wh.name("final_table")).count() == 0
    for t in ("customers", "final_table"):
        assert labels.current_labels(spark, wh.name(t)) == labels.standard_labels("prod")
    for t, schema in (("customers", schemas.CUSTOMERS), ("final_table", schemas.FINAL_TABLE)):
        assert [(f.name, f.dataType) for f in spark.table(wh.name(t)).schema] == [(f.name, f.dataType) for f in schema]


def test_append_of_another_type_is_refused(spark):
    path = work_dir(spark, "t-lake")
    lake_commit.commit_overwrite(txn_df(spark, FIRST_COMMIT), path)
    with pytest.raises(ValueError, match="differs"):
        lake_commit.commit_append(txn_df(spark, SECOND_COMMIT).withColumn("amount", F.col("amount").cast("string")), path)


def test_inline_rows_take_values_as_they_are(spark):
    (row,) = external.inline_rows(spark, [("current_timestamp", 0.5, F.lit(7))], ["it's", "f", "n"]).collect()
    assert tuple(row) == ("current_timestamp", 0.5, 7)


def test_missing_table_and_rows_of_a_failed_commit(spark):
    path = work_dir(spark, "t-lake")
    with pytest.raises(lake_log.NoCommitsError):
        lake_log.latest_version(spark, path)
    with pytest.raises(lake_log.NoCommitsError):
        lake_commit.commit_append(txn_df(spark, FIRST_COMMIT), path)
    lake_commit.commit_overwrite(txn_df(spark, FIRST_COMMIT), path)
    txn_df(spark, SECOND_COMMIT).write.parquet(f"{path}/rows/commit_version=1")  # no record follows
    assert lake_log.snapshot(spark, path).count() == 5
    assert lake_commit.commit_append(txn_df(spark, SECOND_COMMIT[:1]), path) == 1
    assert lake_log.snapshot(spark, path).count() == 6
