"""Retired folders, counts kept with the table, co-located tables, published
generations, summaries by version, sorted exports."""

import os
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixture_a import FIRST_COMMIT, SECOND_COMMIT, customers_df, txn_df
from keelson import schemas
from keelson.operators import rollup
from keelson.operators.rollup import Rollup
from keelson.plans import jobs
from keelson.session import work_dir
from keelson.sinks import bucketed, fs, labels, publish, retire, tables
from keelson.sinks import versions as commits
from keelson.sources import catalog, versions
from keelson.streaming.commit_watch import watch_commits
from test_merge_plans import exchanges, no_broadcast, nodes  # noqa: F401


def warehouse(spark):
    return jobs.Warehouse.create(spark, work_dir(spark, "t-wh"))


# -- K4: retired folders -------------------------------------------------------------------
def test_a_reader_opened_before_a_refresh_finishes(spark):
    name = warehouse(spark).name("transactions_staging")
    tables.full_refresh(txn_df(spark, FIRST_COMMIT), name)
    reader = spark.read.parquet(tables.table_location(spark, name))
    first = tables.table_location(spark, name)
    assert tables.full_refresh(txn_df(spark, SECOND_COMMIT), name) == 3
    assert Counter(r["transaction_id"] for r in reader.collect()) == Counter(r[0] for r in FIRST_COMMIT)
    assert spark.table(name).count() == 3
    second = tables.table_location(spark, name)
    tables.full_refresh(txn_df(spark, FIRST_COMMIT), name, keep_seconds=0)  # the time of both is over
    assert not fs.exists(spark, first) and not fs.exists(spark, second) and spark.table(name).count() == 5


def test_age_decides_and_retiring_again_starts_anew(spark):
    parent = work_dir(spark, "t-retire")
    for n in ("a", "b"):
        txn_df(spark, FIRST_COMMIT).write.parquet(f"{parent}/{n}")
        retire.retire(spark, f"{parent}/{n}/")
    assert retire.remove_retired(spark, parent, 3600) == []
    marker = f"{parent}/{retire.MARKERS}/a"
    local = marker.removeprefix("file:")
    os.utime(local, (1, 1))
    assert retire.remove_retired(spark, parent, 3600) == ["a"] and fs.exists(spark, f"{parent}/b")
    os.utime(local.replace("/a", "/b"), (1, 1))
    retire.retire(spark, f"{parent}/b")
    assert retire.remove_retired(spark, parent, 3600) == [] and retire.remove_retired(spark, f"{parent}/none") == []


def test_merges_retire_the_replaced_version(spark):
    from keelson.operators.enrich import merge_source
    from keelson.sinks.merge_into import merge_into

    wh = warehouse(spark)
    name = wh.name("final_table")
    tables.create_table_if_not_exists(spark, name, schemas.FINAL_TABLE, path=f"{wh.root}/final/v-0")
    src = merge_source(txn_df(spark, FIRST_COMMIT), customers_df(spark))
    merge_into(spark, name, src, jobs.FINAL_MERGE)
    kept = tables.table_location(spark, name)
    merge_into(spark, name, src, jobs.FINAL_MERGE)
    assert fs.exists(spark, kept) and not spark.read.parquet(kept).isEmpty()
    merge_into(spark, name, src, jobs.FINAL_MERGE, keep_seconds=0)
    assert not fs.exists(spark, kept)


# -- S12, A3: counts kept with the table ------------------------------------------------------
def scans(df):
    return [n for n in nodes(df) if "Scan parquet" in n.nodeName()]


def test_counts_come_from_the_write_until_files_change(spark):
    name = warehouse(spark).name("transactions_staging")
    tables.full_refresh(txn_df(spark, FIRST_COMMIT), name)
    info = catalog.table_info(spark, [name])
    assert info.collect()[0]["num_rows"] == 5 and not scans(info)
    tables.insert_append(txn_df(spark, SECOND_COMMIT), name)
    tables.full_refresh(txn_df(spark, FIRST_COMMIT + SECOND_COMMIT), name)
    tables.insert_append(txn_df(spark, SECOND_COMMIT), name)
    info = catalog.table_info(spark, [name])
    assert info.collect()[0]["num_rows"] == 11 == spark.table(name).count() and not scans(info)
    txn_df(spark, SECOND_COMMIT).write.mode("append").parquet(tables.table_location(spark, name))  # behind the table's back
    spark.sql(f"REFRESH TABLE {name}")
    assert tables.known_rows(spark, name) is None
    info = catalog.table_info(spark, [name])
    assert info.collect()[0]["num_rows"] == 14 and scans(info)


# -- J1, K4, K5: co-located tables ------------------------------------------------------------
def test_bucketed_merge_has_no_exchange_below_the_join(spark, no_broadcast):  # noqa: F811
    wh = warehouse(spark)
    assert jobs.stage_bucketed(spark, wh, txn_df(spark, FIRST_COMMIT), customers_df(spark), buckets=4) == 5
    target = spark.table(wh.name(wh.final))
    first = jobs.merge_bucketed(spark, wh)
    assert first["insert"] == 5 and first["rows"] == 5
    for t in (wh.staging, wh.customers, wh.final):
        n, keys = bucketed.bucketing(spark, wh.name(t))
        assert n == 4 and keys == ["customer_id" if t == wh.customers else "transaction_id"]
    staging, final = (spark.table(wh.name(t)) for t in (wh.staging, wh.final))
    both = final.join(staging, "transaction_id", "full_outer")
    assert both.count() == 5
    both = both.select("transaction_id", staging["amount"])
    both.collect()
    assert exchanges(both) == []
    per_key = staging.groupBy("transaction_id").count()
    per_key.collect()
    assert exchanges(per_key) == []
    assert target.schema.names == schemas.FINAL_TABLE.names


def test_bucketed_merge_plan_with_a_broadcast_master(spark):
    """The job's own merge: the master is small and broadcast, staged rows keep their buckets."""
    from keelson.operators.enrich import merge_source
    from keelson.operators.merge import plan_merge

    wh = warehouse(spark)
    jobs.stage_bucketed(spark, wh, txn_df(spark, FIRST_COMMIT + SECOND_COMMIT[1:]), customers_df(spark), buckets=4)
    jobs.merge_bucketed(spark, wh)
    source = merge_source(spark.table(wh.name(wh.staging)), F.broadcast(spark.table(wh.name(wh.customers))))
    plan = plan_merge(spark.table(wh.name(wh.final)), source, jobs.FINAL_MERGE, [], max_filter_keys=0)
    assert len(plan.collect()) == 7 and exchanges(plan) == []


def test_bucketed_refresh_keeps_labels_and_merge_matches_the_plain_one(spark):
    wh, plain = warehouse(spark), warehouse(spark)
    for rows in (FIRST_COMMIT, FIRST_COMMIT + SECOND_COMMIT):
        jobs.stage_bucketed(spark, wh, txn_df(spark, rows), customers_df(spark), buckets=3)
        labels.set_labels(spark, wh.name(wh.staging), {"environment": "dev"})
        jobs.merge_bucketed(spark, wh)
        tables.full_refresh(txn_df(spark, rows), plain.name(plain.staging))
        jobs.setup_tables(spark, plain, customers_df(spark))
        jobs.merge_into_final(spark, plain)
    key = ("transaction_id", "customer_name", "amount", "status")
    rows = [Counter(tuple(r[c] for c in key) for r in spark.table(w.name(w.final)).collect()) for w in (wh, plain)]
    assert rows[0] == rows[1] and sum(rows[0].values()) == 8 - 1
    assert labels.current_labels(spark, wh.name(wh.staging)) == {"environment": "dev"}
    assert catalog.table_info(spark, [wh.name(wh.staging)]).collect()[0]["num_rows"] == 8
    with pytest.raises(ValueError, match="no buckets"):
        bucketed.replace_rows(customers_df(spark), plain.name(plain.customers))


# -- S1, S5: published generations -------------------------------------------------------------
def test_200_versions_and_a_changed_schema(spark):
    path, view = work_dir(spark, "t-lake"), warehouse(spark).name("lake")
    one = txn_df(spark, FIRST_COMMIT).coalesce(1)
    commits.commit_overwrite(one, path)
    publish.publish(spark, view, path)
    # what 198 further overwrites leave behind: their rows and records
    for v in range(1, 199):
        for part, df in (("rows", one.limit(1)), ("commits", spark.range(1).coalesce(1).select(F.lit("overwrite").alias("kind")))):
            if v == 1:
                df.coalesce(1).write.parquet(f"{path}/{part}/commit_version={v}")
            else:
                spark._jvm.org.apache.commons.io.FileUtils.copyDirectory(*[spark._jvm.java.io.File(f"{path}/{part}/commit_version={x}".removeprefix("file:")) for x in (1, v)])
    wider = txn_df(spark, FIRST_COMMIT).withColumn("note", F.lit("n")).drop("status")
    assert commits.commit_overwrite(wider, path) == 199
    assert commits.commit_append(wider.limit(2), path) == 200
    out = publish.publish(spark, view, path)
    assert out["version"] == 200 and out["partitions"] == 2
    shown = spark.table(view)
    assert shown.columns == wider.columns and shown.count() == 7
    assert {f.split("commit_version=")[1].split("/")[0] for f in shown.inputFiles()} == {"199", "200"}
    scan = next(n for n in nodes_after(shown.select("transaction_id")) if "Scan parquet" in n.nodeName())
    assert scan.metrics().apply("numPartitions").value() == 2 and scan.metrics().apply("numFiles").value() <= 16
    assert publish.publish(spark, view, path)["partitions"] == 0
    commits.commit_append(wider.limit(1), path)
    assert publish.publish(spark, view, path)["partitions"] == 1 and spark.table(view).count() == 8
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {view.split('.')[0]}").collect()]
    assert sorted(names) == ["lake", "lake_from_199"]
    assert Counter(tuple(r) for r in spark.table(view).collect()) == Counter(tuple(r) for r in versions.snapshot(spark, path).collect())


def nodes_after(df):
    df.collect()
    return nodes(df)


def test_publish_needs_a_commit_and_takes_the_view_back_in_time_never(spark):
    path, view = work_dir(spark, "t-lake"), warehouse(spark).name("lake")
    with pytest.raises(versions.NoCommitsError):
        publish.publish(spark, view, path)
    commits.commit_overwrite(txn_df(spark, FIRST_COMMIT), path)
    commits.commit_append(txn_df(spark, SECOND_COMMIT), path)
    assert publish.published(spark, view, path).count() == 8
    commits.commit_overwrite(txn_df(spark, SECOND_COMMIT), path)
    assert spark.table(view).count() == 8  # until it is published
    assert publish.published(spark, view, path).count() == 3


# -- A1, A2: summaries by version ---------------------------------------------------------------
BOTH = Rollup("all", ("status",), ("amount",), ("transaction_date",))


def recomputed(spark, path):
    rows = versions.snapshot(spark, path).groupBy("status").agg(F.count(F.lit(1)), F.sum("amount"), F.max("transaction_date")).collect()
    return {tuple(r) for r in rows}


def kept_up(spark, path):
    return {tuple(r[c] for c in ("status", "total", "sum_amount", "max_transaction_date")) for r in rollup.summary(spark, path, BOTH).collect()}


def test_summaries_after_overwrites_and_appends(spark):
    path = work_dir(spark, "t-rollup")
    odd = [("TXN-9", "C", None, "2024-01-01", None), ("TXN-8", "C", Decimal("1.00"), None, None)]
    commits.commit_overwrite(txn_df(spark, FIRST_COMMIT), path)
    assert rollup.catch_up(spark, path, BOTH) == [0] and kept_up(spark, path) == recomputed(spark, path)
    commits.commit_append(txn_df(spark, SECOND_COMMIT + odd), path)
    assert kept_up(spark, path) == recomputed(spark, path)
    assert rollup.catch_up(spark, path, BOTH) == []
    commits.commit_overwrite(txn_df(spark, odd), path)
    commits.commit_append(txn_df(spark, []), path)
    assert kept_up(spark, path) == recomputed(spark, path) and len(kept_up(spark, path)) == 1
    commits.commit_overwrite(txn_df(spark, []), path)
    assert kept_up(spark, path) == set()


def test_the_watcher_keeps_summaries_up(spark):
    path = work_dir(spark, "t-rollup")
    done = []
    commits.commit_overwrite(txn_df(spark, FIRST_COMMIT), path)
    watch_commits(spark, path, lambda v: done.append(rollup.catch_up(spark, path, BOTH)), f"{path}-watch").awaitTermination(120)
    commits.commit_append(txn_df(spark, SECOND_COMMIT), path)
    commits.commit_append(txn_df(spark, SECOND_COMMIT), path)
    watch_commits(spark, path, lambda v: done.append(rollup.catch_up(spark, path, BOTH)), f"{path}-watch").awaitTermination(120)
    assert done == [[0], [1, 2]] and kept_up(spark, path) == recomputed(spark, path)


# -- K3, S6: sorted exports ---------------------------------------------------------------------
def test_sorted_export_holds_ranges_and_splits_a_hot_key(spark):
    import pyarrow.parquet as pq

    rows = [(None if i % 50 == 0 else "hot" if i % 3 == 0 else f"k{i:05d}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(6)
    folder = work_dir(spark, "t-sorted")
    assert tables.export_sorted(df, folder, "k", rows_per_file=500) == 6000
    back = spark.read.parquet(folder)
    assert Counter(tuple(r) for r in back.collect()) == Counter(rows)
    local = folder.removeprefix("file:")
    files = sorted(f for f in os.listdir(local) if f.endswith(".parquet"))
    assert max(pq.read_metadata(f"{local}/{f}").num_rows for f in files) <= 1000
    spans = []
    for f in files:
        k = pq.read_table(f"{local}/{f}", columns=["k"])["k"].to_pylist()
        assert k == sorted(k, key=lambda x: (x is not None, x or ""))
        spans.append((k[0] or "", k[-1] or ""))
    assert sum(lo <= "hot" <= hi for lo, hi in spans) >= 3
    touched = [lo <= "k00500" and hi >= "k00400" for lo, hi in spans]
    assert 1 <= sum(touched) <= len(files) / 4  # a range of the key lies in a fraction of the files
    assert back.where(F.col("k").between("k00400", "k00500")).count() == sum(k is not None and "k00400" <= k <= "k00500" for k, _ in rows)
    assert tables.export_sorted(df.limit(0), folder, "k") == 0 and spark.read.schema(df.schema).parquet(folder).count() == 0
