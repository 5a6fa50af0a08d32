"""Plan-shape checks for the scale claims: a hot customer key in the
enrichment join is split by AQE, and commit sequences replay exactly."""

from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixture_a import customers_df, txn_df
from keelson.operators.enrich import enrich_left_join
from keelson.session import work_dir
from keelson.sinks import versions as lake_commit
from keelson.sources import versions as lake_log

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200",
}


def test_hot_customer_key_is_split_by_aqe(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        hot = [(f"TXN-{i}", "CUST-A", Decimal("1.00"), "2024-01-01", "completed") for i in range(3000)]
        cold = [(f"TXN-X{i}", f"CUST-{c}", Decimal("1.00"), "2024-01-01", "completed") for i, c in enumerate("BCD" * 20)]
        staging = txn_df(spark, hot + cold).repartition(8)
        out = enrich_left_join(staging, customers_df(spark))
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan, plan
        assert len(rows) == 3060
        assert Counter(r["customer_name"] for r in rows)["Alice Johnson"] == 3000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


ROWS = [
    (f"TXN-{i:03d}", f"CUST-{i % 3}", Decimal(f"{i}.00"), "2024-01-01", ["completed", "pending"][i % 2]) for i in range(12)
]
commit_op = st.tuples(st.sampled_from(["overwrite", "append"]), st.lists(st.integers(0, 11), min_size=0, max_size=4))


@settings(derandomize=True, max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(commit_op, min_size=1, max_size=4))
def test_commit_sequences_replay_like_a_bag_model(spark, ops):
    ops = [("overwrite", ops[0][1])] + ops[1:]  # a table starts with an overwrite
    path = work_dir(spark, "t-prop-lake")
    model: Counter = Counter()
    for version, (mode, idx) in enumerate(ops):
        rows = [ROWS[i] for i in idx]
        assert lake_commit.commit(txn_df(spark, rows), path, mode) == version
        if mode == "overwrite":
            model = Counter()
        model.update(rows)
    snap = lake_log.snapshot(spark, path)
    assert Counter(tuple(r) for r in snap.collect()) == model
    assert lake_log.latest_version(spark, path) == len(ops) - 1
    assert snap.agg(F.count(F.lit(1))).first()[0] == sum(model.values())


def test_unique_keys_merge_without_copies_or_sorted_aggregates(spark):
    from conftest import SF_SMALL

    from keelson.operators.enrich import merge_source
    from keelson.operators.merge import plan_merge
    from keelson.plans import jobs
    from keelson.sources import driver_tables as D

    src = merge_source(D.merge_staging(spark, SF_SMALL), D.known_customers(spark, SF_SMALL), D.MERGE_AS_OF)
    scratch = []
    plan = plan_merge(D.existing_target(spark, SF_SMALL), src, jobs.FINAL_MERGE, scratch)
    assert scratch == []
    assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()
