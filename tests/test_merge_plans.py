"""The merge's plans: one exchange a side, the key filter, hot keys, and merges
into a partitioned table that leave unchanged partitions alone."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from keelson.operators import merge as M
from keelson.plans import jobs
from keelson.session import work_dir
from keelson.sinks import fs, retire, tables
from keelson.sinks.merge_partitions import merge_into_partitions
from test_merge import COLS, P_SCHEMA, P_SPEC, brute_merge


def nodes(df):
    """All nodes of a query's final plan, with those inside query stages."""
    plan, out = df._jdf.queryExecution().executedPlan(), []
    todo = [plan]
    while todo:
        p = todo.pop()
        name = p.nodeName()
        out.append(p)
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        elif name in ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage", "ResultQueryStage"):
            todo.append(p.plan())
        else:
            kids = p.children()
            todo += [kids.apply(i) for i in range(kids.size())]
    return out


def exchanges(df):
    return [p for p in nodes(df) if p.nodeName() == "Exchange"]


def shuffled(df):
    """Records written by the exchanges of a query that has run."""
    return sum(e.metrics().apply("shuffleRecordsWritten").value() for e in exchanges(df))


def case(n_target, n_source, seed=1, overlap=1.0):
    rnd = random.Random(seed)
    value = lambda: rnd.choice(["p", "q", None])
    amount = lambda: rnd.choice([Decimal("1.00"), Decimal("2.00"), None])
    target = [(f"K{i}", value(), value(), amount(), f"t{i}") for i in range(n_target)]
    keys = rnd.sample(range(n_target), int(n_source * overlap))
    keys += range(n_target, n_target + n_source - len(keys))
    return target, [(f"K{i}", value(), value(), amount(), f"s{i}") for i in keys]


def frames(spark, target, source):
    folder = work_dir(spark, "t-merge")
    spark.createDataFrame(target, P_SCHEMA).repartition(4).write.parquet(f"{folder}/t")
    spark.createDataFrame(source, P_SCHEMA).repartition(4).write.parquet(f"{folder}/s")
    return spark.read.parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/s")


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_unique_keys_need_one_exchange_a_side(spark, no_broadcast):
    target, source = case(300, 250, overlap=0.7)
    plan = M.merge_plan(*frames(spark, target, source), P_SPEC)
    assert Counter(tuple(r) for r in plan.collect()) == brute_merge(target, source)
    assert len(exchanges(plan)) == 2


def test_key_filter_spares_the_shuffle_and_stays_exact(spark, no_broadcast, monkeypatch):
    target, source = case(20_000, 2_000, overlap=0.9)
    t, s = frames(spark, target, source)
    filtered = M.merge_plan(t, s, P_SPEC)
    got = Counter(tuple(r) for r in filtered.collect())
    scratch = []
    whole = M.plan_merge(t, s, P_SPEC, scratch, max_filter_keys=0)
    assert scratch == [] and Counter(tuple(r) for r in whole.collect()) == got
    with_filter, without = shuffled(filtered), shuffled(whole)
    assert without >= 22_000 and with_filter <= without / 2, (with_filter, without)
    explained = filtered._jdf.queryExecution().toString()
    assert "bit_or" in explained and "BroadcastHashJoin" in explained
    assert got == brute_merge_fast(target, source)


def brute_merge_fast(target, source):
    """As ``brute_merge``, for unique source keys."""
    by_key, out = {s[0]: [s] for s in source}, Counter()
    seen = {t[0] for t in target}
    for t in target:
        out += brute_merge([t], by_key.get(t[0], []))
    return out + Counter((*s, "INSERT") for s in source if s[0] not in seen)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 64, 1000])
def test_key_filter_never_rules_out_a_key(spark, n):
    keys = spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"))
    words, word, bits = M._key_words(keys, "k", n)
    hits = keys.join(words, word == F.col("_word")).where(F.col("_bits").bitwiseAND(bits) == bits)
    assert hits.count() == n
    others = spark.range(n, n + 4000).select(F.concat(F.lit("k"), "id").alias("k"))
    wrong = others.join(words, word == F.col("_word")).where(F.col("_bits").bitwiseAND(bits) == bits).count()
    assert wrong <= 400


def test_hot_and_null_target_keys_bypass_the_join(spark, no_broadcast):
    target, source = case(200, 150, overlap=0.8)
    hot_target = [("HOT", "p", "b", Decimal("1.00"), f"t{i % 3}") for i in range(900)] + [("WARM", "p", None, None, "w")] * 500
    target += hot_target + [(None, "p", "b", None, "n")] * 300
    source += [("HOT", "q", "b", Decimal("1.00"), "new")]
    t, s = frames(spark, target, source)
    facts = M.key_facts(t, s, "k", hot_rows=400)
    assert set(facts.hot) == {"HOT", "WARM"} and facts.target_nulls == 300 and facts.source_most == 1
    plan = M.plan_merge(t, s, P_SPEC, [], facts, max_filter_keys=0)
    assert Counter(tuple(r) for r in plan.collect()) == brute_merge(target, source)
    assert shuffled(plan) <= 200 + 151  # neither hot nor null keys are shuffled


# -- partitioned targets ---------------------------------------------------------------
SPEC = M.MergeSpec("k", ("a", "b", "x"), ("a", "x", "e"))
PART_SCHEMA = "k string, a string, b string, x decimal(10,2), e string, day string, n int"


def part_table(spark, rows, partitioned_by=("day",)):
    wh = jobs.Warehouse.create(spark, work_dir(spark, "t-part"))
    name = wh.name("target")
    df = spark.createDataFrame(rows, PART_SCHEMA)
    tables.create_table_if_not_exists(spark, name, df.schema, path=f"{wh.root}/target", partitioned_by=partitioned_by)
    tables.insert_append(df.select(*spark.table(name).columns), name)
    return name


def files_by_day(spark, name):
    rows = spark.table(name).select("day", F.input_file_name().alias("f")).distinct().collect()
    out = {}
    for r in rows:
        out.setdefault(r["day"], set()).add(r["f"])
    return out


def plain(target, source, spec=SPEC):
    """(rows, actions) of the merge by pairs over rows with two columns more."""
    cut = [r[:5] for r in target], [r[:5] for r in source]
    assert brute_merge(*cut) != "ERROR"
    names, out = [*COLS, "day", "n"], []
    for t in target:
        mine = [s for s in source if t[0] is not None and s[0] == t[0]]
        hit = [s for s in mine if any(t[i] is not None and s[i] is not None and t[i] != s[i] for i in (1, 2, 3))]
        out.append(tuple((hit[0] if hit and c in spec.update else t)[i] for i, c in enumerate(names)))
    seen = {t[0] for t in target}
    return Counter(out + [s for s in source if s[0] not in seen])


DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "odd/day=%", None]


def day_rows(n_each=20):
    return [(f"K{d}-{i}", "p", "b", Decimal("1.00"), "old", day, i) for d, day in enumerate(DAYS) for i in range(n_each)]


def test_only_changed_partitions_are_rewritten(spark):
    rows = day_rows() + [("K1-3", "p", "b", Decimal("1.00"), "twin", DAYS[1], 99)]
    name = part_table(spark, rows)
    before = files_by_day(spark, name)
    source = [
        ("K1-3", "q", "b", Decimal("1.00"), "new", DAYS[0], 1),  # matches twice, in another partition than its own day's
        ("K2-4", "p", "b", Decimal("1.00"), "same", DAYS[2], 1),  # matched, no change: its partition stays
        ("K0-0", "p", "b", None, "null", DAYS[0], 1),  # a NULL is no change
        ("NEW", "p", "b", Decimal("3.00"), "new", "2024-02-01", 1),  # a new partition
        ("K4-0", "z", "b", Decimal("1.00"), "new", None, 1),  # the null partition
    ]
    src = spark.createDataFrame(source, PART_SCHEMA)
    out = merge_into_partitions(spark, name, src, SPEC)
    got = Counter(tuple(r[c] for c in (*COLS, "day", "n")) for r in spark.table(name).collect())
    assert got == plain(rows, source)
    after = files_by_day(spark, name)
    assert all(after[d] == before[d] for d in (DAYS[0], DAYS[2], DAYS[3]))
    assert all(after[d] != before[d] for d in (DAYS[1], DAYS[4])) and "2024-02-01" in after
    assert out["partitions"] == 3 and out["update"] == 3 and out["insert"] == 1 and out["noop"] == 2 and out["affected_rows"] == 4
    assert out["rows"] == 21 + 20 + 1
    again = merge_into_partitions(spark, name, src, SPEC)
    assert again["partitions"] == 0 and again["affected_rows"] == 0 and files_by_day(spark, name) == after
    # special characters in a partition's value
    odd = spark.createDataFrame([("K3-1", "q", "b", Decimal("1.00"), "new", DAYS[3], 1)], PART_SCHEMA)
    assert merge_into_partitions(spark, name, odd, SPEC)["partitions"] == 1
    assert spark.table(name).where("e = 'new'").count() == 5


def test_partitioned_merge_prunes_the_second_read_and_keeps_readers_alive(spark):
    rows = day_rows(50)
    name = part_table(spark, rows)
    source = spark.createDataFrame([("K0-1", "q", "b", Decimal("1.00"), "new", DAYS[0], 1)], PART_SCHEMA)
    base = tables.table_location(spark, name)
    stale = spark.read.parquet(base)
    merge_into_partitions(spark, name, source, SPEC)
    assert stale.agg(F.count("e")).first()[0] == 250 and stale.where("e = 'new'").count() == 0  # opened before, read after
    assert "day=2024-01-01" in fs.entries(spark, base)
    assert retire.remove_retired(spark, base, keep_seconds=0) == ["day=2024-01-01"]
    assert spark.table(name).count() == 250


def test_partitioned_merge_refuses_to_move_rows_and_leaves_no_scratch(spark):
    name = part_table(spark, day_rows(3))
    src = spark.createDataFrame([("K0-1", "q", "b", None, "new", DAYS[0], 1)], PART_SCHEMA)
    with pytest.raises(ValueError, match="between partitions"):
        merge_into_partitions(spark, name, src, M.MergeSpec("k", ("a",), ("day",)))
    clash = spark.createDataFrame([("K0-1", "q", "b", None, "x", DAYS[0], 1), ("K0-1", "r", "b", None, "y", DAYS[0], 1)], PART_SCHEMA)
    before = files_by_day(spark, name)
    with pytest.raises(Exception, match="at most one"):
        merge_into_partitions(spark, name, clash, SPEC)
    assert files_by_day(spark, name) == before


def test_repeated_source_keys_into_two_partition_columns(spark):
    rows = day_rows(6)
    name = part_table(spark, rows, ("day", "n"))
    source = [("K0-1", None, "b", None, "no", DAYS[0], 1), ("K0-1", "q", None, None, "new", DAYS[1], 2), ("N1", "p", "b", None, "new", None, 5)]
    out = merge_into_partitions(spark, name, spark.createDataFrame(source, PART_SCHEMA), SPEC)
    got = Counter(tuple(r[c] for c in (*COLS, "day", "n")) for r in spark.table(name).collect())
    assert got == plain(rows, source) and out["partitions"] == 2
