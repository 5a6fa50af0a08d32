"""Conditional upsert (MERGE) as one distributed DataFrame plan.

Semantics (target ``T``, source ``S``, equality on one key column):

* ``WHEN MATCHED AND changed(T, S) THEN UPDATE SET <update columns> = S.*``
  where ``changed`` is the three-valued disjunction of ``!=`` over the
  compare columns (a NULL on either side is not a change by itself).
* ``WHEN NOT MATCHED BY TARGET THEN INSERT`` every source row; a NULL key
  never matches, and inserting it violates the key's NOT NULL constraint.
* Target rows without a source row are kept (``KEEP``); matched rows that
  do not qualify stay untouched, ``last_updated`` included (``NOOP``).
* Keys are not enforced to be unique on either side. For a target row, the
  number of qualifying source rows is counted; more than one raises, one
  is applied, zero is a no-op.

Plan (no pair of rows sharing a key is ever materialised):

1. The keys of both sides are looked at once, on the key column alone and side by side:
   source rows a key, and the target's row count and hot keys (a sketch of bounded size
   that combines map-side). The source must be deterministic.
2. Without repeated source keys: one full outer join, that is one exchange a side. Target
   rows without a key are kept without a shuffle. The join can't split a hot key,
   so target rows of hot keys (``HOT_ROWS`` rows and more, at most ``MAX_HOT`` keys) meet
   their source rows in a broadcast of at most one row a hot key.
3. If the source has at most half as many rows as the target, a Bloom filter of its
   keys rules target rows out beforehand: they are kept without a shuffle, so what is
   shuffled is in proportion to the source. The filter is a table of 64-bit words, one
   lookup a row, sized from the count; beyond ``MAX_FILTER_KEYS`` keys (64 MB of words)
   there is none. It only spares work: rows it lets through are joined exactly.
4. With repeated keys: the source is written once to the shared folder with a row
   number, and the target rows of repeated keys go another way. Per key and
   compare column the non-NULL values are counted, and per (key, column, value)
   too, each with the XOR of the row numbers. For a target value ``v`` the
   difference of the two counts is the number of source rows that differ from ``v``
   in that column, and if that is one, the XOR of the two sums is its row number.
   A target row has more than one qualifying source row exactly if some column
   has two differing rows or two columns have different ones. The work is linear in
   rows and compare columns; all joins are many-to-one equi-joins, so a hot key is split
   by AQE's skew handling, and all aggregates combine map-side.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.expressions import assert_that, changed
from keelson.session import work_dir

ACTION = "action"
INSERT, UPDATE, NOOP, KEEP = "INSERT", "UPDATE", "NOOP", "KEEP"

HOT_ROWS = 1 << 20  # target rows of one key that are too many for a task
MAX_HOT = 1000  # hot keys looked for; a key with fewer than a 10,000th of all rows isn't looked for
MAX_FILTER_KEYS = 1 << 24
MULTI_MATCH_ERROR = "MERGE must match at most one qualifying source row for each target row"


@dataclass(frozen=True)
class MergeSpec:
    key: str
    compare: tuple[str, ...]
    update: tuple[str, ...]


def merge_plan(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Rows of the merged table (target column order) plus ``action``.

    With repeated source keys, or a key filter, the plan reads scratch folders under the shared
    checkpoint folder; :func:`keelson.sinks.merge_into.merge_into` removes them
    once the merged table is written."""
    return plan_merge(target, source, spec, [])


def plan_merge(target: DataFrame, source: DataFrame, spec: MergeSpec, scratch: list[str], facts: KeyFacts | None = None, max_filter_keys: int = MAX_FILTER_KEYS) -> DataFrame:
    """:func:`merge_plan`; adds the scratch folders it writes to ``scratch``.

    Looks at the keys eagerly, unless given their facts; a NULL-key insert raises right away."""
    cols, k = target.columns, spec.key
    missing = set(cols) - set(source.columns)
    if missing:
        raise ValueError(f"source lacks target columns: {sorted(missing)}")
    if not spec.compare:
        raise ValueError("MergeSpec.compare must name at least one column (the WHEN MATCHED AND condition)")
    for c in (*spec.compare, *spec.update):
        if c not in cols:
            raise ValueError(f"unknown column {c!r}")

    src = source.select(*cols)
    facts = facts or key_facts(target, src, k)
    if facts.source_nulls:
        raise ValueError(f"NOT NULL constraint violated: {k} of an inserted row ({facts.source_nulls} rows)")
    if facts.source_most <= 1:
        filtered = 2 * facts.source_rows <= facts.target_rows and facts.source_rows <= max_filter_keys
        if filtered:
            src = _scratch(src, "merge-source", scratch)
        return _merge_unique(target, src, spec, facts, filtered)
    src = _scratch(src.withColumn("_sid", F.monotonically_increasing_id()), "merge-source", scratch)
    repeated = src.groupBy(k).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(k)
    repeated = _scratch(repeated, "merge-repeated", scratch)
    exact = _exact_matches(target.join(repeated, k, "left_semi").select(*cols), src.join(repeated, k, "left_semi"), spec, cols)
    single = _single_matches(target.join(repeated, k, "left_anti").select(*cols), src.join(repeated, k, "left_anti"), spec, cols)
    inserts = src.join(target.select(k), k, "left_anti").select(*cols, F.lit(INSERT).alias(ACTION))
    return single.unionByName(exact).unionByName(inserts)


@dataclass(frozen=True)
class KeyFacts:
    source_rows: int
    source_nulls: int
    source_most: int  # rows of the source's most frequent key
    target_rows: int
    target_nulls: int
    hot: tuple  # target keys with very many rows


def key_facts(target: DataFrame, source: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> KeyFacts:
    """What the merge needs to know of the keys; both sides are read at the same time."""

    def of_source():
        null = F.col(key).isNull()
        rows = source.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        return rows.agg(F.sum("_n").alias("rows"), F.sum(F.when(null, F.col("_n"))).alias("nulls"), F.max(F.when(~null, F.col("_n"))).alias("most")).first()

    def of_target():
        sketch = F.expr(f"approx_top_k(`{key}`, {MAX_HOT}, {10 * MAX_HOT})")
        return target.select(key).agg(F.count(F.lit(1)).alias("rows"), F.count(key).alias("keyed"), sketch.alias("top")).first()

    with ThreadPoolExecutor(2) as pool:
        s, t = pool.submit(of_source), pool.submit(of_target)
        s, t = s.result(), t.result()
    hot = tuple(r["item"] for r in t["top"] or [] if r["item"] is not None and r["count"] >= hot_rows)
    return KeyFacts(s["rows"] or 0, s["nulls"] or 0, s["most"] or 0, t["rows"], t["rows"] - t["keyed"], hot)


def _key_words(src: DataFrame, key: str, n_keys: int) -> tuple[DataFrame, Column, Column]:
    """(the words of a Bloom filter of the keys, a key's word, a key's bits): 16 bits a
    key, four of them set, all in one word."""
    n_words = 1 << max(0, (max(1, n_keys) - 1).bit_length() - 2)
    h = F.xxhash64(key)
    word = h.bitwiseAND(n_words - 1)
    bits = F.lit(0).cast("long")
    for shift in (24, 30, 36, 42):
        place = F.shiftrightunsigned(h, shift).bitwiseAND(63).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    words = src.select(word.alias("_word"), bits.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    return words, word, bits


def _merge_unique(target: DataFrame, src: DataFrame, spec: MergeSpec, facts: KeyFacts, filtered: bool) -> DataFrame:
    """The merge with at most one source row a key."""
    cols, k = target.columns, spec.key
    parts = []

    def keep(rows: DataFrame) -> None:
        parts.append(rows.select(*cols, F.lit(KEEP).alias(ACTION)))

    if facts.target_nulls:
        keep(target.where(F.col(k).isNull()))
        target = target.where(F.col(k).isNotNull())
    if facts.hot:
        # at most one source row a hot key; a hot key is matched, so none is inserted here
        is_hot = F.col(k).isin(list(facts.hot))
        parts.append(_single_matches(target.where(is_hot), F.broadcast(src.where(is_hot)), spec, cols))
        target, src = target.where(~is_hot), src.where(~is_hot)
    if filtered:
        words, word, bits = _key_words(src, k, facts.source_rows)
        probed = target.join(F.broadcast(words), word == F.col("_word"), "left")
        may_match = F.coalesce(F.col("_bits").bitwiseAND(bits) == bits, F.lit(False))
        keep(probed.where(~may_match))
        target = probed.where(may_match).select(*cols)
    out = _outer_matches(target, src, spec, cols)
    for p in parts:
        out = out.unionByName(p)
    return out


def _outer_matches(target: DataFrame, src: DataFrame, spec: MergeSpec, cols: list[str]) -> DataFrame:
    """Target rows with a key against at most one source row a key, and the source rows left over."""
    s = src.select(*[F.col(c).alias(f"_s_{c}") for c in cols])
    rows = target.withColumn("_t", F.lit(True)).join(s, target[spec.key] == s[f"_s_{spec.key}"], "full_outer")
    change = changed([F.col(c) for c in spec.compare], [F.col(f"_s_{c}") for c in spec.compare])
    action = F.when(F.col("_t").isNull(), INSERT).when(F.col(f"_s_{spec.key}").isNull(), KEEP).when(change, UPDATE).otherwise(NOOP)
    rows = rows.withColumn(ACTION, action)
    new, old = F.col(ACTION) == INSERT, F.col(ACTION).isin(INSERT, UPDATE)
    return rows.select(*[F.when(old if c in spec.update else new, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for c in cols], ACTION)


def _scratch(df: DataFrame, label: str, scratch: list[str]) -> DataFrame:
    path = work_dir(df.sparkSession, label)
    scratch.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _applied(rows: DataFrame, spec: MergeSpec, cols: list[str], action) -> DataFrame:
    """Target rows with the columns of the source row ``_s`` where updated."""
    rows = rows.withColumn(ACTION, action)
    is_update = F.col(ACTION) == UPDATE
    return rows.select(
        *[(F.when(is_update, F.col(f"_s.{c}")).otherwise(F.col(c)) if c in spec.update else F.col(c)).alias(c) for c in cols], ACTION
    )


def _single_matches(target: DataFrame, src: DataFrame, spec: MergeSpec, cols: list[str]) -> DataFrame:
    """Target rows against at most one source row a key."""
    s = src.select(F.col(spec.key).alias("_k"), F.struct(*cols).alias("_s"))
    rows = target.join(s, target[spec.key] == s["_k"], "left")
    change = changed([F.col(c) for c in spec.compare], [F.col(f"_s.{c}") for c in spec.compare])
    return _applied(rows, spec, cols, F.when(F.col("_k").isNull(), KEEP).when(change, UPDATE).otherwise(NOOP))


def _with_differences(target: DataFrame, src: DataFrame, spec: MergeSpec) -> DataFrame:
    """Target rows whose key the source (rows numbered ``_sid``) has, and for compare
    column i the number ``_d{i}`` of source rows that differ there, with the row ``_o{i}`` if it is one."""
    k, cmp = spec.key, list(enumerate(spec.compare))
    totals = src.groupBy(F.col(k).alias("_k")).agg(
        *[F.count(c).alias(f"_n{i}") for i, c in cmp],
        *[F.bit_xor(F.when(F.col(c).isNotNull(), F.col("_sid"))).alias(f"_x{i}") for i, c in cmp],
    )
    rows = target.join(totals, F.col(k) == F.col("_k")).drop("_k")
    for i, c in cmp:
        same = src.where(F.col(c).isNotNull()).groupBy(F.col(k).alias("_k"), F.col(c).alias("_v"))
        same = same.agg(F.count(F.lit(1)).alias("_c"), F.bit_xor("_sid").alias("_e"))
        rows = rows.join(same, (F.col(k) == F.col("_k")) & (F.col(c) == F.col("_v")), "left")
        differ = F.when(F.col(c).isNull(), 0).otherwise(F.col(f"_n{i}") - F.coalesce("_c", F.lit(0)))
        one = F.col(f"_x{i}").bitwiseXOR(F.coalesce("_e", F.lit(0).cast("long")))
        rows = rows.withColumn(f"_d{i}", differ).withColumn(f"_o{i}", F.when(F.col(f"_d{i}") == 1, one))
        rows = rows.drop("_k", "_v", "_c", "_e", f"_n{i}", f"_x{i}")
    return rows


def _exact_matches(target: DataFrame, src: DataFrame, spec: MergeSpec, cols: list[str]) -> DataFrame:
    """Target rows whose key has several source rows (numbered ``_sid``)."""
    cmp = list(enumerate(spec.compare))
    rows = _with_differences(target, src, spec)
    found = F.array_distinct(F.array_compact(F.array(*[F.col(f"_o{i}") for i, _ in cmp])))
    most = F.greatest(*[F.col(f"_d{i}") for i, _ in cmp], F.lit(0))
    rows = rows.where(assert_that((most <= 1) & (F.size(found) <= 1), MULTI_MATCH_ERROR))
    rows = rows.select(*cols, F.get(found, F.lit(0)).alias("_one"))
    fetched = src.select(F.col("_sid").alias("_id"), F.struct(*cols).alias("_s"))
    rows = rows.join(fetched, F.col("_one") == F.col("_id"), "left")
    return _applied(rows, spec, cols, F.when(F.col("_one").isNull(), NOOP).otherwise(UPDATE))


def change_flags(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """(key, changed): a row per target row whose key the source has; ``changed`` if
    some source row of the key qualifies for the update (F2).

    Counts the source's keys eagerly. Repeated keys go through the merge's counts, so
    no pair of rows is made; rows with a NULL key match nothing."""
    k = spec.key
    src = source.select(k, *spec.compare)
    most = src.where(F.col(k).isNotNull()).groupBy(k).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    if (most or 0) <= 1:
        s = src.select(F.col(k).alias("_k"), F.struct(*spec.compare).alias("_s"))
        rows = target.join(s, target[k] == s["_k"])
        return rows.select(k, changed([F.col(c) for c in spec.compare], [F.col(f"_s.{c}") for c in spec.compare]).alias("changed"))
    rows = _with_differences(target.select(k, *spec.compare), src.withColumn("_sid", F.lit(0).cast("long")), spec)
    return rows.select(k, F.greatest(*[F.col(f"_d{i}") for i in range(len(spec.compare))], F.lit(0)).alias("_d")).select(k, (F.col("_d") > 0).alias("changed"))


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per merge action (M6)."""
    return merged.groupBy(ACTION).agg(F.count(F.lit(1)).alias("rows"))


def merged_rows(merged: DataFrame) -> DataFrame:
    """The table after the merge: drop the action column."""
    return merged.drop(ACTION)
