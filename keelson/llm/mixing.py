"""Mixing sources to target weights by Pfair scheduling.

A source's rows form blocks of ``block_rows``. Time runs in rounds: in each, a source
advances by its real weight, its target share times ``slots``. Its block n (from 0) falls
in round floor((n + phase) / weight), so after any number of rounds it has got its target
to within one block, however small its share or many the sources; nothing is rounded
to a number of slots. Phases are spread evenly over the sources in the order of their
weights, so sources with less than a block a round take turns.

In a round of q blocks, a source with a blocks there has its k-th (from 0) released at
slot floor(k q / a) with deadline ceil((k + 1) q / a). Earliest deadline first among the
released blocks fills every slot, and at each point of the round each source has got its
part of the round to within less than one block. Rounds are scheduled apart from each
other, each folded by SQL's ``aggregate`` over the sources it holds.

A source that runs out leaves the rounds, which get shorter, so every row is placed and
no slot stays empty. Weight 0 (also negative, NaN, infinite, or a share below 1e-9)
means: after all rows of the sources with a weight, evenly among each other.

Rows are numbered within a source by a hash of their id and text, counted in
buckets of bounded size, so a hot source is never sorted whole. Weights: the given
table (source, weight), else the sources' row counts to the power ``alpha``; a source
that the table lacks has its smallest weight above 0, and a null source is a source. Rows of equal
id and text go by a hash of all their columns, so a rerun places them alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm.columns import own_columns, row_hash
from keelson.session import materialise

SLOTS = 256
BLOCK_ROWS = 16
BUCKET_ROWS = 2_000
LEAST_SHARE = 1e-9
BLOCKS_AT_ONCE = 1 << 16  # of a source, listed by one task
ROUNDS_AT_ONCE = 1 << 12  # added up by one task
GOLDEN = (5**0.5 - 1) / 2


def _weights(counts: DataFrame, weights: DataFrame | None, alpha: float, slots: int, block_rows: int) -> DataFrame:
    """A row per source: its rows, blocks, buckets, weight a round, phase and whether it
    comes ``last``, after the sources with a weight."""
    all_sources = Window.partitionBy()
    if weights is None:
        weighed = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(alpha)))
    else:
        given = weights.select(F.col("source").cast("string").alias("given"), F.col("weight").cast("double").alias("w"))
        least = F.broadcast(given.agg(F.min(F.when(F.col("w") > 0, F.col("w"))).alias("least")))
        weighed = counts.join(given, F.col("source").eqNullSafe(F.col("given")), "left").crossJoin(least)
        weighed = weighed.withColumn("w", F.when(F.col("given").isNull() & F.col("w").isNull(), F.col("least")).otherwise(F.col("w"))).drop("given", "least")
    weighed = weighed.withColumn("w", F.when((F.col("w") > 0) & (F.col("w") < float("inf")), F.col("w")).otherwise(0.0))
    total = F.sum("w").over(all_sources)
    weighed = weighed.withColumn("last", F.when(total > 0, F.col("w") / total < LEAST_SHARE).otherwise(True))
    weighed = weighed.withColumn("w", F.when(F.col("last"), F.lit(1.0)).otherwise(F.col("w")))
    weighed = weighed.withColumn("w", F.col("w") / F.sum("w").over(Window.partitionBy("last")) * slots)
    rank = F.row_number().over(Window.partitionBy("last").orderBy(F.desc("w"), "source"))
    return (
        weighed.withColumn("phase", (rank * GOLDEN) % 1)
        .withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("long"))
        .withColumn("buckets", F.ceil(F.col("n") / BUCKET_ROWS).cast("long"))
    )


def _round_of(block: Column) -> Column:
    return F.floor((block + F.col("phase")) / F.col("w")).cast("long")


def _rounds(sources: DataFrame) -> DataFrame:
    """A row per source and round that holds blocks of it: the first of them and how many."""
    ends = sources.filter(~F.col("last")).agg(F.coalesce(F.max(_round_of(F.col("blocks") - 1) + 1), F.lit(0).cast("long")).alias("end"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(blocks - 1) div {BLOCKS_AT_ONCE}"))).alias("part")
    parts = sources.crossJoin(F.broadcast(ends)).select("number", "w", "phase", "blocks", F.when(F.col("last"), F.col("end")).otherwise(0).alias("begin"), part)
    first = F.col("part") * BLOCKS_AT_ONCE
    block = F.explode(F.sequence(first, F.least(first + BLOCKS_AT_ONCE, F.col("blocks")) - 1)).alias("source_block")
    blocks = parts.repartition("number", "part").select("number", "w", "phase", "begin", block)
    rounds = blocks.select("number", "source_block", (F.col("begin") + _round_of(F.col("source_block"))).alias("round"))
    return rounds.groupBy("round", "number").agg(F.min("source_block").alias("first"), F.count(F.lit(1)).alias("a"))


def _schedule(rounds: DataFrame) -> DataFrame:
    """(number, source_block, round, release, deadline, block_position): a row per block."""
    held = F.sort_array(F.collect_list(F.struct("number", "first", "a")))
    whole = rounds.groupBy("round").agg(held.alias("s"), F.sum("a").alias("slots")).withColumn("c", F.col("s.a"))
    stretch = F.expr(f"round div {ROUNDS_AT_ONCE}")
    lengths = rounds.groupBy("round").agg(F.sum("a").alias("slots")).withColumn("stretch", stretch)
    so_far = lambda w: F.coalesce(F.sum("slots").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    stretches = lengths.groupBy("stretch").agg(F.sum("slots").alias("slots"))
    stretches = stretches.select("stretch", so_far(Window.partitionBy().orderBy("stretch")).alias("before"))
    starts = lengths.withColumn("within", so_far(Window.partitionBy("stretch").orderBy("round")))
    starts = starts.join(stretches, "stretch").select("round", (F.col("before") + F.col("within")).alias("start"))
    fold = """
        aggregate(
          sequence(0L, slots - 1),
          struct(transform(c, x -> 0L) AS done, cast(array() AS array<int>) AS picked),
          (acc, t) -> transform(
            array(array_min(filter(
              transform(c, (a, i) -> struct(
                CASE WHEN a > acc.done[i] AND (acc.done[i] * slots) div a <= t
                     THEN ((acc.done[i] + 1) * slots + a - 1) div a
                END AS deadline, i AS i)),
              x -> x.deadline IS NOT NULL)).i),
            pick -> struct(
              transform(acc.done, (d, i) -> if(i = pick, d + 1, d)) AS done,
              array_append(acc.picked, pick) AS picked))[0],
          acc -> acc.picked)"""
    slotted = whole.withColumn("picked", F.expr(fold)).join(starts, "round").select("round", "start", "slots", "s", F.posexplode("picked").alias("slot", "pick"))
    slotted = slotted.select("round", "start", "slots", "slot", F.expr("s[pick]").alias("s")).select("round", "start", "slots", "slot", "s.*")
    k = (F.row_number().over(Window.partitionBy("round", "number").orderBy("slot")) - 1).cast("long")
    return slotted.withColumn("k", k).select(
        "number",
        (F.col("first") + F.col("k")).alias("source_block"),
        "round",
        (F.col("start") + F.expr("k * slots div a")).alias("release"),
        (F.col("start") + F.expr("((k + 1) * slots + a - 1) div a")).alias("deadline"),
        (F.col("start") + F.col("slot")).alias("block_position"),
    )


def mix(
    spark: SparkSession,
    docs: DataFrame,
    weights: DataFrame | None = None,
    alpha: float = 0.5,
    slots: int = SLOTS,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """A row per row of ``docs``: its columns as the struct ``row``, with source_block
    (from 0), round, release, deadline, block_position (from 0 over all blocks, gapless)
    and row_in_block."""
    source = F.col(source_col).cast("string")
    number_of = F.xxhash64(F.col(id_col), F.col(text_col).cast("string"))
    counts = docs.select(source.alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    sources = _weights(counts, weights, alpha, slots, block_rows)
    sources = sources.withColumn("number", (F.row_number().over(Window.partitionBy().orderBy("source")) - 1).cast("int"))
    columns = [F.col("source").alias("mix_source"), "number", "blocks", "buckets", "w", "phase", "last"]
    sources = materialise(spark, sources.select(*columns), "mix-sources")
    rounds = materialise(spark, _rounds(sources), "mix-rounds")
    schedule = materialise(spark, _schedule(rounds), "mix-schedule")

    keyed = docs.select(source.alias("mix_source"), number_of.alias("h"), row_hash(docs).alias("tie"), F.struct(*own_columns(docs)).alias("row"))

    def bucketed(df: DataFrame) -> DataFrame:
        known = sources.select(F.col("mix_source").alias("known_source"), "number", "buckets")
        joined = df.join(known, F.col("mix_source").eqNullSafe(F.col("known_source"))).drop("known_source", "mix_source")
        return joined.withColumn("bucket", F.pmod(F.col("h"), F.col("buckets")))

    filled = bucketed(keyed.select("mix_source", "h")).groupBy("number", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = materialise(spark, filled.select("number", "bucket", F.coalesce(before, F.lit(0)).alias("offset")), "mix-offsets")
    place = F.row_number().over(Window.partitionBy("number", "bucket").orderBy("h", "tie"))
    rows = bucketed(keyed).withColumn("place", place).join(offsets, ["number", "bucket"])
    at = F.col("place") - 1 + F.col("offset")
    rows = rows.select(
        "row",
        "number",
        F.expr(f"(place - 1 + offset) div {block_rows}").alias("source_block"),
        (at % block_rows).cast("int").alias("row_in_block"),
    )
    return rows.join(schedule, ["number", "source_block"]).select(
        "row", "source_block", "round", "release", "deadline", "block_position", "row_in_block"
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows' own columns, range-partitioned and sorted in mixed order, so that
    files written from it read in that order."""
    order = ["block_position", "row_in_block"]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    mixed = mix(spark, docs)
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "source_block", "round", "release", "deadline", "block_position", "row_in_block"
    )

