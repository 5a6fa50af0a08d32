"""Sharding by histogram sort.

Documents are ordered by (hash of the text, id). The splitters between shards are
found by counting: each round sums the exact bytes below candidate boundaries,
``CELLS`` to an interval, in one pass over (hash, id, size) that all splitters share,
and keeps the cell in which a splitter's target lies. A splitter is settled when that
cell holds at most ``tolerance`` of a shard; within a single hash (equal texts) the
search goes on over the ids, so a group of copies that outweighs a shard is cut.
Then the rows are exchanged once, each to its range.

A shard's ``slot`` numbers its rows from 0 without gaps, in ranges of about
``part_bytes``, counted separately. Size is the text's UTF-8 bytes (null: none)
plus 1. Null ids come first. Rows with equal text and id share their place in the
order, so they stay in one shard.

``cut_in_order`` keeps a given order instead: by the same search, each shard is a stretch of it,
and its slots follow it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm.columns import own_columns, row_hash
from keelson.session import materialise

CELLS = 256
TOLERANCE = 0.0005  # of a shard
PART_BYTES = 16 << 20
_TOP = 1 << 63  # hashes are 0 .. 2^63 - 1


def _text_hash(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text.cast("string")), 1)


def _size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long") + 1


def _cell(value: str, low: int, step: int) -> Column:
    """(value - low) div step, without overflow for any pair of longs."""
    if abs(low) < 1 << 62:
        return F.expr(f"({value} - ({low}L)) div {step}L")
    return F.expr(f"cast((cast({value} as decimal(20)) - ({low})) div {step} as bigint)")


class _Search:
    """One splitter's interval: of hashes, or of ids within one hash."""

    def __init__(self, target: float, below: int):
        self.target, self.below = target, below
        self.hash: int | None = None
        self.low, self.high = 0, _TOP
        self.at: tuple[int, int | None] | None = None  # first (hash, id) above; id None: any

    def key(self) -> tuple:
        return (-1 if self.hash is None else self.hash, self.low, self.high)

    def step(self) -> int:
        return -(-(self.high - self.low) // CELLS)

    def narrow(self, cells: dict[int, int], tolerance: float) -> None:
        at, found = self.below, max(cells)
        for cell in sorted(cells):
            if at + cells[cell] >= self.target:
                found = cell
                break
            at += cells[cell]
        else:
            at -= cells[found]
        step = self.step()
        self.below = at
        self.low, self.high = self.low + found * step, min(self.high, self.low + (found + 1) * step)
        if cells[found] <= tolerance or (self.high - self.low == 1 and self.hash is not None):
            edge = self.low if self.target - at <= at + cells[found] - self.target else self.high
            self.at = (edge, None) if self.hash is None else (self.hash, edge)


def find_splitters(keys: DataFrame, n_shards: int, tolerance: float) -> list[tuple[int, int | None]]:
    """``keys`` has columns h, id, size. The first (h, id) of shards 1, 2, ..."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    searches = [_Search(total * i / n_shards, 0) for i in range(1, n_shards)]
    if total == 0:
        return [(_TOP - 1, None)] * (n_shards - 1)
    allowed = tolerance * total / n_shards
    while open_ := [s for s in searches if s.at is None]:
        single = [s for s in open_ if s.hash is None and s.high - s.low == 1]
        if single:  # equal texts weigh more than is allowed: go on over their ids
            held = sorted({s.low for s in single})
            spans = {r["h"]: r for r in keys.filter(F.col("h").isin(held)).groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("high")).collect()}
            for s in single:
                s.hash, s.low, s.high = s.low, spans[s.low]["low"], spans[s.low]["high"] + 1
        intervals = sorted({s.key() for s in open_})
        group, cell = F.lit(None).cast("int"), F.lit(None).cast("long")
        for n, (h, low, high) in enumerate(intervals):
            value = F.col("h") if h < 0 else F.col("id")
            inside = (value >= F.lit(low)) & (value <= F.lit(high - 1))
            inside = inside if h < 0 else inside & (F.col("h") == F.lit(h))
            step = -(-(high - low) // CELLS)
            group = F.when(inside, F.lit(n)).otherwise(group)
            cell = F.when(inside, _cell("h" if h < 0 else "id", low, step)).otherwise(cell)
        counted = keys.select(group.alias("g"), cell.cast("long").alias("cell"), "size").filter("g is not null")
        sums: dict[int, dict[int, int]] = {}
        for g, c, n in counted.groupBy("g", "cell").agg(F.sum("size")).collect():  # at most CELLS rows an interval
            sums.setdefault(g, {})[c] = n
        for s in open_:
            s.narrow(sums[intervals.index(s.key())], allowed)
    return [s.at for s in searches]


def shard_of(splitters: list[tuple[int, int | None]], h: Column, ident: Column) -> Column:
    shard = F.lit(0)
    for low, least in splitters:
        above = (h >= F.lit(low)) if least is None else (h > F.lit(low)) | ((h == F.lit(low)) & (ident >= F.lit(least)))
        shard = shard + above.cast("int")
    return shard


def _numbered(rows: DataFrame, keys: DataFrame, splitters: list, part_bytes: int) -> DataFrame:
    """Adds shard and slot to ``rows`` (columns h, id, size, tie and others); rows of equal
    h and id go by ``tie``, so a rerun numbers them alike. The
    ranges and their counts come from ``keys``, whose rows are the same."""
    edges = [0, *[s[0] for s in splitters], _TOP]
    shards = keys.select(shard_of(splitters, F.col("h"), F.col("id")).alias("shard"), "size")
    sizes = {r["shard"]: r["bytes"] for r in shards.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
    width = F.lit(1).cast("long")
    start = F.lit(0).cast("long")
    for n in range(len(edges) - 1):
        count = max(1, sizes.get(n, 0) // part_bytes)
        width = F.when(F.col("shard") == n, F.lit(min((edges[n + 1] - edges[n]) // count + 1, _TOP - 1))).otherwise(width)
        start = F.when(F.col("shard") == n, F.lit(edges[n])).otherwise(start)

    def placed(df: DataFrame) -> DataFrame:
        df = df.withColumn("shard", shard_of(splitters, F.col("h"), F.col("id")))
        df = df.withColumn("start", start).withColumn("width", width)
        return df.withColumn("cell", F.expr("(h - start) div width")).drop("start", "width")

    cells = placed(keys).groupBy("shard", "cell").agg(F.sum("size").alias("bytes"), F.min("id").alias("low_id"), F.max("id").alias("high_id"))
    cells = cells.withColumn("pieces", F.greatest(F.lit(1), F.expr(f"bytes div {2 * part_bytes}L")))
    # a heavy cell (copies of one text) is cut by id; halves, so that the span can't overflow
    cells = cells.withColumn("id_width", F.expr("(high_id div 2 - low_id div 2) div pieces + 1")).select("shard", "cell", "low_id", "id_width")
    cells = materialise(keys.sparkSession, cells, "shard-cells")

    def pieced(df: DataFrame) -> DataFrame:
        df = placed(df).join(cells, ["shard", "cell"])
        return df.withColumn("piece", F.expr("(id div 2 - low_id div 2) div id_width")).drop("low_id", "id_width")

    counts = pieced(keys).groupBy("shard", "cell", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell", "piece").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "cell", "piece", F.coalesce(before, F.lit(0)).alias("offset"))
    offsets = materialise(keys.sparkSession, offsets, "shard-offsets")
    place = F.row_number().over(Window.partitionBy("shard", "cell", "piece").orderBy("h", "id", "tie"))
    numbered = pieced(rows).withColumn("place", place).join(offsets, ["shard", "cell", "piece"])
    return numbered.withColumn("slot", (F.col("place") - 1 + F.col("offset")).cast("long")).drop("place", "offset", "cell", "piece", "tie")


def histogram_sort(
    spark: SparkSession,
    docs: DataFrame,
    n_shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = TOLERANCE,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """A row per row of ``docs``: its columns as the struct ``row``, with h, id,
    size, shard and slot. An empty table gives no rows."""
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    keyed = docs.select(
        _text_hash(F.col(text_col)).alias("h"), ident.alias("id"), _size(F.col(text_col)).alias("size"), row_hash(docs).alias("tie"), F.struct(*own_columns(docs)).alias("row")
    )
    keys = materialise(spark, keyed.select("h", "id", "size"), "shard-keys")
    return _numbered(keyed, keys, find_splitters(keys, n_shards, tolerance), part_bytes)


def cut_in_order(
    spark: SparkSession, placed: DataFrame, n_shards: int = 8, text_col: str = "text", tolerance: float = TOLERANCE, part_bytes: int = PART_BYTES
) -> DataFrame:
    """A row per row of ``placed`` (a struct ``row`` and its ``position``, each from 0 up held once), with size, shard
    and slot: by shard and slot, the rows go by position. An empty table gives no rows."""
    last = placed.agg(F.max("position")).first()[0] or 0
    spread = F.col("position") * ((_TOP - 1) // (last + 1))  # over the range of the hashes
    keyed = placed.select(spread.alias("h"), F.col("position").alias("id"), _size(F.col("row")[text_col]).alias("size"), F.lit(0).alias("tie"), "row")
    keys = materialise(spark, keyed.select("h", "id", "size"), "shard-keys")
    return _numbered(keyed, keys, find_splitters(keys, n_shards, tolerance), part_bytes)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.col("text")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    keyed = docs.select(
        _text_hash(text).alias("h"), F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("id"), "doc_id", _size(text).alias("size"), crc.alias("text_crc32"), F.lit(0).alias("tie")
    )
    keyed = materialise(spark, keyed, "shard-rows")
    keys = keyed.select("h", "id", "size")
    return _numbered(keyed, keys, find_splitters(keys, 8, TOLERANCE), PART_BYTES).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
