"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the ``K`` smallest 48-bit hashes of a text's distinct five-word
shingles (a shorter text: its whole word sequence), written as base64 of the
sorted 6-byte values. Sketches of parts merge by keeping the ``K`` smallest of
their union. From two sketches follow estimates of resemblance and containment,
from one the number of distinct shingles; all are exact while fewer than ``K``
shingles exist. A null text reads as empty; two empty sketches resemble by 1,
an empty and another by 0.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.text import shingle_sets, text_slices

K = 128
WIDTH = 5
PART_BYTES = 16 << 20
MAX_PARTS = 1 << 16  # boundaries that the driver and each task hold at most; beyond, parts grow
_SPACE_SIZE = float(1 << 48)


def sketches(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted bottom-k hashes of each text."""
    out: list[np.ndarray] = []
    for part in text_slices(texts):
        hashes, at = shingle_sets(part, width)
        low = hashes >> np.uint64(16)
        out += [np.unique(low[a : min(b, a + 2 * K)])[:K] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    return out


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode("ascii")


def decode(text: str) -> np.ndarray:
    six = np.frombuffer(base64.b64decode(text), dtype=np.uint8).reshape(-1, 6)
    eight = np.zeros((len(six), 8), np.uint8)
    eight[:, 2:] = six
    return eight.view(">u8").ravel().astype(np.uint64)


def merge(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts))[:K] if parts else np.zeros(0, np.uint64)


def distinct_shingles(sketch: np.ndarray) -> float:
    return float(len(sketch)) if len(sketch) < K else (K - 1) * _SPACE_SIZE / float(sketch[-1] + np.uint64(1))


def _shared(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(values of the union's sketch that are in both, size of that sketch)."""
    both = np.concatenate((a, b))
    both.sort()
    twice = np.flatnonzero(both[1:] == both[:-1])
    union = len(both) - len(twice)
    if union <= K:
        return len(twice), union
    return int(np.count_nonzero(twice - np.arange(len(twice)) < K)), K


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    common, size = _shared(a, b)
    return common / size


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has too."""
    if len(a) == 0:
        return 1.0
    common, size = _shared(a, b)
    return min(1.0, common / size * distinct_shingles(merge([a, b])) / distinct_shingles(a))


def fingerprint(text):
    """A sketch column for a text column."""

    @F.arrow_udf("string")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([encode(s) for s in sketches(texts)], pa.string())

    return udf(text.cast("string"))


def merge_by(df: DataFrame, key: str, sketch_col: str) -> DataFrame:
    """(key, sketch, distinct shingles) of the union of each key's texts.

    Merges within each partition first, so a hot key sends a sketch a partition."""
    key_type = df.schema[key].dataType.simpleString()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for batch in batches:
            for k, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = decode(s or "")
                found[k] = merge([found[k], new]) if k in found else new
            if len(found) > 50_000:
                yield packed(found)
                found = {}
        yield packed(found)

    def packed(found: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"k": k, "sketch": encode(s)} for k, s in found.items()], schema=schema)

    def final(table: pa.Table) -> pa.Table:
        s = merge([decode(x) for x in table.column("sketch").to_pylist()])
        return pa.table([table.column("k")[:1], pa.array([encode(s)]), pa.array([distinct_shingles(s)])], names=["k", "sketch", "n_distinct"])

    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("k", to_arrow_type(df.schema[key].dataType)), ("sketch", pa.string())])
    merged = df.select(F.col(key).alias("k"), F.col(sketch_col).alias("sketch")).mapInArrow(partial, f"k {key_type}, sketch string")
    return merged.groupBy("k").applyInArrow(final, f"k {key_type}, sketch string, n_distinct double").withColumnRenamed("k", key)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (part, is_tail, ...): each part's documents in order,
    then the next part's first document once more."""
    last = None
    for batch in batches:
        start = 0
        for texts in text_slices(batch.column("text").fill_null("")):
            rows = batch.slice(start, len(texts))
            start += len(texts)
            ids, tails = rows.column("id").to_pylist(), rows.column("is_tail").to_pylist()
            docs = list(zip(ids, tails, texts.to_pylist(), sketches(texts)))
            if last is not None:
                docs.insert(0, last)
            last = docs[-1]
            pairs = [(a, b) for a, b in zip(docs, docs[1:]) if not a[1]]
            cuts = [len(a[2]) // 4 for a, _ in pairs]
            edited = [a[2][: len(a[2]) - c] + b[2][:c] for (a, b), c in zip(pairs, cuts)]
            new = sketches(pa.array(edited, pa.large_string()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[0] for a, _ in pairs], pa.int64()),
                    pa.array([len(a[2]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited], pa.string()),
                    pa.array([encode(a[3]) for a, _ in pairs], pa.string()),
                    pa.array([encode(s) for s in new], pa.string()),
                    pa.array([resemblance(a[3], s) for (a, _), s in zip(pairs, new)], pa.float64()),
                    pa.array([resemblance(a[3], b[3]) for a, b in pairs], pa.float64()),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of its text with the last quarter
    overwritten from the next document (by id, nulls first, then by a hash of the
    text; after the last comes the first). A lone document is its own next.

    Documents are dealt to ranges of id by boundaries found beforehand (one
    key a ``PART_BYTES`` of text, at most ``MAX_PARTS``, reaches the driver; a range is
    sorted with spilling and read as a stream, so it may grow); each range also gets the
    first document of the next, so texts move once and no range waits for another."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("tie"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = min(MAX_PARTS, size // PART_BYTES + 1)
    order = [F.col("id").asc_nulls_first(), F.col("tie")]
    ranged = rows.select("id", "tie").repartitionByRange(n_parts, *order).withColumn("part", F.spark_partition_id())
    firsts = ranged.groupBy("part").agg(F.min(F.struct(F.col("id").isNotNull().alias("named"), F.coalesce("id", F.lit(0)).alias("id"), "tie")).alias("k"))
    bounds = sorted({tuple(r["k"]) for r in firsts.collect()})

    @F.arrow_udf("struct<part:int,first:boolean>")
    def deal(ids: pa.Array, ties: pa.Array) -> pa.Array:
        keys = [(i is not None, i or 0, t) for i, t in zip(ids.to_pylist(), ties.to_pylist())]
        parts = [max(0, bisect_right(bounds, k) - 1) for k in keys]
        first = [bounds[p] == k for p, k in zip(parts, keys)]
        return pa.StructArray.from_arrays([pa.array(parts, pa.int32()), pa.array(first, pa.bool_())], ["part", "first"])

    m = max(1, len(bounds))
    dealt = rows.withColumn("at", deal("id", "tie"))
    own = F.struct(F.col("at.part").alias("part"), F.lit(False).alias("is_tail"))
    tail = F.struct(F.pmod(F.col("at.part") - 1, F.lit(m)).alias("part"), F.lit(True).alias("is_tail"))
    copies = dealt.withColumn("to", F.explode(F.when(F.col("at.first"), F.array(own, tail)).otherwise(F.array(own))))
    spread = copies.select("to.part", "to.is_tail", "id", "tie", "text").repartitionById(m, F.col("part"))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return spread.sortWithinPartitions("part", "is_tail", *order).mapInArrow(_with_next, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
