"""Quality classifier by importance resampling.

Two generative models over hashed word unigrams and bigrams, one counted on
target text (labelled good), one on all raw text; a document's log importance
weight is the sum of the log ratios of its n-grams. Adding Gumbel noise seeded
by the document's id and keeping the k largest samples without replacement in
proportion to the weights. k is a share of all rows, by default the share of
good labels. Raw counts and the top-k threshold cover every row; the target
model uses up to ``max_target`` good rows (those with the smallest hash of id).

Exactly k rows are kept (all, if there are fewer). Noise is a function of id and text,
so rows that repeat both tie; of the rows that tie with the k-th, those that stand first in the
table as written are kept, as many as it takes. A null or empty text has weight 0; a null id
is a value like any other. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.text import buffers, mix64, text_slices, word_hashes
from keelson.session import materialise

BUCKETS = 10_000


def ngram_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words and of the word pairs, each with the text they are of."""
    words, at, _ = word_hashes(*buffers(texts))
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    pair = mix64(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    within = doc[1:] == doc[:-1]
    n = np.uint64(BUCKETS)
    return (words % n).astype(np.int64), doc, (pair[within] % n).astype(np.int64), doc[:-1][within]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = batch.column("good").to_numpy(zero_copy_only=False).astype(bool)
        start = 0
        for texts in text_slices(batch.column("text")):
            mine = good[start : start + len(texts)]
            start += len(texts)
            one, doc1, two, doc2 = ngram_buckets(texts)
            raw += np.bincount(one, minlength=BUCKETS) + np.bincount(two, minlength=BUCKETS)
            if mine.any():
                target += np.bincount(one[mine[doc1]], minlength=BUCKETS) + np.bincount(two[mine[doc2]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, good_ids: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """log(target frequency / raw frequency) of each hash bucket, add-one smoothed."""
    good = F.broadcast(good_ids.select(F.col(id_col).alias("id"), F.lit(True).alias("good")))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(good, "id", "left")
    counted = rows.select("text", F.coalesce("good", F.lit(False)).alias("good")).mapInArrow(_count, "bucket long, raw long, target long")
    sums = counted.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()  # at most BUCKETS rows
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for bucket, r, t in sums:
        raw[bucket] += r
        target[bucket] += t
    if target.sum() == BUCKETS:  # nothing is labelled good
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weight(spark: SparkSession, ratios: np.ndarray, text: Column) -> Column:
    shared = spark.sparkContext.broadcast(ratios)

    @F.arrow_udf("double")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = [np.zeros(0)]
            for part in text_slices(texts):
                one, doc1, two, doc2 = ngram_buckets(part)
                r = shared.value
                out.append(np.bincount(doc1, r[one], len(part)) + np.bincount(doc2, r[two], len(part)))
            yield pa.array(np.concatenate(out), pa.float64())

    return udf(text.cast("string"))


def gumbel(seed: int, *of: Column) -> Column:
    """Standard Gumbel noise as a function of the columns and the seed."""
    unit = (F.shiftrightunsigned(F.xxhash64(*of, F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(unit))


def kth_largest(rows: DataFrame, value: str, k: int, cells: int = 1024) -> float | None:
    """Exact k-th largest value, by counting ever finer cells of its range;
    the driver sees at most ``cells`` counts a round."""
    low, high, n = rows.agg(F.min(value), F.max(value), F.count(value)).first()
    if not n or k <= 0:
        return None
    k = min(k, n)
    while low < high:
        inside = rows.filter((F.col(value) >= F.lit(low)) & (F.col(value) <= F.lit(high)))
        cell = F.least(F.floor((F.col(value) - F.lit(low)) / F.lit((high - low) / cells or high - low)), F.lit(cells)).cast("int")
        counts = inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        found = False
        for _, n, cell_low, cell_high in sorted(counts.collect(), reverse=True):
            if k <= n:
                found, low, high = (low, high) != (cell_low, cell_high), cell_low, cell_high
                break
            k -= n
        if not found:  # cells can't part these values any more
            values = inside.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc(value)).limit(cells).collect()
            for v, n in values:
                if k <= n:
                    return v
                k -= n
    return low


def resample(
    spark: SparkSession, docs: DataFrame, good_ids: DataFrame, share: float, id_col: str = "doc_id", text_col: str = "text", seed: int = 11,
) -> DataFrame:
    """(id, log_weight, gumbel_score, selected) for every row of ``docs``: ceil(share * rows) are selected."""
    ratios = log_ratios(docs, good_ids, id_col, text_col)
    text = F.col(text_col).cast("string")
    weighed = docs.select(F.col(id_col).alias("id"), log_weight(spark, ratios, F.col(text_col)).alias("log_weight"), gumbel(seed, F.col(id_col), text).alias("noise"))
    weighed = weighed.select("id", "log_weight", (F.col("log_weight") + F.col("noise")).alias("gumbel_score"), (-F.monotonically_increasing_id().cast("double")).alias("place"))
    weighed = materialise(spark, weighed, "resample")
    k = int(np.ceil(share * weighed.count()))
    cut = kth_largest(weighed, "gumbel_score", k)
    chosen = F.lit(False)
    if cut is not None:
        tied = weighed.filter(F.col("gumbel_score") == F.lit(cut))
        room = k - weighed.filter(F.col("gumbel_score") > F.lit(cut)).count()
        last = kth_largest(tied, "place", room)
        chosen = (F.col("gumbel_score") > F.lit(cut)) | ((F.col("gumbel_score") == F.lit(cut)) & (F.col("place") >= F.lit(last)))
    return weighed.withColumn("selected", chosen).drop("place")


def good_rows(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_target: int = 20_000) -> tuple[DataFrame, float]:
    """(ids of up to ``max_target`` good rows, share of good among the labelled)."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col)).agg(F.max((F.col(label_col) == 1).cast("int")).alias("__good"))
    share = known.agg(F.avg("__good")).first()[0]
    ids = known.filter("__good = 1").orderBy(F.xxhash64(id_col), id_col).limit(max_target).select(id_col)
    return ids, 1.0 if share is None else share


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ids, share = good_rows(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    return resample(spark, docs, ids, share).withColumnRenamed("id", "doc_id")
