"""Benchmark decontamination by SimHash over item-sized windows.

A benchmark item is a sequence of five-word shingles, weighted by rarity among
all items. Its 64-bit SimHash is compared with that of every document window
of the item's length in words. Only windows that hold a shingle of an item of
their size are fingerprinted: no other can verify. A multi-index finds the
items within ``RADIUS`` of a window: the fingerprint is cut into blocks, and two
fingerprints within the radius agree in some block up to ``RADIUS // BLOCKS`` bits.
An item stands once under its value of each block; a window looks up all values that
near its own, or scans the values that there are if these are fewer. Candidates are verified by the
exact weighted Jaccard similarity of the distinct shingles. An item of fewer than five words has its whole
word sequence as its one shingle; it is looked up among all windows of its own number of words.

An index takes about six bytes a byte of item text, and one holds ``MAX_ITEM_BYTES`` of
it, some 70,000 items of the usual length; a larger benchmark takes a pass over the documents for each
such part. Rarity is counted over the whole benchmark beforehand, so results don't depend
on the parts. Null or empty texts match nothing; an item of fewer than five words matches wherever exactly these words
stand in a row. Of a document's windows that fit an item equally the first is reported;
repeated items and rows are reported each; an empty table on either side gives no matches. Case is folded in items and texts by Spark's Unicode
case mapping; the shingle hashes by themselves lower-case A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.columns import own_columns
from keelson.llm.text import buffers, shingle_hashes, shingle_sets, text_slices, word_hashes

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 19  # of 64 bits; a window with weighted Jaccard 0.8 differs in about 10 (sd 3)
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
MAX_ITEM_BYTES = 16 << 20  # item texts indexed at once
WINDOWS_AT_ONCE = 1 << 14  # fingerprinted together, so a very long text needs no more memory
_FILTER_BITS = 22


def folded(text: Column) -> Column:
    """Text in lower case, with ss for ß as its capitals are SS. Words stay in their places.

    Not ``lower(upper(...))``, which the optimizer takes for ``lower(...)``."""
    return F.replace(F.lower(text.cast("string")), F.lit("ß"), F.lit("ss"))


@dataclass
class LengthIndex:
    """The items of one length in words."""

    items: np.ndarray  # positions in the item list
    prints: np.ndarray
    values: list[np.ndarray]  # by block: the items' distinct values, sorted
    starts: list[np.ndarray]  # by block: start of each value's items in ``owners``
    owners: list[np.ndarray]


@dataclass
class ItemIndex:
    ids: list
    shingles: np.ndarray  # sorted distinct shingles of all items
    weights: np.ndarray
    default_weight: float
    maybe: np.ndarray  # bitmap over the low bits of the shingles
    lengths_at: np.ndarray  # shingle -> start in ``lengths``
    lengths: np.ndarray  # the lengths (in shingles) of the items that hold each shingle
    sets: list[np.ndarray]  # distinct sorted shingles of each item
    by_length: dict[int, LengthIndex]
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # words, if fewer than WIDTH: sorted hashes of such items, the items

    def weight(self, shingles: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.shingles, shingles), max(0, len(self.shingles) - 1))
        if len(self.shingles) == 0:
            return np.full(len(shingles), self.default_weight)
        return np.where(self.shingles[at] == shingles, self.weights[at], self.default_weight)


def _bits(shingles: np.ndarray) -> np.ndarray:
    """-1 or 1 for each bit of each hash."""
    return (((shingles[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int8) * 2 - 1).astype(np.float32)


def window_prints(shingles: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of ``size`` consecutive shingles."""
    sums = np.cumsum(_bits(shingles) * weights[:, None], axis=0, dtype=np.float64)
    total = sums[size - 1 :].copy()
    total[1:] -= sums[: len(sums) - size]
    # a bit of weight zero counts as set, whatever the rounding of the running sums
    return ((total > -1e-6).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


@cache
def _near_values() -> np.ndarray:
    flips = [0]
    for k in range(1, RADIUS // BLOCKS + 1):
        flips += [sum(1 << b for b in bits) for bits in combinations(range(BLOCK_BITS), k)]
    return np.array(flips, dtype=np.int64)


def _block_values(prints: np.ndarray, block: int) -> np.ndarray:
    return ((prints >> np.uint64(block * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)


def _length_index(items: np.ndarray, prints: np.ndarray) -> LengthIndex:
    values, starts, owners = [], [], []
    for b in range(BLOCKS):
        own = _block_values(prints, b)
        order = np.argsort(own, kind="stable")
        distinct, first = np.unique(own[order], return_index=True)
        values.append(distinct)
        starts.append(np.append(first, len(own)).astype(np.int32))
        owners.append(order.astype(np.int32))
    return LengthIndex(items, prints, values, starts, owners)


def build_index(ids: list, texts: list[str | None], n_items: int, repeated: dict[int, int]) -> ItemIndex:
    """Index a block of the ``n_items`` items, with folded texts; ``repeated`` has the item counts of
    the block's shingles (as signed values) that more than one item holds."""
    words, word_at, _ = word_hashes(*buffers(pa.array(texts, pa.large_string())))
    hashes, at = shingle_hashes(words, word_at, WIDTH)
    runs = [hashes[a:b] for a, b in zip(at[:-1], at[1:])]
    n_words = np.diff(word_at)
    sets = [np.unique(r) for r in runs]
    known = np.unique(np.concatenate(sets) if sets else hashes)
    df = np.ones(len(known))
    if repeated:
        df[np.searchsorted(known, np.array(list(repeated), np.int64).view(np.uint64))] = list(repeated.values())
    weights = (1 + np.log(n_items / df)) / (1 + np.log(n_items))
    maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
    maybe[(known & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
    # (shingle, length of an item that holds it), distinct; short items are found by their own windows
    whole = [i for i, n in enumerate(n_words.tolist()) if n >= WIDTH]
    pairs = [np.searchsorted(known, sets[i]) << 32 | len(runs[i]) for i in whole]
    held = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    short = {}
    for size in range(1, WIDTH):
        mine = np.flatnonzero(n_words == size)
        own = np.array([runs[i][0] for i in mine.tolist()], np.uint64)
        order = np.argsort(own, kind="stable")
        if len(mine):
            short[size] = own[order], mine[order]
    lengths_at = np.searchsorted(held >> 32, np.arange(len(known) + 1))
    index = ItemIndex(ids, known, weights, 1.0, maybe, lengths_at, held & 0xFFFFFFFF, sets, {}, short)
    prints = [window_prints(r, index.weight(r), len(r))[0] if len(r) else np.uint64(0) for r in runs]
    for size in sorted({len(runs[i]) for i in whole}):
        mine = np.array([i for i in whole if len(runs[i]) == size])
        index.by_length[size] = _length_index(mine, np.array([prints[i] for i in mine], np.uint64))
    return index


def _near(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number in ``wanted``, number in the sorted ``values``) of all pairs of close block values."""
    flips = _near_values()
    at_once, out = max(1, (1 << 22) // min(len(flips), len(values))), []
    for s in range(0, len(wanted), at_once):
        own = wanted[s : s + at_once, None]
        if len(values) <= len(flips):
            w, v = np.nonzero(np.bitwise_count(own ^ values[None, :]) <= RADIUS // BLOCKS)
        else:
            probes = own ^ flips[None, :]
            place = np.minimum(np.searchsorted(values, probes), len(values) - 1)
            w, n = np.nonzero(values[place] == probes)
            v = place[w, n]
        out.append((w + s, v))
    return np.concatenate([w for w, _ in out]), np.concatenate([v for _, v in out])


def _candidates(index: LengthIndex, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (window, item) within the radius, by the multi-index."""
    windows, items = [], []
    for b in range(BLOCKS):
        wanted, back = np.unique(_block_values(prints, b), return_inverse=True)
        near, value = _near(index.values[b], wanted)
        # windows by their block value, then the items of each value near it
        order = np.argsort(back, kind="stable")
        first = np.searchsorted(back[order], np.arange(len(wanted) + 1))
        n = first[near + 1] - first[near]
        w = order[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[near], n)]
        value = np.repeat(value, n)
        lo, m = index.starts[b][value].astype(np.int64), np.diff(index.starts[b])[value].astype(np.int64)
        i = index.owners[b][np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m) + np.repeat(lo, m)]
        w = np.repeat(w, m)
        close = np.bitwise_count(prints[w] ^ index.prints[i]) <= RADIUS
        windows.append(w[close]), items.append(i[close])
    both = np.unique(np.concatenate(windows) * len(index.items) + np.concatenate(items))
    return both // len(index.items), both % len(index.items)


def _short_matches(index: ItemIndex, words: np.ndarray, word_at: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
    for size, (prints, items) in index.short.items():
        hashes, at = shingle_hashes(words, word_at, size)
        lo = np.minimum(np.searchsorted(prints, hashes), len(prints) - 1)
        hit = np.flatnonzero(prints[lo] == hashes)
        doc = np.searchsorted(at, hit, side="right") - 1
        _, first = np.unique(doc * len(prints) + lo[hit], return_index=True)
        for d, p, a in zip(doc[first].tolist(), hit[first].tolist(), lo[hit[first]].tolist()):
            for item in items[a : int(np.searchsorted(prints, prints[a], side="right"))].tolist():
                yield d, item, 1.0, p - int(at[d])


def matches(index: ItemIndex, texts: pa.Array) -> Iterator[tuple[int, int, float, int]]:
    """(text, item, best similarity, first word of that window) of each match of the folded texts."""
    words, word_at, _ = word_hashes(*buffers(texts))
    if len(index.shingles) == 0:
        return
    yield from _short_matches(index, words, word_at)
    hashes, at = shingle_hashes(words, word_at, WIDTH)
    hit = np.flatnonzero(index.maybe[(hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)])
    place = np.minimum(np.searchsorted(index.shingles, hashes[hit]), len(index.shingles) - 1)
    known = index.shingles[place] == hashes[hit]
    hit, place = hit[known], place[known]
    docs = np.searchsorted(at, hit, side="right") - 1
    for s, e in _runs(docs):
        doc = int(docs[s])
        first, n = int(at[doc]), int(at[doc + 1] - at[doc])
        starts_of: dict[int, list] = {}
        for p, g in zip((hit[s:e] - first).tolist(), place[s:e].tolist()):
            for size in index.lengths[index.lengths_at[g] : index.lengths_at[g + 1]].tolist():
                starts_of.setdefault(size, []).append(p)
        best: dict[int, tuple[float, int]] = {}
        for size, positions in starts_of.items():
            width, last = min(size, n), max(0, n - size)
            p = np.array(positions)
            lo, hi = np.clip(p - size + 1, 0, last), np.minimum(p, last)
            of_length = index.by_length[size]
            for a, b in _chunked(_merged(lo, hi)):
                run = hashes[first + a : first + b + width]
                prints = window_prints(run, index.weight(run), width)
                for w, i in zip(*(x.tolist() for x in _candidates(of_length, prints))):
                    item = int(of_length.items[i])
                    sim = similarity(index, np.unique(run[w : w + width]), index.sets[item])
                    if sim >= SIMILARITY and (item not in best or (sim, -(a + w)) > (best[item][0], -best[item][1])):
                        best[item] = (sim, a + w)
        for item, (sim, start) in sorted(best.items()):
            yield doc, item, sim, start


def similarity(index: ItemIndex, a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sets of shingles."""
    common = index.weight(np.intersect1d(a, b, assume_unique=True)).sum()
    return float(common / (index.weight(a).sum() + index.weight(b).sum() - common))


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(values)) + 1
    bounds = [0, *cuts.tolist(), len(values)]
    return ((a, b) for a, b in zip(bounds, bounds[1:]) if a < b)


def _merged(lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, int]]:
    """Overlapping or adjoining intervals of window starts as one each."""
    order = np.argsort(lo, kind="stable")
    a, b = None, None
    for x, y in zip(lo[order].tolist(), hi[order].tolist()):
        if a is None:
            a, b = x, y
        elif x <= b + 1:
            b = max(b, y)
        else:
            yield a, b
            a, b = x, y
    if a is not None:
        yield a, b


def _chunked(spans: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    for a, b in spans:
        for start in range(a, b + 1, WINDOWS_AT_ONCE):
            yield start, min(b, start + WINDOWS_AT_ONCE - 1)


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        start = 0
        for texts in text_slices(batch.column("text")):
            part = batch.slice(start, len(texts))
            start += len(texts)
            hashes, at = shingle_sets(texts, WIDTH)
            of = pa.array(np.repeat(np.arange(len(texts)), np.diff(at)))
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(of), part.column("rows").take(of), pa.array(hashes.view(np.int64))], names=["key", "rows", "shingle"]
            )


def _with_repeated(items: DataFrame) -> DataFrame:
    """Adds to each item the shingles that it shares with others, as (shingle, n):
    n items hold it."""
    keyed = items.withColumn("key", F.xxhash64("text"))
    texts = keyed.filter("text is not null").groupBy("key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("rows"))
    shingles = texts.mapInArrow(_item_shingles, "key long, rows long, shingle long")
    counts = shingles.groupBy("shingle").agg(F.sum("rows").alias("n")).filter("n > 1")
    shared = shingles.join(counts, "shingle").groupBy("key").agg(F.collect_list(F.struct("shingle", "n")).alias("repeated"))
    return keyed.join(shared, "key", "left").drop("key")


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[ItemIndex]:
    """Indexes of the items, ``MAX_ITEM_BYTES`` of text at a time."""
    ids, texts, repeated, size = [], [], {}, 0
    items = benchmark.select(F.col(id_col).alias("id"), folded(F.col(text_col)).alias("text"))
    n_items = items.count()
    for item, text, shared in _with_repeated(items).orderBy("id", "text").toLocalIterator():
        n = len((text or "").encode())
        if texts and size + n > MAX_ITEM_BYTES:
            yield build_index(ids, texts, n_items, repeated)
            ids, texts, repeated, size = [], [], {}, 0
        ids.append(item), texts.append(text)
        repeated.update(shared or [])
        size += n
    if texts:
        yield build_index(ids, texts, n_items, repeated)


def find_leaks(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word): a row per document row and
    item that it holds, with the best window."""
    found = None
    for index in item_blocks(benchmark, item_id_col, item_text_col):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                start = 0
                for texts in text_slices(batch.column("text")):
                    ids = batch.column("id").slice(start, len(texts))
                    start += len(texts)
                    rows = list(matches(shared.value, texts))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array([r[0] for r in rows], pa.int64())),
                            pa.array([shared.value.ids[r[1]] for r in rows], pa.int64()),
                            pa.array([r[2] for r in rows], pa.float64()),
                            pa.array([r[3] for r in rows], pa.int64()),
                        ],
                        names=["doc_id", "item_id", "similarity", "first_word"],
                    )

        rows = docs.select(F.col(id_col).cast("long").alias("id"), folded(F.col(text_col)).alias("text"))
        part = rows.mapInArrow(run, "doc_id long, item_id long, similarity double, first_word long")
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], "doc_id long, item_id long, similarity double, first_word long") if found is None else found


def leaks(spark: SparkSession, index: ItemIndex, text: Column) -> Column:
    """Number of the index's items that a text column's texts hold."""
    shared = spark.sparkContext.broadcast(index)

    @F.arrow_udf("int")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            counts, start = np.zeros(len(texts), np.int32), 0
            for part in text_slices(texts):
                for doc, *_ in matches(shared.value, part):
                    counts[start + doc] += 1
                start += len(part)
            yield pa.array(counts, pa.int32())

    return udf(folded(text))


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; no shuffle."""
    for index in item_blocks(benchmark, item_id_col, item_text_col):
        docs = docs.select(*own_columns(docs), leaks(spark, index, F.col(text_col)).alias("__leaks"))
        docs = docs.filter("__leaks = 0").drop("__leaks")
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
