"""Filter interaction audit: what each filter removes, in every order of the filters.

Each document is judged by all filters at once and becomes a 32-bit truth-table
word: bit ``s`` is set if the document survives the subset ``s`` of the five filters
(bit ``i`` of ``s`` stands for filter ``i``). Positional popcounts of these words, made
by carry-save adders over bit-sliced counters, are the survivors of each of the 32
subsets by part and label. They add up over tasks, and every figure of the report
follows from them: 32 numbers a part and label class, however many documents.

Filters of :func:`failures` (a null text reads as empty; words are the maximal runs of
``[^\\x20\\x09-\\x0D]``, case-sensitive), by failure condition:

* A: fewer than 200 words;
* B: ``100 * distinct words < 50 * words`` (a text without words passes);
* C: ``100 * [A-Z] characters > 3 * code points`` (an empty text passes);
* D: holds any of ``#$%&*|``;
* E: the same text stands under a smaller id anywhere in the table. Rows of one id
  don't condemn each other; a row with a null id passes, and condemns none.

Repeated rows count each. A document is good (toxic) if any label row of its id has
quality 1 (toxic 1); a null id has no labels. A null part counts as the empty string. An
empty table has no parts and gives no rows. Only the columns named are read, and they are
renamed before anything else, so extra columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.text import buffers, text_slices, word_hashes
from keelson.session import materialise

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
MAX_GROUPS = 10_000  # (part, label) groups that a task holds before it sends them on
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"#$%&*|")] = True


def truth_words(failed: np.ndarray) -> np.ndarray:
    """The 32-bit survival word of each 5-bit mask of failed filters."""
    subsets = np.arange(SUBSETS, dtype=np.uint32)
    table = np.array([np.bitwise_or.reduce(np.uint32(1) << subsets[(subsets & m) == 0]) for m in range(SUBSETS)], np.uint32)
    return table[failed]


def _bit_counts(words: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(words.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def positional_popcount(words: np.ndarray, lanes: int = 256) -> np.ndarray:
    """How many of the words have each of the 32 bits set.

    ``lanes`` words are added at a time into bit-sliced counters: plane ``k`` holds bit
    ``k`` of all 32 x lanes counts. A carry-save adder takes two words and a plane to a
    sum and a carry, so most words never have their bits spread out; a plane is counted
    once for every 16 rows of words."""
    total = np.zeros(32, np.int64)
    whole = len(words) // (16 * lanes) * 16 * lanes
    ones, twos, fours, eights = (np.zeros(lanes, np.uint32) for _ in range(4))

    def add(plane: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = plane ^ a
        return half ^ b, (plane & a) | (half & b)

    for block in words[:whole].reshape(-1, 16, lanes):
        eighths = []
        for e in range(2):
            quarters = []
            for q in range(2):
                pairs = []
                for p in range(2):
                    at = 8 * e + 4 * q + 2 * p
                    ones, carry = add(ones, block[at], block[at + 1])
                    pairs.append(carry)
                twos, carry = add(twos, *pairs)
                quarters.append(carry)
            fours, carry = add(fours, *quarters)
            eighths.append(carry)
        eights, sixteens = add(eights, *eighths)
        total += 16 * _bit_counts(sixteens)
    for weight, plane in ((8, eights), (4, fours), (2, twos), (1, ones), (1, words[whole:])):
        total += weight * _bit_counts(plane)
    return total


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subset survivors of each (part, label class), a task's groups at a time."""
    found: dict[tuple[str, int], np.ndarray] = {}

    def packed() -> pa.RecordBatch:
        keys = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([v.tolist() for v in found.values()], pa.list_(pa.int64()))],
            names=["part", "label", "alive"],
        )

    for batch in batches:
        coded = batch.column("part").dictionary_encode()
        names = coded.dictionary.to_pylist()
        group = coded.indices.to_numpy().astype(np.int64) * 4 + batch.column("label").to_numpy()
        words = truth_words(batch.column("failed").to_numpy())
        order = np.argsort(group, kind="stable")
        keys, starts = np.unique(group[order], return_index=True)
        for key, mine in zip(keys.tolist(), np.split(words[order], starts[1:])):
            at = (names[key // 4], key % 4)
            counts = positional_popcount(mine)
            found[at] = found[at] + counts if at in found else counts
        if len(found) >= MAX_GROUPS:
            yield packed()
            found.clear()
    yield packed()


def subset_survivors(judged: DataFrame) -> DataFrame:
    """(part, label, alive): ``alive[s]`` documents of the part and label class survive subset ``s``.

    ``judged`` has part (string), label (int 0 to 3) and failed (int mask)."""
    partial = judged.select("part", "label", "failed").mapInArrow(_count, "part string, label int, alive array<long>")
    sums = [F.sum(F.get("alive", F.lit(s))) for s in range(SUBSETS)]
    return partial.groupBy("part", "label").agg(F.array(*sums).alias("alive"))


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[offsets])


def own_failures(texts: pa.Array) -> np.ndarray:
    """Masks of the filters that look at one text alone (A to D). Words are told apart by 64-bit hashes."""
    masks = [np.zeros(0, np.int32)]
    for part in text_slices(texts):
        raw, offsets = buffers(part)
        hashes, at, _ = word_hashes(raw, offsets, fold=False)
        n = np.diff(at)
        distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], np.int64)
        points = _sums((raw & 0xC0) != 0x80, offsets)
        fails = (n < 200, 100 * distinct < 50 * n, 100 * _sums(_CAPITAL[raw], offsets) > 3 * points, _sums(_MARK[raw], offsets) > 0)
        masks.append(sum(f.astype(np.int32) << i for i, f in enumerate(fails)))
    return np.concatenate(masks)


def own_mask(text: Column) -> Column:
    @F.arrow_udf("int")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(own_failures(texts), pa.int32())

    return udf(text)


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, failed): the mask of failed filters of every row of ``docs``.

    Texts are read once; what goes on is a narrow table with a SHA-256 of the text. Of
    the texts that stand under several ids the smallest id is found by an aggregate that
    combines map-side, and joined back to rows without texts, so a third of all rows
    sharing one text is a skewed join key that adaptive execution splits."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    narrow = materialise(spark, rows.select("id", "part", own_mask(F.col("text")).alias("own"), F.unhex(F.sha2("text", 256)).alias("text")), "audit")
    ids = narrow.groupBy("text").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    several = ids.filter("first < last").select(F.col("text").alias("again"), "first")
    joined = narrow.join(several, F.col("text") == F.col("again"), "left")
    copy = F.when(F.col("first") < F.col("id"), 1 << FILTERS.index("E")).otherwise(0)
    return joined.select("id", "part", F.col("own").bitwiseOR(copy).cast("int").alias("failed"))


def with_labels(judged: DataFrame, labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """Adds label: 1 for good plus 2 for toxic, by the labels of the row's id."""
    good, toxic = F.col(f"`{quality_col}`") == 1, F.col(f"`{toxic_col}`") == 1
    rows = labels.select(F.col(f"`{id_col}`").cast("long").alias("labelled"), F.when(good, 1).otherwise(0).alias("good"), F.when(toxic, 2).otherwise(0).alias("toxic"))
    known = rows.filter("labelled is not null").groupBy("labelled").agg((F.max("good") + F.max("toxic")).alias("label"))
    return judged.join(known, F.col("id") == F.col("labelled"), "left").select("part", F.coalesce("label", F.lit(0)).cast("int").alias("label"), "failed")


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, subset before it, bit of its filter) of all orders."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, i in enumerate(order):
            out.append(("".join(FILTERS[j] for j in order), step + 1, before, 1 << i))
            before |= 1 << i
    return out


REPORT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The report of each part from its survivors by label class."""
    steps = _steps()
    before, own = np.array([s[2] for s in steps]), np.array([s[3] for s in steps])
    after, every = before | own, SUBSETS - 1
    names = [c.split()[0] for c in REPORT.split(", ")]
    for batch in batches:
        for part, *counts in zip(*(batch.column(c).to_pylist() for c in ("part", "alive", "good", "toxic"))):
            alive, good, toxic = (np.array(c, np.int64) for c in counts)
            removed = alive[before] - alive[after]
            by_filter = np.zeros(SUBSETS, np.int64)
            np.add.at(by_filter, own, removed)
            figures = [
                alive[after],
                removed,
                alive[0] - alive[own] - removed,
                alive[every - own] - alive[every],
                good[before] - good[after],
                toxic[before] - toxic[after],
                by_filter[own],
            ]
            columns = [pa.array([part] * len(steps), pa.string()), pa.array([s[0] for s in steps]), pa.array([s[1] for s in steps], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(f) for f in figures], names=names)


def report(survivors: DataFrame) -> DataFrame:
    """The figures of every part, filter order and step, from ``subset_survivors``."""

    def total(bit: int) -> Column:
        counted = F.col("label").bitwiseAND(bit) == bit
        return F.array(*[F.sum(F.when(counted, F.get("alive", F.lit(s))).otherwise(0)) for s in range(SUBSETS)])

    parts = survivors.groupBy("part").agg(total(0).alias("alive"), total(1).alias("good"), total(2).alias("toxic"))
    return parts.mapInArrow(_expand, REPORT)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return report(subset_survivors(with_labels(failures(docs), labels)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit(docs, labels)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
w AS (SELECT d.*, first_id, regexp_extract_all(d.t, '[^\x20\x09-\x0D]+') AS words FROM d JOIN firsts USING (t)),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN first_id < w.doc_id THEN 'E' ELSE '' END) AS fails
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
  WHERE a.c NOT IN (b.c, c.c, d.c, e.c) AND b.c NOT IN (c.c, d.c, e.c) AND c.c NOT IN (d.c, e.c) AND d.c <> e.c),
s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, '[' || substr(filter_order, 1, step - 1) || '-]' AS earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
steps AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT regexp_matches(fails, earlier) AND NOT contains(fails, own) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT regexp_matches(fails, earlier) AND contains(fails, own) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN regexp_matches(fails, earlier) AND contains(fails, own) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT regexp_matches(fails, earlier) AND contains(fails, own) THEN n_good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT regexp_matches(fails, earlier) AND contains(fails, own) THEN n_toxic ELSE 0 END) AS toxic_lost
  FROM g, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM steps
"""
