"""Toxicity: a convolutional text classifier in numpy.

A word's embedding is the sum of a hashed embedding of the word and one of its
first bytes, so that unseen words of a known stem count too; filters of several widths slide over them, each
filter's largest response is kept (max pooling), and a logistic layer scores the
text. Trained by Adagrad on a bounded sample of labelled rows (``max_docs``,
those with the smallest hash of id, of at most ``max_text_bytes``). Words in
fewer than ``MIN_DOCS`` rows of the sample have a zero embedding, as has what lies behind a
text: its score depends on its own words alone, and equal texts have equal scores.

Thresholds are calibrated by language on held-back rows of the sample: the
language is guessed from the text's words alone, and each language's raw score
is stretched so that its best threshold comes to lie at ``THRESHOLD``. A text
without words gets the score of no evidence; so does every text when there was
nothing to learn from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm.text import buffers, text_slices, word_hashes
from keelson.session import materialise

THRESHOLD = 0.3
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS)  # a filter that starts in a text, or right behind it, ends before the next one
BUCKETS = 1 << 20
PREFIX_BYTES = 4
MIN_DOCS = 3  # rarer words of the sample stay without an embedding


@dataclass
class ConvModel:
    row: np.ndarray  # hash bucket -> embedding row; row 0 is zero
    tables: list[np.ndarray]  # by width: (width, rows, filters) responses of each word in each place
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    languages: np.ndarray  # (rows, languages) log frequencies
    cuts: np.ndarray  # raw threshold of each language


def word_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of each word and of its beginning, n+1 word offsets)."""
    raw = buffers(texts)
    words, at, _ = word_hashes(*raw, plain=True)
    begin, _, _ = word_hashes(*raw, plain=True, prefix=PREFIX_BYTES)
    mask = np.uint64(BUCKETS - 1)
    return np.stack([words & mask, (begin & mask) + np.uint64(BUCKETS)], axis=1).astype(np.int64), at


def _padded(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another, each followed by PAD zero rows; their starts."""
    n = np.diff(at)
    starts = at[:-1] + PAD * np.arange(len(n))
    flat = np.zeros((int(at[-1]) + PAD * len(n) + PAD, 2), np.int64)
    flat[np.arange(int(at[-1])) + PAD * np.repeat(np.arange(len(n)), n)] = rows
    return flat, starts


def _train(rows: list[np.ndarray], y: np.ndarray, n_rows: int, epochs: int, dim: int, filters: int, rate: float, seed: int):
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (n_rows, dim)).astype(np.float32)
    emb[0] = 0
    conv = [rng.normal(0, 0.3, (k, dim, filters)).astype(np.float32) for k in WIDTHS]
    bias = np.zeros(len(WIDTHS) * filters, np.float32)
    out, out_bias = rng.normal(0, 0.3, len(bias)).astype(np.float32), np.float32(-1.0)
    g_emb, g_conv = np.full_like(emb, 1e-3), [np.full_like(w, 1e-3) for w in conv]
    g_bias, g_out, g_b = np.full_like(bias, 1e-3), np.full_like(out, 1e-3), 1e-3
    weight = np.where(y == 1, min(10.0, max(1.0, (y == 0).sum() / max(1, (y == 1).sum()) / 2)), 1.0)
    order = np.arange(len(rows))
    for _ in range(epochs):
        rng.shuffle(order)
        for s in range(0, len(order), 32):
            pick = order[s : s + 32]
            at = np.concatenate(([0], np.cumsum([len(rows[i]) for i in pick])))
            flat, starts = _padded(np.concatenate([rows[i] for i in pick]), at)
            ends = starts + np.diff(at) + 1
            x = emb[flat[:, 0]] + emb[flat[:, 1]]
            length = len(flat) - PAD
            pooled, where = [], []
            for k, w in zip(WIDTHS, conv):
                z = x[:length] @ w[0]
                for j in range(1, k):
                    z += x[j : length + j] @ w[j]
                best = np.stack([a + z[a:b].argmax(axis=0) for a, b in zip(starts, ends)])
                where.append(best)
                pooled.append(z[best, np.arange(filters)])
            z = np.concatenate(pooled, axis=1) + bias
            h = np.maximum(z, 0)
            p = 1 / (1 + np.exp(-(h @ out + out_bias)))
            d = ((p - y[pick]) * weight[pick] / len(pick)).astype(np.float32)
            dz = d[:, None] * out[None, :] * (z > 0)
            grad = h.T @ d
            g_out += grad**2
            out -= rate * grad / np.sqrt(g_out)
            g_b += float(d.sum()) ** 2
            out_bias -= rate * d.sum() / np.sqrt(g_b)
            grad = dz.sum(axis=0)
            g_bias += grad**2
            bias -= rate * grad / np.sqrt(g_bias)
            touched, values = [], []
            for n, (k, w) in enumerate(zip(WIDTHS, conv)):
                dk, best = dz[:, n * filters : (n + 1) * filters], where[n]
                for j in range(k):
                    at_j = best + j
                    change = (dk[:, :, None] * w[j].T[None]).reshape(-1, dim)
                    for c in range(2):
                        touched.append(flat[at_j, c].ravel())
                        values.append(change)
                    grad = np.einsum("bf,bfd->df", dk, x[at_j])
                    g_conv[n][j] += grad**2
                    w[j] -= rate * grad / np.sqrt(g_conv[n][j])
            ids, inv = np.unique(np.concatenate(touched), return_inverse=True)
            grad = np.zeros((len(ids), dim), np.float32)
            np.add.at(grad, inv, np.concatenate(values))
            g_emb[ids] += grad**2
            emb[ids] -= rate * grad / np.sqrt(g_emb[ids])
            emb[0] = 0
    return emb, conv, bias, out, float(out_bias)


def _best_cut(score: np.ndarray, y: np.ndarray) -> float:
    """The middle of the range of thresholds with the best F1."""
    order = np.argsort(-score, kind="stable")
    s, hits = score[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + max(1, y.sum()))
    f1[:-1][s[:-1] == s[1:]] = -1
    top = int(np.argmax(f1))
    below = s[top + 1] if top + 1 < len(s) else 0.0
    return float(np.clip((s[top] + below) / 2, 0.01, 0.99))


def fit(
    texts: pa.Array, labels: np.ndarray, langs: list[str | None], epochs: int = 8, dim: int = 16, filters: int = 8, rate: float = 0.1, seed: int = 7, min_docs: int = MIN_DOCS,
) -> ConvModel:
    """Train on labelled texts; every fifth row is held back for the thresholds."""
    buckets, at = [], [0]
    for part in text_slices(texts):
        b, o = word_buckets(part)
        buckets.append(b), at.extend((o[1:] + at[-1]).tolist())
    bucket = np.concatenate(buckets) if buckets else np.zeros((0, 2), np.int64)
    doc_words = [np.unique(bucket[a:b]) for a, b in zip(at[:-1], at[1:])]
    seen, held_by = np.unique(np.concatenate(doc_words) if doc_words else bucket.ravel(), return_counts=True)
    seen = seen[held_by >= min_docs]
    row = np.zeros(2 * BUCKETS, np.int32)
    row[seen] = np.arange(1, len(seen) + 1)
    rows = [row[bucket[a:b]].astype(np.int64) for a, b in zip(at[:-1], at[1:])]
    y = np.asarray(labels, np.float32)
    held = np.arange(len(rows)) % 5 == 4
    train = np.flatnonzero(~held)
    emb, conv, bias, out, out_bias = _train([rows[i] for i in train], y[train], len(seen) + 1, epochs if len(train) else 0, dim, filters, rate, seed)

    names = sorted({x for x in langs if x is not None}) or ["und"]
    logs = np.zeros((len(seen) + 1, len(names)), np.float32)
    for n, name in enumerate(names):
        mine = [rows[i] for i in range(len(rows)) if langs[i] == name]
        counts = np.bincount(np.concatenate(mine)[:, 0], minlength=len(seen) + 1) if mine else np.zeros(len(seen) + 1)
        logs[:, n] = np.log((counts + 0.5) / (counts.sum() + 0.5 * len(counts)))
    logs[0] = 0
    model = ConvModel(row, [np.stack([emb @ w[j] for j in range(len(w))]) for w in conv], bias, out, out_bias, logs, np.full(len(names), 0.5))
    if held.any():
        raw, guess = raw_scores(model, texts.take(pa.array(np.flatnonzero(held))))
        whole = _best_cut(raw, y[held])
        for n in range(len(names)):
            mine = guess == n
            model.cuts[n] = _best_cut(raw[mine], y[held][mine]) if y[held][mine].sum() >= 5 else whole
    return model


def raw_scores(model: ConvModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(uncalibrated score, guessed language) of each text, whole texts."""
    scores, guesses = [np.zeros(0)], [np.zeros(0, np.int64)]
    for part in text_slices(texts, 1 << 20):
        bucket, at = word_buckets(part)
        rows = model.row[bucket]
        before = np.concatenate((np.zeros((1, model.languages.shape[1])), np.cumsum(model.languages[rows[:, 0]], axis=0, dtype=np.float64)))
        guesses.append(np.argmax(before[at[1:]] - before[at[:-1]], axis=1))
        flat, starts = _padded(rows, at)
        length = len(flat) - PAD
        pooled = []
        for table in model.tables:
            z = table[0][flat[:length, 0]]
            z += table[0][flat[:length, 1]]
            for j in range(1, len(table)):
                z += table[j][flat[j : length + j, 0]]
                z += table[j][flat[j : length + j, 1]]
            pooled.append(np.maximum.reduceat(z, np.stack((starts, starts + np.diff(at) + 1), axis=1).ravel(), axis=0)[::2])
        h = np.maximum(np.concatenate(pooled, axis=1) + model.bias, 0)
        scores.append(1 / (1 + np.exp(-(h @ model.out + model.out_bias).astype(np.float64))))
    return np.concatenate(scores), np.concatenate(guesses)


def calibrated(model: ConvModel, raw: np.ndarray, guess: np.ndarray) -> np.ndarray:
    cut = model.cuts[guess]
    return np.where(raw < cut, raw / cut * THRESHOLD, THRESHOLD + (raw - cut) / (1 - cut) * (1 - THRESHOLD)).clip(0, 1)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang",
    max_docs: int = 6000, max_text_bytes: int = 200_000, max_bytes: int = 256 << 20,
) -> ConvModel:
    """Sample labelled rows and fit. Rows with a null id, label or text are
    passed over; of rows with equal ids the one with the smallest text is taken.
    The driver holds ``max_docs`` texts and ``max_bytes`` of them at most."""
    ids = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    ids = ids.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) == 1).cast("int")).alias("label"))
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(max_docs)
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & (F.octet_length("text") <= max_text_bytes))
    sample = rows.join(F.broadcast(ids), "id").groupBy("id", "label").agg(F.min(F.struct("text", "lang")).alias("of"))
    sample = materialise(docs.sparkSession, sample.select(F.xxhash64("id").alias("h"), "id", "of.text", "label", "of.lang"), "toxicity-sample")
    sofar = F.sum(F.octet_length("text")).over(Window.orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0))
    fits = sample.select("h", "id", sofar.alias("sofar")).filter(F.col("sofar") <= max_bytes)  # ``max_docs`` narrow rows at most
    last = fits.agg(F.max(F.struct("h", "id")).alias("last")).first()["last"]
    within = F.lit(False) if last is None else F.struct("h", "id") <= F.struct(F.lit(last["h"]).alias("h"), F.lit(last["id"]).alias("id"))
    sample = sample.filter(within).orderBy("h", "id").select("text", "label", "lang").toArrow()
    sample = sample.combine_chunks()
    return fit(sample["text"].combine_chunks(), sample["label"].to_numpy(), sample["lang"].to_pylist())


def score(spark: SparkSession, model: ConvModel, text: Column) -> Column:
    """A calibrated score column (0 to 1; ``THRESHOLD`` and above: toxic) for a text column; null reads as empty."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(calibrated(shared.value, *raw_scores(shared.value, texts)), pa.float64())

    return udf(text.cast("string"))


def in_fold(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """True on the held-out fold (null ids hash as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = train(docs, labels.filter(~in_fold()))
    scored = docs.select("doc_id", in_fold().alias("held_out"), score(spark, model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
