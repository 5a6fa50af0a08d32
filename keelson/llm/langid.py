"""Language ID by word-first backoff.

A text's words (its tokens between white space, lower-cased, letters only) are
looked up in a table of per-language log frequencies. A word the table doesn't know is scored by its
character n-grams, with ``^`` and ``$`` as ends: the longest order of which any n-gram
is known decides, then shorter orders, down to single characters. The text's
language has the largest sum; the score is that language's posterior, with
the evidence scaled down to ``EVIDENCE_WORDS`` words so that long texts don't
saturate. Texts that are null or hold no letter are ``und`` with score 0; so is
every text when nothing was learned.

Training counts run in Spark over a bounded sample of labelled rows
(``max_docs`` different texts, those with the smallest hash); the model keeps the
most frequent ``max_words`` words and ``max_grams`` n-grams of each order per language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm.columns import own_columns

ORDERS = (4, 3, 2, 1)
EVIDENCE_WORDS = 20.0
MAX_CACHED = 150_000
_NOT_LETTERS = regex.compile(r"\P{L}+")


@dataclass
class WordModel:
    languages: list[str]
    words: dict[str, np.ndarray] = field(default_factory=dict)  # word -> log frequency by language
    grams: dict[int, dict[str, np.ndarray]] = field(default_factory=dict)


def _log_frequencies(counts: dict[str, dict[str, int]], languages: list[str]) -> dict[str, np.ndarray]:
    """Add-one-half smoothing within the kept items."""
    totals = np.array([sum(c.get(x, 0) for c in counts.values()) for x in languages], float) + 0.5 * (len(counts) + 1)
    return {
        item: np.log((np.array([c.get(x, 0) for x in languages], float) + 0.5) / totals).astype(np.float32) for item, c in counts.items()
    }


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_docs: int = 6000,
    max_words: int = 20_000,
    max_grams: int = 8_000,
    min_count: int = 2,
) -> WordModel:
    """Learn from the rows with a text and a language (other columns are unused)."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang is not null")
    rows = rows.withColumn("h", F.xxhash64("text", "lang"))
    bound = rows.select("h").distinct().orderBy("h").limit(max_docs).agg(F.max("h")).first()[0]
    if bound is None:
        return WordModel([])
    sample = rows.filter(F.col("h") <= F.lit(bound)).dropDuplicates(["h"])
    tokens = F.explode(F.split(F.lower("text"), r"[\s\p{Z}]+")).alias("item")
    words = (
        sample.select("lang", tokens)
        .select("lang", F.regexp_replace("item", r"\P{L}+", "").alias("item"))
        .filter("item <> ''")
        .groupBy("lang", "item")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    words = words.persist()
    try:
        languages = sorted(r[0] for r in words.select("lang").distinct().collect())
        model = WordModel(languages)
        model.words = _log_frequencies(_top(words.filter(F.col("n") >= min_count), max_words), languages)
        marked = F.concat(F.lit("^"), F.col("item"), F.lit("$"))
        for k in ORDERS:
            source = marked if k > 1 else F.col("item")
            grams = words.select("lang", F.explode(_char_grams(source, k)).alias("item"), "n").groupBy("lang", "item").agg(F.sum("n").alias("n"))
            model.grams[k] = _log_frequencies(_top(grams, max_grams), languages)
    finally:
        words.unpersist()
    return model


def _char_grams(source: Column, k: int) -> Column:
    at = F.sequence(F.lit(1), F.length(source) - (k - 1))
    return F.when(F.length(source) >= k, F.transform(at, lambda i: F.substring(source, i, F.lit(k))))


def _top(counts: DataFrame, most: int) -> dict[str, dict[str, int]]:
    """Counts of the ``most`` frequent items of each language (bounded by that)."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "item"))
    kept = counts.withColumn("rank", rank).filter(F.col("rank") <= most).select("item").distinct()
    out: dict[str, dict[str, int]] = {}
    for item, lang, n in counts.join(kept, "item", "left_semi").select("item", "lang", "n").toLocalIterator():
        out.setdefault(item, {})[lang] = n
    return out


class _Rows(dict):
    """token -> row of the score table; row 0 is for tokens without letters.

    Unseen words get a row when they are first looked up; ``settle`` then
    scores all new ones together by backoff."""

    def __init__(self, model: WordModel):
        super().__init__({w: i + 1 for i, w in enumerate(model.words)})
        self.model, self.used = model, len(model.words) + 1
        width = len(model.languages)
        self.table = np.zeros((self.used, width), np.float32)
        if model.words:
            self.table[1:] = np.stack(list(model.words.values()))
        grams = [g for k in ORDERS for g in model.grams.get(k, {})]
        self.gram_row = {g: i for i, g in enumerate(grams)}  # orders differ in length, so none clashes
        self.gram_table = np.stack([v for k in ORDERS for v in model.grams.get(k, {}).values()]) if grams else np.zeros((0, width), np.float32)
        self.new_grams: list[int] = []
        self.new_counts: list[int] = []

    def __missing__(self, token: str) -> int:
        word = _NOT_LETTERS.sub("", token)
        if word != token:
            self[token] = row = self[word] if word else 0
            return row
        hits: list[int] = []
        marked, known = f"^{word}$", self.gram_row
        for k in ORDERS:
            s = marked if k > 1 else word
            hits = [known[g] for i in range(len(s) - k + 1) if (g := s[i : i + k]) in known]
            if hits:
                break
        self.new_grams += hits
        self.new_counts.append(len(hits))
        self[token] = row = self.used
        self.used += 1
        return row

    def settle(self) -> None:
        if self.new_counts:
            counts = np.array(self.new_counts)
            rows = np.zeros((len(counts), self.table.shape[1]), np.float32)
            some = counts > 0
            if some.any():
                starts = (np.cumsum(counts) - counts)[some]
                rows[some] = np.add.reduceat(self.gram_table[np.array(self.new_grams)], starts, axis=0) / counts[some, None]
            self.table = np.concatenate((self.table, rows))
            self.new_grams, self.new_counts = [], []

    def trimmed(self) -> _Rows:
        return self if len(self) < len(self.model.words) + MAX_CACHED else _Rows(self.model)


def predict_batch(rows: _Rows, texts: pa.Array, group: int = 500) -> tuple[list[str], list[float], _Rows]:
    languages = rows.model.languages
    out_lang, out_score = [], []
    for start in range(0, len(texts), group):
        looked_up = []
        for text in texts.slice(start, group).to_pylist():
            tokens = text.lower().split() if text and languages else []
            looked_up.append(np.fromiter(map(rows.__getitem__, tokens), dtype=np.int64, count=len(tokens)))
        rows.settle()
        for at in looked_up:
            n = np.count_nonzero(at)
            if n == 0:
                out_lang.append("und"), out_score.append(0.0)
                continue
            sums = rows.table[at].sum(axis=0, dtype=np.float64) * min(1.0, EVIDENCE_WORDS / n)
            best = int(np.argmax(sums))
            out_lang.append(languages[best])
            out_score.append(1.0 / math.fsum(np.exp(sums - sums[best]).tolist()))
        rows = rows.trimmed()
    return out_lang, out_score, rows


def predict(spark: SparkSession, model: WordModel, text: Column) -> Column:
    """A struct column (lang_pred, score) for a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rows = _Rows(shared.value)
        for texts in batches:
            langs, scores, rows = predict_batch(rows, texts)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return udf(text.cast("string"))


def in_fold(id_col: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """True on the held-out fold (null ids hash as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def accepted(spark: SparkSession, model: WordModel, docs: DataFrame, min_gain: float = 1.2, text_col: str = "text") -> DataFrame:
    """Rows whose language is recognised, with their own columns, whatever these are
    called. Rejected are rows with no letter, and rows with next to no evidence: their
    score isn't ``min_gain`` times that of a guess among the learned languages (one
    language alone is always recognised)."""
    least = min_gain / len(model.languages) if len(model.languages) > 1 else 0.0
    verdict = predict(spark, model, F.col(text_col))
    kept = docs.select(*own_columns(docs), verdict.alias("__verdict"))
    return kept.filter((F.col("__verdict.lang_pred") != "und") & (F.col("__verdict.score") >= least)).drop("__verdict")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.filter(~in_fold()))
    verdict = predict(spark, model, F.col("text"))
    scored = docs.select("doc_id", in_fold().alias("held_out"), verdict.alias("v"))
    return scored.select("doc_id", "held_out", F.col("v.lang_pred").alias("lang_pred"), F.col("v.score").alias("score"))
