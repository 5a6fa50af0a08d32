"""Op 2 against a brute-force Jaccard join."""

import random

import brute
import pytest
from brute import SF_CHECK
from pyspark.sql import functions as F

from keelson.llm import ngram_join

SCHEMA = "doc_id long, text string, id string, token int, n string"


def result(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], SCHEMA)
    out = ngram_join.jaccard_groups(spark, df, **kw).collect()
    return sorted(((r["id"], r["n"], r["component_id"], r["n_links"]) for r in out), key=repr)


def test_whole_table_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted(brute.jaccard_groups(rows))
    got = sorted(tuple(r) for r in ngram_join.query(spark, SF_CHECK).select("doc_id", "n_shingles", "component_id", "n_links").collect())
    assert got == want


def near_copies(rng, n_docs, n_words, group):
    rows, vocab = [], [f"w{i}" for i in range(400)]
    base = [rng.choice(vocab) for _ in range(n_words)]
    passage = [f"p{i}" for i in range(30)]
    for d in range(n_docs):
        w = list(base) if d < group else [rng.choice(vocab) for _ in range(rng.randint(1, n_words))] + passage
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((d, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_and_a_shared_passage(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 3000)  # several tiles a group
    monkeypatch.setattr(ngram_join, "BUCKET_BYTES", 4000)
    rows = near_copies(random.Random(seed), 150, 120, 80)
    assert result(spark, rows) == sorted(brute.jaccard_groups(rows), key=repr)


def test_a_task_loads_one_tile_of_a_large_component_at_once(spark, monkeypatch):
    real = ngram_join._join_tiles

    def one_at_once(percent):
        join = real(percent)

        def run(table):
            tiles = set(zip(table["comp"].to_pylist(), table["i"].to_pylist(), table["j"].to_pylist()))
            if len(tiles) > 1 and any(j for _, _, j in tiles):
                raise ValueError(f"{len(tiles)} tiles")
            return join(table)

        return run

    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 300)  # more tiles than bins
    monkeypatch.setattr(ngram_join, "_join_tiles", one_at_once)
    rows = near_copies(random.Random(3), 150, 120, 80)
    assert result(spark, rows) == sorted(brute.jaccard_groups(rows), key=repr)


def chained(rng, n_docs):
    """Texts of four passages, each passage in two texts: a text shares prefix shingles with
    a few others, and chains of them join all into one component. Every tenth has a near copy."""
    pool = [" ".join(f"p{i}x{j}" for j in range(30)) for i in range(2 * n_docs)]
    again, rows = rng.sample(pool, len(pool)), []
    for d in range(n_docs):
        w = " ".join([*pool[2 * d : 2 * d + 2], *again[2 * d : 2 * d + 2]]).split()
        rows.append((2 * d, " ".join(w)))
        if d % 10 == 0:
            w[rng.randrange(len(w))] = "edited"
            rows.append((2 * d + 1, " ".join(w)))
    return rows


def test_a_chained_component_is_not_compared_with_all_of_itself(spark, monkeypatch):
    rows, loads, real = chained(random.Random(5), 300), [], ngram_join._met_blocks
    for volume in (4000, 500):
        seen = []
        monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", volume)
        monkeypatch.setattr(ngram_join, "_met_blocks", lambda held: seen.append(real(held)) or seen[-1])
        assert result(spark, rows) == sorted(brute.jaccard_groups(rows), key=repr)
        (met,) = seen
        loads.append((met.count(), met.select("other").distinct().count(), met.select("node").distinct().count()))
    # a class goes to the few blocks of its partners, however many blocks there are
    for sent, blocks, classes in loads:
        assert classes > 250 and sent < 6 * classes
    assert loads[0][1] > 6 and loads[1][1] > 50 and loads[1][0] < 1.6 * loads[0][0], loads


def test_blocks_beyond_a_word_of_bits(spark):
    held = [(1, 10, 0), (1, 11, 63), (1, 12, 64), (2, 12, 64), (2, 13, 200), (3, 14, 127)]
    got = ngram_join._met_blocks(spark.createDataFrame(held, "token long, node long, block int")).collect()
    want = {(n, c) for t, n, _ in held for u, _, c in held if t == u}
    assert sorted(map(tuple, got)) == sorted(want)


def test_edge_cases(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [
        (None, "a b c d e f"),
        (5, "A  b\tC d\ne f"),
        (5, "A  b\tC d\ne f"),
        (7, None),
        (8, ""),
        (9, " \t\r\n\x0b\x0c "),
        (10, "one two"),
        (11, "One Two"),
        (12, "one two three"),
        (13, long),
        (14, long + " tail"),
        (15, "É é ü"),
        (16, "é é ü"),
    ]
    assert result(spark, rows) == sorted(brute.jaccard_groups(rows), key=repr)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_first_of_groups_keeps_one_row_and_all_columns(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None), (4, "other words entirely"), (None, "a b c d e f")]
    df = spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], SCHEMA)
    out = ngram_join.first_of_groups(spark, df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.select(F.col("doc_id")).collect()) == [1, 2, 4]
