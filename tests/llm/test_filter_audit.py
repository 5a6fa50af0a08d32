"""The filter interaction audit against brute force over documents, orders and
steps, and against DuckDB."""

import re
from itertools import permutations

import numpy as np
import pytest
from brute import SF_CHECK

from keelson.llm import filter_audit as audit

LONG = " ".join(f"w{i}" for i in range(300))
# doc_id, text, lang
ROWS = [
    (1, LONG, "en"),
    (2, LONG, "en"),
    (2, LONG, "de"),
    (3, LONG.upper(), "en"),
    (4, "same " * 300, "en"),
    (5, "same " * 300 + "|", ""),
    (6, None, None),
    (7, "", "en"),
    (8, " \t\n\x0b", "de"),
    (9, "É" * 30 + "A", "fr"),
    (9, "É" * 33 + "A", "fr"),
    (None, LONG, "en"),
    (None, "$", "fr"),
    (10, "$", "fr"),
    (11, "$", "fr"),
    (0, "a\xa0b " * 150 + "B b", "xx"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 0, 0), (3, 1, 1), (4, None, 1), (5, 1, None), (10, 1, 0), (11, 0, 1), (None, 1, 1), (99, 1, 1)]


def plain_fails(rows):
    out = []
    for doc, text, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append(
            {
                "A": len(words) < 200,
                "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                "D": any(c in "#$%&*|" for c in t),
                "E": doc is not None and any(d is not None and d < doc and (x or "") == t for d, x, _ in rows),
            }
        )
    return out


def plain_audit(rows, labels):
    fails = plain_fails(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, c in enumerate(order, 1):
                gone = [x for x in left if x[1][c]]
                left = [x for x in left if not x[1][c]]
                shapley[c] += len(gone)
                failing = sum(f[c] for _, f in mine)
                unique = sum(f[c] and sum(f.values()) == 1 for _, f in mine)
                out[part, order, step] = [len(left), len(gone), failing - len(gone), unique, sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for key in [k for k in out if k[0] == part]:
            out[key].append(shapley[key[1][key[2] - 1]])
    return out


def result(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = df.collect()
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in names] for r in rows}
    assert len(got) == len(rows)
    return got


def test_truth_words_name_the_subsets_survived():
    words = audit.truth_words(np.arange(32))
    for mask in range(32):
        assert [bool(int(words[mask]) >> s & 1) for s in range(32)] == [mask & s == 0 for s in range(32)]


@pytest.mark.parametrize("n", [0, 1, 255, 4096, 4097, 60_000])
def test_carry_save_popcounts(n):
    words = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    assert audit.positional_popcount(words).tolist() == [int(((words >> np.uint32(i)) & 1).sum()) for i in range(32)]
    full = np.full(n, 2**32 - 1, np.uint32)
    assert audit.positional_popcount(full, lanes=4).tolist() == [n] * 32


def test_audit_against_brute_force(spark):
    schema = "doc_id long, text string, lang string, `a.b` int, part string, id int, failed int, label int, first int"
    docs = spark.createDataFrame([(*r, 1, "p", 2, 3, 4, 5) for r in ROWS], schema).repartition(5)
    labels = spark.createDataFrame([(*r, "x") for r in LABELS], "doc_id long, quality int, toxic int, `a.b` string")
    assert result(audit.audit(docs, labels)) == plain_audit(ROWS, LABELS)
    assert audit.audit(docs.limit(0), labels).count() == 0
    assert result(audit.audit(docs, labels.limit(0))) == plain_audit(ROWS, [])


def test_one_text_in_most_rows_and_many_parts(spark):
    rows = [(i, "copy $" if i % 3 else f"own {i}", f"l{i % 700}") for i in range(2100)]
    got = result(audit.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7), spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")))
    assert len(got) == 700 * 600
    copies = sum(got[f"l{p}", "EABCD", 1][1] for p in range(700))
    assert copies == 1399 and sum(got[f"l{p}", "EABCD", 1][0] for p in range(700)) == 701


def test_query_against_duckdb(spark):
    from check_oracle import compare, duck

    assert compare(spark, duck(SF_CHECK), "op11", audit.query, audit.SQL, SF_CHECK)["status"] == "ok"
