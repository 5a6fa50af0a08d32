"""The dealt operators against brute force, on the driver's small table and on
hand-made rows: nulls, empty and long texts, ties, repeated rows, empty tables,
extra columns whose names clash with the operators' own."""

import hashlib
import math
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from brute import SF_CHECK
from pyspark.sql import functions as F

import corpus_pipeline
from keelson.llm import decontaminate, fingerprints, langid, licenses, mixing, sampling, sharding, toxicity, url_filter
from keelson.llm import text as T

# extra columns named as the operators' own
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, h string, row string, size string, shard int, slot int, number int, a int, text_hash string, `a.b` string"
LONG = " ".join(f"w{i}" for i in range(20_000))
ROWS = [
    (1, "the cat sat on the mat and looked at the dog", "en", "s1"),
    (2, "der hund und die katze sind im haus und im garten", "de", "s1"),
    (2, "der hund und die katze sind im haus und im garten", "de", "s1"),
    (3, None, "en", None),
    (4, "", None, "s2"),
    (5, " \t\n ", "en", "s2"),
    (6, "123 456 !!", "en", "s2"),
    (7, LONG, "en", "s3"),
    (None, "the dog and the cat", "en", None),
    (None, None, None, None),
    (8, "É è ü 漢字 𝄞", "fr", "s4"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 0, "i", "h", "r", "s", 1, 1, 1, 1, "t", "dot") for r in rows], SCHEMA)


def docs_of(spark, cols=("doc_id", "text")):
    return [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").select(*cols).collect()]


def test_word_and_shingle_hashes_agree_with_plain_sets():
    texts = [r[1] for r in ROWS] + ["a b c d e", "A B C D E", "a b c d", "a b c d e f a b c d e", "x", "X\x0by"]
    sets, at = T.shingle_sets(pa.array(texts), 5)
    got = [frozenset(sets[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]
    plain = [brute.shingles(t) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in plain]
    for i in range(len(texts)):
        for j in range(i):
            assert len(got[i] & got[j]) == len(plain[i] & plain[j])


# -- op 1 -------------------------------------------------------------------------
def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return host.translate(brute.LOWER), path[:end]


def plain_rule(host, path):
    fits = []
    for verdict, rule in url_filter.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1", "x://example.org/en/12?q", "x://example.org/en/2", "x://forg/", "x://org",
        "x://org/", "x://É.com/de/#a", "x://com/fr/://b", "x://a.com?u=/de/", "x://a.com#://x", "x://b.net/p/1?bad=1", "x://b.net/p/1?bad=1"]


def test_url_rules_and_mined_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(URLS)], "page_id long, url string, host string, path string")
    train = [(f"http://{h}.net/{w}/{i}", w == "spam") for i in range(40) for h in ("a", "b") for w in ("spam", "ham")]
    labelled = spark.createDataFrame([*train, (None, True), ("x://y.net/", None)], "url string, bad boolean")
    mined = url_filter.mine_rules(labelled, 0.05, 0.9)
    assert ["path:spam"] in [r["tokens"] for r in mined.collect()]
    assert all("path:spam" in r["tokens"] for r in mined.collect())
    got = {r["page_id"]: r for r in url_filter.judge(pages, mined).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = plain_url(u)
        rule, verdict = plain_rule(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == (verdict or "allow")
    spam = spark.createDataFrame([(1, "q://z.info/Spam/9"), (2, "q://z.info/eggs")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.judge(spam, mined).collect()} == {1: "block", 2: "allow"}
    none = url_filter.mine_rules(labelled.filter("not bad"))
    assert none.count() == 0 and url_filter.judge(pages.limit(0), none).count() == 0


def plain_rules(rows, min_rows, min_confidence, min_lift, min_z):
    """All token sets by brute force, over tokens grouped by equal rows: {tokens: confidence}."""
    from itertools import combinations

    n, base = len(rows), sum(b for _, b in rows) / len(rows)
    holds = {}
    for i, (tokens, bad) in enumerate(rows):
        for t in tokens:
            holds.setdefault(t, set()).add(i)
    groups = {}
    for t, at in holds.items():
        if sum(rows[i][1] for i in at) >= min_rows:
            groups.setdefault(frozenset(at), []).append(t)
    found = {}
    for size in range(1, len(groups) + 1):
        for items in combinations(groups, size):
            at = frozenset.intersection(*items)
            bad = sum(rows[i][1] for i in at)
            if bad >= min_rows:
                c = bad / len(at)
                if c >= min_confidence and c >= min_lift * base and c - base >= min_z * math.sqrt(base * (1 - base) / len(at)):
                    found[frozenset(items)] = c
    kept = {s: c for s, c in found.items() if not any(o < s and found[o] >= c for o in found)}
    return {tuple(sorted(t for item in s for t in groups[item])): c for s, c in kept.items()}


def test_mined_rules_against_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(600):
        words = [w for w in ("spam", "win", "news", "blog", "pills") if rng.random() < 0.4]
        bad = ("spam" in words and "win" in words and rng.random() < 0.9) or ("pills" in words and rng.random() < 0.7) or rng.random() < 0.1
        rows.append((f"http://h{i % 3}.net/{'/'.join(words)}", bool(bad)))
    rows += [("http://rare.net/once", True)] * 19  # a row too few for a rule
    tokens = [r["t"] for r in spark.createDataFrame(rows, "url string, bad boolean").select(url_filter.url_tokens(F.col("url")).alias("t")).collect()]
    plain = [(t, b) for t, (_, b) in zip(tokens, rows)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean").repartition(4)
    got = {tuple(r["tokens"]): r for r in url_filter.mine_rules(labelled).collect()}
    want = plain_rules(plain, 20, 0.5, 1.5, 4.0)
    assert {k: round(r["confidence"], 9) for k, r in got.items()} == {k: round(c, 9) for k, c in want.items()}
    assert want and all("path:once" not in k for k in want)
    for k, r in got.items():
        assert r["anchor"] in k and round(r["support"] * len(rows)) == sum(b and set(k) <= set(t) for t, b in plain) >= 20
    urls = spark.createDataFrame(rows, "url string, bad boolean").select("url").distinct()
    blocked = {r["url"] for r in url_filter.blocked_urls(urls, url_filter.mine_rules(labelled)).collect()}
    assert blocked == {u for (u, _), t in zip(rows, tokens) if any(set(k) <= set(t) for k in want)}


def test_long_paths_and_tokens_that_stand_together_stay_cheap(spark):
    import time

    words = "/".join(f"word{chr(97 + i)}" for i in range(20))
    rows = [(f"http://a.b.c.d.e.example.net/{words}?k=v&k2=v2", i % 10 != 0) for i in range(400)]
    rows += [(f"http://other.org/{chr(97 + i % 26)}/{'x' * (i % 3)}", i % 10 == 0) for i in range(400)]
    rows += [("http://long.org/" + "/".join(f"w{chr(97 + j % 26)}{'y' * (j % 40)}" for j in range(20_000)), False)]
    start = time.time()
    rules = url_filter.mine_rules(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert time.time() - start < 90
    assert len(rules) == 1 and len(rules[0]["tokens"]) >= 30 and abs(rules[0]["confidence"] - 0.9) < 1e-9


def test_rules_of_the_commonest_of_many_items(spark):
    """Each url holds up to 20 frequent tokens; the rule's are its most frequent ones."""
    rng = np.random.default_rng(11)
    rare, nested = [f"{chr(97 + k)}{chr(97 + k)}" for k in range(10)], ["top", "mid", "low"]
    rows = []
    for i in range(1200):
        a, b, c = (rng.random(3) < 0.7).tolist()
        words = ["red"] * a + ["blue"] * b + ["green"] * c + nested[: rng.integers(0, 4)]
        # most of the others stand together, always so where the url is red
        words += [w for w in rare if (i % 3 == 0 if a else rng.random() < 0.15)]
        rows.append((f"http://h.net/{'/'.join(words)}", bool(rng.random() < (0.95 if a and b and c else 0.05))))
    labelled = spark.createDataFrame(rows, "url string, bad boolean").repartition(4)
    tokens = [r["t"] for r in spark.createDataFrame(rows, "url string, bad boolean").select(url_filter.url_tokens(F.col("url")).alias("t")).collect()]
    got = {tuple(r["tokens"]): r["confidence"] for r in url_filter.mine_rules(labelled, min_rows=120).collect()}
    assert max(len(t) for t in tokens) > 12
    colours = [set(t) >= {"path:red", "path:blue", "path:green"} for t in tokens]
    want = sum(b for (_, b), c in zip(rows, colours) if c) / sum(colours)
    assert abs(got[("path:blue", "path:green", "path:red")] - want) < 1e-12
    plain = [(t, b) for t, (_, b) in zip(tokens, rows)]
    few = [([t for t in ts if t[5:] not in rare[2:]], b) for ts, b in plain]  # brute force can't take all
    expected = plain_rules(few, 120, 0.5, 1.5, 4.0)
    left = {k: c for k, c in got.items() if not any(t[5:] in rare[2:] for t in k)}
    assert {k: round(c, 9) for k, c in left.items()} == {k: round(c, 9) for k, c in expected.items()}
    assert any(len(k) > 3 for k in expected)


def test_few_bad_rows_give_no_rules_at_any_table_size(spark):
    rows = [(f"http://h{i}.net/p", i < 19) for i in range(60)]
    assert url_filter.mine_rules(spark.createDataFrame(rows, "url string, bad boolean")).count() == 0
    noise = np.random.default_rng(3)
    rows = [(f"http://h{i % 40}.net/{'abcdefgh'[i % 8]}/{'pqrstuv'[i % 7]}", bool(noise.random() < 0.25)) for i in range(4000)]
    assert url_filter.mine_rules(spark.createDataFrame(rows, "url string, bad boolean")).count() == 0  # labels that don't depend on the url


def test_url_query_covers_every_page(spark):
    got = {r["page_id"]: r for r in url_filter.query(spark, SF_CHECK).collect()}
    pages = spark.read.parquet(f"{SF_CHECK}/pages.parquet").select("page_id", "url").collect()
    assert len(got) == len(pages)
    for p in pages:
        host, path = plain_url(p["url"])
        rule, verdict = plain_rule(host, path)
        r = got[p["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and (verdict is None or r["verdict"] == verdict)


# -- op 3 -------------------------------------------------------------------------
def test_every_known_sentence_holds_a_marker_and_every_rule_a_known_sentence():
    assert all(any(m in s for m in licenses.MARKERS) for s in licenses.SENTENCES.values())
    assert all(i in licenses.SENTENCES for _, _, ids in licenses.RULES for i in ids)


def test_license_sequences(spark):
    S = licenses.SENTENCES
    mit = f"The code.\n\n{S['mit-grant'].upper()}:\n\n{S['mit-condition']}.\n\n{S['as-is']}. {S['no-liability']}."
    bsd = ". ".join(S[x] for x in ("bsd-grant", "bsd-source", "bsd-binary"))
    rows = [(1, mit), (2, "a | b\nReleased under the MIT License.\nmore"), (3, bsd + ". Neither the name of Example Corp nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."), (4, bsd + "."), (5, None), (6, ""),
            (7, S["bsd-source"] + ". " + S["bsd-grant"] + "."), (None, "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0."), (2, LONG)]
    df = spark.createDataFrame([(*r, "s", "l") for r in rows], "doc_id long, text string, s string, l string")
    got = [(r["doc_id"], r["rules"], r["licences"]) for r in licenses.scan(df).collect()]
    assert got == [(1, "mit-full-cut", "MIT"), (2, "mit-notice", "MIT"), (3, "bsd3-full", "BSD-3-Clause"), (4, "bsd2-full", "BSD-2-Clause"), (5, "", ""), (6, "", ""),
                   (7, "", ""), (None, "apache-notice,cc-by-nc-notice", "Apache-2.0,CC-BY-NC-4.0"), (2, "", "")]
    assert licenses.scan(df.limit(0)).count() == 0


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
BSD3 = """Copyright (c) 2001, Example Corp. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of Example Corp nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission.

THIS SOFTWARE IS PROVIDED "AS IS"."""
MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details."""
AGPL = LGPL.replace("library", "program").replace("software;", "software:").replace("Lesser", "Affero").replace("2.1", "3")
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
STANDARD = {
    "Apache-2.0": APACHE,
    "BSD-3-Clause": BSD3,
    "BSD-2-Clause": BSD3[: BSD3.index("3. ")] + BSD3[BSD3.index("\nTHIS") :],
    "MIT": MIT,
    "MIT-0": MIT.replace(", subject to the following conditions:", ".").replace("MIT License", "Terms").replace(MIT[MIT.index("The above") : MIT.index("THE SOFT")], ""),
    "MPL-2.0": MPL,
    "LGPL-2.1-or-later": LGPL,
    "AGPL-3.0-or-later": AGPL,
    "ISC": ISC,
    "0BSD": ISC.replace("granted, provided that the above\ncopyright notice and this permission notice appear in all copies", "granted"),
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy it.",
    "CC0-1.0": "To the extent possible under law, A. Person has waived all copyright and related or neighboring rights to this\nwork.",
}


def commented(text, mark):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.split("\n"))


@pytest.mark.parametrize("form", ["plain", "hash", "stars", "slashes", "one line each", "one paragraph"])
def test_standard_texts_are_recognised_in_every_form(spark, form):
    shape = {
        "plain": lambda t: t,
        "hash": lambda t: commented(t, "#"),
        "stars": lambda t: "/*\n" + commented(t, " *") + "\n */",
        "slashes": lambda t: commented(t, "//"),
        # every paragraph unwrapped to a line of its own
        "one line each": lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),
        "one paragraph": lambda t: " ".join(t.split()),
    }[form]
    wanted = dict(STANDARD)
    if form in ("one line each", "one paragraph"):  # list numbers or the conditions' ends are lost in running text
        for name in ("BSD-3-Clause", "BSD-2-Clause") + (("MIT", "MIT-0") if form == "one paragraph" else ()):
            wanted.pop(name)
    df = spark.createDataFrame([(n, "int x;\n\n" + shape(t) + "\n\nint y;") for n, t in wanted.items()], "doc_id string, text string")
    got = {r["doc_id"]: r["licences"] for r in licenses.scan(df).collect()}
    assert got == {n: n for n in wanted}


def test_spdx_lines_and_holders(spark):
    rows = [(x, f"// SPDX-License-Identifier: {x}\n// Copyright\nint main();") for x in licenses.SPDX]
    holder = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    rows += [("none", "// SPDX-License-Identifier: Made-Up-1.0"), ("none", "MIT and Apache people met."), ("none", holder)]
    author = BSD3.replace("3. Neither the name of Example Corp nor the names of its contributors may be", "3. The name of the author may not be")
    rows += [("BSD-3-Clause", author), ("MIT,Unlicense", MIT + "\n\n" + STANDARD["Unlicense"])]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    for r in licenses.scan(df).collect():
        assert r["licences"] == ("" if r["doc_id"] == "none" else r["doc_id"]), r


def test_license_scan_against_duckdb_on_standard_texts(spark, tmp_path):
    import duckdb

    from keelson.llm.oracle import ORACLE_SQL

    texts = [f(t) for t in STANDARD.values() for f in (str, str.upper, lambda t: commented(t, "#"), lambda t: t + " " + BSD3, lambda t: t.replace("\n\n", "\n"))]
    rows = [(i, t) for i, t in enumerate([*texts, None, "", "\n1. \n(a) license. b) \n\n#\n# MIT License\n"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    want = Counter(con.execute(ORACLE_SQL["op3_licenses"]).fetchall())
    assert Counter(tuple(r[c] for c in ("doc_id", "n_known", "rules", "licences")) for r in licenses.scan(df).collect()) == want


def test_license_query_against_duckdb(spark):
    from check_oracle import compare, duck

    from keelson.llm.oracle import ORACLE_SQL

    assert compare(spark, duck(SF_CHECK), "op3", licenses.query, ORACLE_SQL["op3_licenses"], SF_CHECK)["status"] == "ok"


# -- ops 4 and 6 --------------------------------------------------------------------
def test_toxicity(spark):
    rng = np.random.default_rng(1)
    vocab = [f"word{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(1500):
        w = [vocab[j] for j in rng.integers(0, 300, rng.integers(5, 60))]
        if i % 4 == 0:
            w[rng.integers(len(w))] = rng.choice(["Vile!", "nasty"])
        texts.append(" ".join(w)), labels.append(int(i % 4 == 0))
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    label_rows = spark.createDataFrame([(i, v, "x") for i, v in enumerate(labels)] + [(None, 1, "x"), (5, None, "x")], "doc_id long, toxic int, text string")
    model = toxicity.train(docs, label_rows.filter(~toxicity.in_fold()))
    scored = docs.select("doc_id", toxicity.in_fold().alias("held"), toxicity.score(spark, model, F.col("text")).alias("score")).collect()
    held = [(r["score"], labels[r["doc_id"]]) for r in scored if r["held"]]
    assert np.mean([(s >= toxicity.THRESHOLD) == bool(y) for s, y in held]) > 0.95
    odd = frame(spark).select("doc_id", toxicity.score(spark, model, F.col("text")).alias("score")).collect()
    assert len(odd) == len(ROWS) and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.train(docs.limit(0), label_rows.limit(0)).cuts.size == 1
    assert frame(spark, []).select(toxicity.score(spark, model, F.col("text"))).count() == 0


def test_language_id(spark):
    rows = docs_of(spark, ("doc_id", "text", "lang"))
    got = {r["doc_id"]: r for r in langid.query(spark, SF_CHECK).collect()}
    assert len(got) == len(rows)
    held = [(got[i]["lang_pred"], lang) for i, _, lang in rows if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in rows)
    assert np.mean([a == b for a, b in held]) > 0.98
    model = langid.train(frame(spark))
    v = frame(spark).select("doc_id", "text", langid.predict(spark, model, F.col("text")).alias("v")).collect()
    for r in v:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["v"]["lang_pred"] == "und") == (not letters) and 0 <= r["v"]["score"] <= 1
    kept = langid.accepted(spark, model, frame(spark))
    assert kept.columns == frame(spark).columns and kept.filter("text is null or text = ''").count() == 0
    empty = langid.train(frame(spark, []))
    assert empty.languages == [] and langid.accepted(spark, empty, frame(spark, [])).count() == 0


# -- op 5 -------------------------------------------------------------------------
def check_shards(rows, n):
    """rows: (id, text, size, shard, slot)"""
    bytes_, slots = Counter(), {}
    for i, t, size, shard, slot in rows:
        assert size == len((t or "").encode()) + 1 and 0 <= shard < n
        bytes_[shard] += size
        slots.setdefault(shard, []).append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [bytes_[i] for i in range(n)]


def test_sharding_is_balanced_to_a_document(spark, monkeypatch):
    rows = docs_of(spark)
    got = {r["doc_id"]: r for r in sharding.query(spark, SF_CHECK).collect()}
    assert len(got) == len(rows)
    sizes = check_shards([(i, t, got[i]["size"], got[i]["shard"], got[i]["slot"]) for i, t in rows], 8)
    largest = max(len((t or "").encode()) + 1 for _, t in rows)
    assert max(sizes) - min(sizes) <= 2 * largest
    assert all(got[i]["text_crc32"] == zlib.crc32((t or "").encode()) for i, t in rows)


def test_sharding_cuts_a_hot_text_and_takes_odd_rows(spark):
    hot = [(i, "same text in a third of all rows", "en", "s") for i in range(600)]
    rows = hot + [(1000 + i, f"text {i} " * (i % 7), "en", "s") for i in range(300)] + ROWS[:7] + ROWS[8:]
    out = sharding.histogram_sort(spark, frame(spark, rows), 4, part_bytes=500).collect()
    assert sorted(r["row"]["doc_id"] or -1 for r in out) == sorted(r[0] or -1 for r in rows)
    sizes = check_shards([(0, r["row"]["text"], r["size"], r["shard"], r["slot"]) for r in out], 4)
    assert max(sizes) - min(sizes) <= 150
    for r in out:
        assert r["row"]["slot"] == 1  # the table's own column
    assert sharding.histogram_sort(spark, frame(spark, [])).count() == 0


# -- op 7 -------------------------------------------------------------------------
def test_resampling(spark):
    rows = docs_of(spark)
    out = sampling.query(spark, SF_CHECK).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    share = np.mean([v == 1 for v in labels.values()])
    k = math.ceil(share * len(rows))
    assert len(out) == len(rows)
    order = sorted((r["gumbel_score"] for r in out), reverse=True)
    assert {r["doc_id"] for r in out if r["selected"]} == {r["doc_id"] for r in out if r["gumbel_score"] >= order[k - 1]}
    # the weights: plain counting of the same buckets
    good = {i for i, v in labels.items() if v == 1}
    raw, target = np.ones(sampling.BUCKETS), np.ones(sampling.BUCKETS)
    each = {}
    for i, t in rows:
        one, _, two, _ = sampling.ngram_buckets(pa.array([t]))
        each[i] = np.concatenate((one, two))
        np.add.at(raw, each[i], 1)
        if i in good:
            np.add.at(target, each[i], 1)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    assert all(abs(ratio[each[r["doc_id"]]].sum() - r["log_weight"]) < 1e-6 for r in out)


def test_resampling_of_odd_rows_and_ties(spark):
    ids = spark.createDataFrame([(1,), (2,)], "doc_id long")
    out = sampling.resample(spark, frame(spark), ids, 0.5).collect()
    assert len(out) == len(ROWS) and sum(r["selected"] for r in out) == 6
    assert all(r["log_weight"] == 0 for r in out if r["id"] in (3, 4))
    assert sampling.resample(spark, frame(spark, []), ids, 0.5).count() == 0
    half = [(7 if i % 2 else None if i % 3 else i, "same words here" if i % 2 else f"own words {i}") for i in range(200)]
    rows = spark.createDataFrame(half, "doc_id long, text string").repartition(5)
    for share, k in ((0.1, 20), (0.5, 100), (0.777, 156), (1.0, 200)):
        out = sampling.resample(spark, rows, ids, share).collect()
        assert len(out) == 200 and sum(r["selected"] for r in out) == k
        least = min(r["gumbel_score"] for r in out if r["selected"])
        assert all(r["selected"] for r in out if r["gumbel_score"] > least)
    assert len({r["gumbel_score"] for r in out if r["id"] is None}) > 50  # null ids don't share their noise
    ties = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 2, 3, 3, 0.1, -5]], "v double")
    want = sorted([1, 1, 1, 2, 3, 3, 0.1, -5], reverse=True)
    assert [sampling.kth_largest(ties, "v", k, 2) for k in range(1, 9)] == want


# -- op 8 -------------------------------------------------------------------------
def check_mix(rows, slots, block_rows):
    """Whole, gapless, within windows, and within one block of the shares."""
    blocks = {}
    for r in rows:
        b = blocks.setdefault(r["block_position"], [r["source"], r["source_block"], r["round"], r["release"], r["deadline"], set()])
        assert b[:2] == [r["source"], r["source_block"]] and r["row_in_block"] not in b[5]
        b[5].add(r["row_in_block"])
    assert sorted(blocks) == list(range(len(blocks)))
    per_source = Counter()
    rounds = {}
    for at in sorted(blocks):
        source, n, rnd, release, deadline, held = blocks[at]
        assert n == per_source[source] and release <= at < deadline and held == set(range(len(held))) and len(held) <= block_rows
        per_source[source] += 1
        rounds.setdefault(rnd, []).append(source)
    for members in rounds.values():
        weight, done = Counter(members), Counter()
        for t, s in enumerate(members, 1):
            done[s] += 1
            assert all(abs(done[x] - weight[x] * t / len(members)) < 1 for x in weight)


def test_mixing(spark):
    out = mixing.query(spark, SF_CHECK).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(i for i, _ in docs_of(spark))
    check_mix(out, mixing.SLOTS, mixing.BLOCK_ROWS)


def test_mixing_with_weights_a_hot_source_and_odd_rows(spark):
    rows = ROWS + [(100 + i, f"t{i}", "en", "hot") for i in range(500)] + [(700 + i, "same", "en", "b") for i in range(90)]
    weights = spark.createDataFrame([("hot", 0.5), ("b", 0.3), (None, 0.1), ("unused", 0.1)], "source string, weight double")
    docs = frame(spark, rows)
    mixed = mixing.mix(spark, docs, weights, slots=20, block_rows=4)
    out = mixed.select("row.doc_id", F.col("row.source").alias("source"), "source_block", "round", "release", "deadline", "block_position", "row_in_block").collect()
    assert sorted(r["doc_id"] or -1 for r in out) == sorted(r[0] or -1 for r in rows)
    check_mix(out, 20, 4)
    first = [r["source"] for r in out if r["round"] == 0]
    assert Counter(first)["hot"] > Counter(first)["b"] > 0
    assert mixing.in_order(mixed).columns == docs.columns
    assert mixing.mix(spark, frame(spark, [])).count() == 0


def mixed_sources(spark, counts, weights, **how):
    """The mixed order of the sources, a block a row."""
    docs = spark.createDataFrame([(s, n) for s, n in counts.items()], "source string, n int")
    docs = docs.select("source", F.explode(F.sequence(F.lit(1), "n")).alias("doc_id")).withColumn("text", F.lit("t"))
    given = None if weights is None else spark.createDataFrame(list(weights.items()), "source string, weight double")
    mixed = mixing.mix(spark, docs, given, block_rows=1, **how)
    out = mixed.select("row.source", "source_block", "round", "release", "deadline", "block_position", "row_in_block").collect()
    check_mix(out, mixing.SLOTS, 1)
    assert Counter(r["source"] for r in out) == Counter(counts)
    return [r["source"] for r in sorted(out, key=lambda r: r["block_position"])]


def off_target(order, targets):
    """The largest distance of a source from its target, in blocks, over all prefixes."""
    done, worst = Counter(), Counter()
    for t, s in enumerate(order):
        worst[s] = max(worst[s], abs(done[s] - targets[s] * t), abs(done[s] + 1 - targets[s] * (t + 1)))
        done[s] += 1
    return {s: max(worst[s], abs(done[s] - targets[s] * len(order))) for s in targets}


def test_mixing_meets_the_targets_of_thousands_of_sources(spark):
    small = [f"s{i}" for i in range(2000)]
    targets = {"hot": 0.5, **dict.fromkeys(small, 0.00025)}
    off = off_target(mixed_sources(spark, {"hot": 4000, **dict.fromkeys(small, 2)}, targets)[:4000], targets)
    assert off.pop("hot") < 4 and max(off.values()) < 1.5
    # by row counts: a third of the rows in one source
    counts = {"hot": 1000, **dict.fromkeys(small, 1)}
    total = sum(n**0.5 for n in counts.values())
    targets = {s: n**0.5 / total for s, n in counts.items()}
    off = off_target(mixed_sources(spark, counts, None)[:1500], targets)
    assert off.pop("hot") < 4 and max(off.values()) < 1.5


def test_mixing_with_a_tiny_a_zero_and_a_missing_weight(spark):
    counts = {"a": 4000, "b": 4000, "tiny": 4, "zero": 30, "below": 30, "missing": 4}
    weights = {"a": 0.5, "b": 0.4998, "tiny": 0.0001, "zero": 0.0, "below": -1.0}
    order = mixed_sources(spark, counts, weights)
    targets = {s: max(0.0, weights.get(s, 0.0001)) for s in counts}
    assert max(off_target(order[:7900], targets).values()) < 3
    assert set(order[-60:]) == {"zero", "below"} and abs(Counter(order[-30:])["zero"] - 15) <= 1
    assert set(mixed_sources(spark, {"a": 3, "b": 3}, {"a": 0.0})[:3]) == {"a", "b"}


# -- op 9 -------------------------------------------------------------------------
def plain_leaks(rows, items):
    """Item-sized windows compared one by one."""
    sets = {}
    for item, t in items:
        w = brute.words(t)
        if w:
            sets[item] = (len(w), brute.shingles(t))
    df = Counter(s for _, ss in sets.values() for s in ss)
    n = len(items)
    weight = lambda s: (1 + math.log(n / df[s])) / (1 + math.log(n)) if s in df else 1.0
    out = set()
    for doc, t in rows:
        w = brute.words(t)
        mine = brute.shingles(t)
        for item, (size, ss) in sets.items():
            if size >= 5 and not mine & ss:
                continue
            for s in range(max(1, len(w) - size + 1)):
                win = brute.shingles(" ".join(w[s : s + size]))
                both = sum(map(weight, win & ss))
                if both / (sum(map(weight, win)) + sum(map(weight, ss)) - both) >= decontaminate.SIMILARITY - 1e-12:
                    out.add((doc, item))
                    break
    return out


def test_decontamination_query(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.query(spark, SF_CHECK).collect()}
    assert got == plain_leaks(docs_of(spark), items) and got


def test_decontamination_of_edited_passages_and_odd_rows(spark, monkeypatch):
    item = " ".join(f"q{i}" for i in range(50))
    edited = item.replace("q49", "zz").upper()
    items = [(1, item), (2, None), (3, ""), (4, "two words"), (5, item + " tail"), (None, "a b c d e f g")]
    rows = [(1, f"before {edited} after"), (2, item.replace("q25", "x").replace("q10", "y")), (3, None), (4, ""), (5, "two words"), (6, "has two words inside"), (7, LONG), (7, "pre " + item)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, [(*r, "en", "s") for r in rows])
    want = plain_leaks(rows, items)
    for size, windows in ((decontaminate.MAX_ITEM_BYTES, decontaminate.WINDOWS_AT_ONCE), (1, 7)):  # 1: a block an item
        monkeypatch.setattr(decontaminate, "MAX_ITEM_BYTES", size)
        monkeypatch.setattr(decontaminate, "WINDOWS_AT_ONCE", windows)
        assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(spark, docs, bench).collect()} == want
    assert (1, 1) in want and (5, 4) in want and (6, 4) in want
    assert sorted(r["doc_id"] for r in decontaminate.clean(spark, docs, bench).collect()) == sorted(set(i for i, _ in rows) - {d for d, _ in want} | {7})
    assert decontaminate.find_leaks(spark, docs, bench.limit(0)).count() == 0 and decontaminate.find_leaks(spark, docs.limit(0), bench).count() == 0


def test_short_items_are_found_inside_longer_texts(spark):
    items = [(1, "alpha"), (2, "Alpha Beta"), (3, "alpha beta"), (4, "alpha beta gamma"), (5, "a b c d"), (6, "a b c d e"), (7, "never here"), (8, " "), (9, None)]
    texts = ["alpha", "ALPHA\tbeta", "beta alpha", "x alpha beta gamma y", "a b c d", "a b c d e", "0 a b c d e 1", "a b c", "", None, "alphabet a", LONG + " a b c d", "alpha " * 3000 + "beta", "a b c", "d"]
    rows = list(enumerate(texts))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, [(*r, "en", "s") for r in rows])
    found = decontaminate.find_leaks(spark, docs, bench).collect()
    want = plain_leaks(rows, items)
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == sorted(want)  # one row each
    assert {(0, 1), (1, 2), (1, 3), (3, 4), (6, 5), (6, 6), (11, 5), (12, 3)} <= want and not any(i == 7 or d in (7, 10) for d, i in want)
    assert next(r["first_word"] for r in found if (r["doc_id"], r["item_id"]) == (12, 3)) == 2999
    assert sorted(r["doc_id"] for r in decontaminate.clean(spark, docs, bench).collect()) == sorted({d for d, _ in rows} - {d for d, _ in want})


def test_twenty_thousand_items_are_one_index_of_bounded_size(spark):
    import pickle

    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 30_000, int(rng.integers(8, 60)))) for _ in range(20_000)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    (index,) = decontaminate.item_blocks(items)  # one pass over the documents
    assert len(index.ids) == 20_000 and len(pickle.dumps(index)) < 8 * sum(map(len, texts))
    picked = [17, 4_444, 19_999]
    docs = [f"before it {texts[i]} and after" for i in picked] + ["nothing of the kind is in here at all", ""]
    got = [(d, index.ids[i]) for d, i, _, _ in decontaminate.matches(index, pa.array(docs, pa.large_string()))]
    assert got == list(enumerate(picked))


@pytest.mark.parametrize("n_items", [1, 40, 6000])
def test_multi_index_finds_all_fingerprints_within_the_radius(n_items):
    """Both ways of looking a block value up, against a scan of all items."""
    rng = np.random.default_rng(n_items)
    prints = rng.integers(0, 2**63, n_items, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    index = decontaminate._length_index(np.arange(n_items), prints)
    windows = prints[rng.integers(0, n_items, 300)].copy()
    for w in range(len(windows)):
        for bit in rng.choice(64, int(rng.integers(0, 26)), replace=False):
            windows[w] ^= np.uint64(1) << np.uint64(bit)
    got = set(zip(*(x.tolist() for x in decontaminate._candidates(index, windows))))
    near = np.bitwise_count(windows[:, None] ^ prints[None, :]) <= decontaminate.RADIUS
    assert got == set(zip(*(x.tolist() for x in np.nonzero(near)))) and len(got) > 100


def test_decontamination_ignores_case_in_any_script(spark):
    items = [
        (1, "Élan vital où l'âme êta déjà naïve près d'une forêt brûlée çà et là vers Orléans été"),
        (2, "Σωκράτης και ο λόγος της πόλεως είναι ο βίος των ανθρώπων που ζουν εκεί"),
        (3, "Мама мыла раму и потом пошла в лес за грибами вместе с детьми"),
        (4, "plain words of an item that has only letters without any accent in it"),
    ]
    rows = [(i, f"pre {t.upper()} post") for i, t in items] + [(10 + i, t.lower()) for i, t in items] + [(20, "ÉLAN VITAL OÙ L'ÂME autre chose ici")]
    lower = lambda rs: [(i, t.lower()) for i, t in rs]
    want = plain_leaks(lower(rows), lower(items))
    assert want == {(d + i, i) for i, _ in items for d in (0, 10)}
    docs, bench = frame(spark, [(*r, "de", "s") for r in rows]), spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(spark, docs, bench).collect()} == want
    assert [r["doc_id"] for r in decontaminate.clean(spark, docs, bench).collect()] == [20]
    # capitals of ß are SS
    item = "Die Straße am Fluß heißt große Grußstraße und süße Soße fließt außen"
    sharp, loud = spark.createDataFrame([(1, item)], "item_id long, text string"), frame(spark, [(1, item.upper(), "de", "s")])
    assert decontaminate.find_leaks(spark, loud, sharp).count() == 1


def test_multi_index_finds_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 2**63, 40, dtype=np.uint64)
    index = decontaminate._length_index(np.arange(40), prints)
    probes = []
    for p in prints:
        for k in range(0, 24, 2):
            probes.append(p ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))))
    probes = np.array(probes, np.uint64)
    w, i = decontaminate._candidates(index, probes)
    want = {(a, b) for a in range(len(probes)) for b in range(40) if bin(int(probes[a] ^ prints[b])).count("1") <= decontaminate.RADIUS}
    assert set(zip(w.tolist(), i.tolist())) == want


# -- op 10 ------------------------------------------------------------------------
def check_fingerprints(rows, got):
    """rows in order: (id, text)"""
    for (i, t), (_, nxt), r in zip(rows, rows[1:] + rows[:1], got):
        t, nxt = t or "", nxt or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + nxt[:cut]
        assert (r["doc_id"], r["n_chars"], r["edited_sha256"]) == (i, len(t), hashlib.sha256(edited.encode()).hexdigest())
        for other, near in ((edited, r["near_edited"]), (nxt, r["near_next"])):
            a, b = brute.shingles(t), brute.shingles(other)
            exact = len(a & b) / len(a | b) if a and b else float(not a and not b)
            assert abs(near - exact) < (0.25 if len(a | b) > fingerprints.K else 1e-9)


def test_fingerprints_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "PART_BYTES", 100_000)  # many ranges
    rows = sorted(docs_of(spark))
    got = sorted(fingerprints.query(spark, SF_CHECK).collect(), key=lambda r: r["doc_id"])
    check_fingerprints(rows, got)
    by_text = {}
    for (_, t), r in zip(rows, got):
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]


def test_fingerprints_of_odd_rows_and_merging(spark):
    rows = [(None, "x y z"), (1, None), (2, ""), (3, LONG), (4, "𝄞 é one two three four five six")]
    got = fingerprints.edited_fingerprints(frame(spark, [(*r, "en", "s") for r in rows])).collect()
    check_fingerprints(rows, sorted(got, key=lambda r: -1 if r["doc_id"] is None else r["doc_id"]))
    assert fingerprints.edited_fingerprints(frame(spark, [])).count() == 0
    (one,) = fingerprints.edited_fingerprints(frame(spark, [(9, "a b c d e f g h", "en", "s")])).collect()
    assert one["near_next"] == 1.0
    halves = [" ".join(f"w{i}" for i in range(a, b)) for a, b in ((0, 3000), (2996, 6000))]
    df = spark.createDataFrame([(1, t, "k") for t in halves * 3] + [(2, "", "k")], "part long, text string, k string")
    merged = {r["part"]: r for r in fingerprints.merge_by(df.withColumn("fp", fingerprints.fingerprint(F.col("text"))), "part", "fp").collect()}
    whole = fingerprints.sketches(pa.array([" ".join(f"w{i}" for i in range(6000))]))[0]
    assert merged[1]["sketch"] == fingerprints.encode(whole) and abs(merged[1]["n_distinct"] / 5996 - 1) < 0.3
    half = fingerprints.sketches(pa.array(halves[:1]))[0]
    assert abs(fingerprints.containment(half, whole) - 1) < 0.35 and fingerprints.containment(whole[:0], half) == 1.0


# -- pipeline -----------------------------------------------------------------------
def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    columns = docs.columns
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language ID"](spark, docs, SF_CHECK)
    assert first.columns == columns
    kept = {r["doc_id"] for r in first.collect()}
    assert kept == {i for i, t in rows if any(c.isalpha() for c in t or "")}
    groups = brute.jaccard_groups([r for r in rows if r[0] in kept])
    firsts = {c for _, _, c, _ in groups}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {d for d, _ in plain_leaks([r for r in rows if r[0] in firsts], items)}
    out = corpus_pipeline.run(spark, SF_CHECK).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(firsts - leaked)
    text = dict(rows)
    check_shards([(r["doc_id"], text[r["doc_id"]], r["size"], r["shard"], r["slot"]) for r in out], 8)


@pytest.mark.parametrize("rows", [ROWS, []])
def test_pipeline_stages_on_odd_rows(spark, rows):
    docs = frame(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_CHECK)
        assert docs.columns == frame(spark, []).columns
        docs = corpus_pipeline.materialise(spark, docs, "test-stage")
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_CHECK)
    assert sorted(last.columns) == sorted(docs.columns)  # size, shard and slot are the stage's
    left = corpus_pipeline.materialise(spark, last, "test-stage")
    assert dict(left.dtypes)["size"] == "bigint"
    texts = {r[1] for r in rows if any(c.isalpha() for c in r[1] or "")}
    assert left.count() == len(texts)


def test_pipeline_shards_keep_the_order_of_the_mix(spark):
    rng = np.random.default_rng(5)
    rows = [(i, f"text {i} " + "x" * int(rng.integers(1, 2000)), "en", f"s{int(i ** 0.5) % 4}") for i in range(700)]
    docs = frame(spark, rows).repartition(5)
    order = mixing.mix(spark, docs).select("row.doc_id", "block_position", "row_in_block").orderBy("block_position", "row_in_block").collect()
    stages = dict(corpus_pipeline.STAGES)
    mixed = corpus_pipeline.materialise(spark, stages["mixing"](spark, docs, SF_CHECK), "test-stage")
    out = stages["sharding"](spark, mixed, SF_CHECK).select("doc_id", "text", "size", "shard", "slot").collect()
    sizes = check_shards([tuple(r) for r in out], 8)
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in out)
    assert [r["doc_id"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))] == [r["doc_id"] for r in order]


def test_rows_in_the_order_of_their_files_and_cut_in_it(spark, tmp_path):
    from keelson.llm.columns import in_file_order

    docs = frame(spark, [(1000 - i, "x" * (i % 50) + "y" * (5000 * (i == 77)), "en", "s") for i in range(300)])
    ordered = docs.repartitionByRange(12, F.desc("doc_id")).sortWithinPartitions(F.desc("doc_id"))
    ordered.write.option("maxRecordsPerFile", 7).parquet(str(tmp_path / "t"))
    want = list(range(1000, 700, -1))
    read = spark.read.parquet(str(tmp_path / "t"))
    assert len(read.inputFiles()) > 30
    for df in (read, ordered):  # rows that don't come from files are written first
        got = {r["position"]: r["doc_id"] for r in in_file_order(df).select("row.doc_id", "position").collect()}
        assert [got[i] for i in sorted(got)] == want and sorted(got) == list(range(300))
    placed = in_file_order(read.withColumn("_metadata", F.lit(1)))
    out = sharding.cut_in_order(spark, placed, 4, part_bytes=500).select("row.doc_id", "row.text", "size", "shard", "slot").collect()
    check_shards([tuple(r) for r in out], 4)
    assert [r["doc_id"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))] == want
    assert sharding.cut_in_order(spark, in_file_order(docs.limit(0))).count() == 0
