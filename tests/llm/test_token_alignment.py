"""Cross-tokenizer alignment against a plain version that tokenizes whole texts
and walks their byte offsets one token at a time."""

import functools
import hashlib
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import SF_CHECK
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from keelson.llm import token_alignment as align

TEXTS = [
    "The cat sat on the mat.",
    "The cat sat on the mat.",
    "the  cat\tsat \n on   the mat  ",
    " leading",
    " ",
    "\n",
    "a ",
    "",
    None,
    "naïve café Ünïcode ß 漢字かな 한국어 𝄞🎉🎉 é́",
    "<s> </s> <unk> <|endoftext|> <0x41> <|startoftext|>",
    "under▁score ▁x",
    "nul\x00 and \x85 next line　wide\xa0space ᠎",
    "x" * 5000 + " " + "=" * 700 + "\t" * 90 + " " * 333 + "end",
    "don't we'll 123456 3.14 foo_bar(baz);\r\n\r\n\treturn 0;",
    "ab" * 700 + "漢" * 300,
]


@functools.cache
def a_tokenizer():
    """Tokenizer A read by another library than the operator's, from its own merges."""
    t = Tokenizer.from_file(f"{align.TOKENIZERS}/{align.A_FILE}")
    t.encode_special_tokens = True
    return t


def decoded(tok, side, ids):
    table = tok.a_bytes if side == "a" else tok.b_bytes
    return [table[i] for i in ids]


def plain_groups(tok, text):
    """Token ids of the whole text by both, cut at common ends; None if it has no tokens."""
    if not text:
        return None
    a = a_tokenizer().encode(" " + text, add_special_tokens=False).ids
    b = tok.b.encode(text)
    ab, bb = decoded(tok, "a", a), decoded(tok, "b", b)
    if not (b"".join(ab) == b"".join(bb) == (" " + text).encode()):
        return None
    ends = {}
    for side, pieces in ((0, ab), (1, bb)):
        at, found = 0, set()
        for p in pieces:
            at += len(p)
            found.add(at)
        ends[side] = found
    both = sorted(ends[0] & ends[1])
    out = [([], []) for _ in both]
    for side, (ids, pieces) in enumerate(((a, ab), (b, bb))):
        at = g = 0
        for i, p in zip(ids, pieces):
            at += len(p)
            out[g][side].append(i)
            g += at == both[g]
    return out


def plain_alignment(tok, texts):
    groups = [plain_groups(tok, t) for t in texts]
    links = [Counter((x, y) for ga, gb in g or [] for x in ga for y in gb) for g in groups]
    count = Counter(p for d in links for p in d)
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for g, d in zip(groups, links):
        if g is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append(
            (
                sum(len(x) for x, _ in g),
                sum(len(y) for _, y in g),
                len(g),
                sum(d.values()),
                sum(n for p, n in d.items() if count[p] == most[p[0]]),
                sum(n * count[p] for p, n in d.items()),
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return out, count, sum(links, Counter())


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def tok():
    return align.tokenizers()


def frame(spark, texts):
    rows = [(None if i == 3 else i // 2 * 2 if i > 12 else i, t, "x", 1, 2, 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, id int, block int, pairs int")


def test_alignment_against_plain_version(spark, tok, monkeypatch):
    docs = frame(spark, TEXTS).repartition(3)
    expect, count, links = plain_alignment(tok, TEXTS)
    index = align.index(docs)
    assert sorted(tuple(r[c] for c in NAMES) for r in align.align(index).collect()) == sorted(expect)
    assert Counter(r["doc_id"] for r in align.align(index).collect()) == Counter(r["doc_id"] for r in docs.collect())
    pairs = {(r["a_id"], r["b_id"]): (r["n_docs"], r["n_links"]) for r in align.pair_counts(index).collect()}
    assert pairs == {p: (count[p], links[p]) for p in count}
    empty = align.align(align.index(docs.limit(0)))
    assert empty.count() == 0 and set(empty.columns) == {"doc_id", *NAMES}


def blocks_of(texts, monkeypatch=None, **limits):
    for name, value in limits.items():
        monkeypatch.setattr(align, name, value)
    known, block, out = align.Pieces(align.tokenizers()), align.Block(), []
    for part in align.text_slices(pa.array([t or "" for t in texts]), align.SLICE_BYTES):
        own, keys, links = align.tokenized(part.to_pylist(), known)
        block.keys.append(keys + len(block.ids)), block.links.append(links)
        block.ids += list(range(len(part)))
        block.own += own
    return list(block.pages(7))


def test_postings_in_pages_hold_what_one_page_holds(monkeypatch):
    whole = blocks_of(TEXTS * 9)
    pages = blocks_of(TEXTS * 9, monkeypatch, PAGE=100)
    assert len(whole) == 1 and len(pages) > 10

    def postings(batches):
        out = []
        for b in batches:
            r = b.to_pylist()[0]
            docs = align.unpack_bitmaps(np.array(r["counts"]), r["sparse"], r["dense"], r["n_docs"])
            links = align.unpack_planes(r["planes"], len(docs))
            out += list(zip(np.repeat(r["pairs"], r["counts"]).tolist(), docs.tolist(), links.tolist()))
            assert r["n_docs"] == len(TEXTS) * 9
        return out

    assert postings(whole) == postings(pages)
    assert [len(b.to_pylist()[0]["doc_ids"]) for b in pages[:2]] == [len(TEXTS) * 9, 0]
    assert max(x[2] for x in postings(whole)) > 100


@pytest.mark.parametrize("n_docs", [1, 7, 8, 300, 65_536])
def test_bitmaps_round_trip(n_docs):
    rng = np.random.default_rng(n_docs)
    sizes = np.array([min(n_docs, s) for s in (1, 2, n_docs, n_docs // 2, 1, n_docs // 16 + 1, n_docs // 17 + 1) if s])
    docs = np.concatenate([np.sort(rng.choice(n_docs, s, replace=False)) for s in sizes])
    sparse, dense = align.pack_bitmaps(sizes, docs, n_docs)
    assert align.unpack_bitmaps(sizes, sparse, dense, n_docs).tolist() == docs.tolist()
    flagged = np.where(align.is_dense(sizes, n_docs), -1, sizes)
    assert align.popcounts(flagged, dense, n_docs).tolist() == sizes.tolist()
    links = rng.integers(1, 9, len(docs))
    assert align.unpack_planes(align.pack_planes(links), len(docs)).tolist() == links.tolist()


@settings(derandomize=True, max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n.a'sB1é漢🎉　"), st.characters(codec="utf-8")), max_size=40))
def test_pieces_tokenize_like_the_whole_text(text):
    tok = align.tokenizers()
    own, _, _ = align.tokenized([text], align.Pieces(tok))
    g = plain_groups(tok, text)
    if g is None:
        assert own == [(0, 0, 0, 0, "")]
    else:
        digest = hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g).encode()).hexdigest()
        assert own[0][4] == digest


def test_cuts_hold_beside_every_kind_of_character(tok):
    """One text a Unicode category and each white-space candidate, with spaces around."""
    kinds = {}
    for c in map(chr, list(range(0xD800)) + list(range(0xE000, 0x1F900))):
        kinds.setdefault(unicodedata.category(c), []).append(c)
    some = [c for cs in kinds.values() for c in cs[:: max(1, len(cs) // 40)]]
    some += [chr(c) for c in (0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, 0x180E, 0x200B, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)]
    for c in some:
        text = f"a{c} b{c}  c {c} 1{c}\n  {c}{c}   x"
        own, _, _ = align.tokenized([text], align.Pieces(tok))
        g = plain_groups(tok, text)
        assert own[0][2] == len(g or []), hex(ord(c))


def test_every_token_and_code_point_reads_alike_in_both_libraries(tok):
    """A's merges are applied by rank: all its tokens are reached, and words are cut alike around every character."""
    words = [b.decode("utf-8", "ignore") for b in tok.a_bytes.values()]
    around = [f" a{c} 1{c}  {c}{c}\n {c}" for c in map(chr, [*range(0xD800), *range(0xE000, 0x1FB00)])]
    for texts in (words, around):
        for s in range(0, len(texts), 20_000):
            plain = [e.ids for e in a_tokenizer().encode_batch_fast(texts[s : s + 20_000], add_special_tokens=False)]
            assert plain == [tok.a.encode_ordinary(t) for t in texts[s : s + 20_000]]


def test_query_against_plain_version(spark, tok):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()]
    expect, _, _ = plain_alignment(tok, [t for _, t in rows])
    got = [(r["doc_id"], *(r[c] for c in NAMES)) for r in align.query(spark, SF_CHECK).collect()]
    assert sorted(got) == sorted((d, *e) for (d, _), e in zip(rows, expect))
