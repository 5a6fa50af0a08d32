"""Cross-tokenizer alignment: which tokens of one vocabulary stand for which of another.

Tokenizer A is a byte-level BPE, tokenizer B a piece BPE that puts a space before the
text; both see a space and the text. Byte offsets at which tokens of both end cut the
token sequences into groups; within a group every A token is linked with every B token.
An id pair's count is the number of documents that hold it linked.

How the counts are made, without a row per document and pair in any shuffle:

1. A task takes its documents in blocks of at most 65,536. Per block an inverted index
   holds for each id pair the documents it is linked in, as a compressed bitmap (sorted
   16-bit numbers while they are few, bits beyond), made by OR-ing the bitmaps of the
   block's slices, and beside the bitmaps bit planes of the pair's multiplicities.
   Blocks are written once, with what each document has of its own.
2. A block's bitmaps are popcounted; the counts are added over blocks. Blocks share no
   document, so OR-ing a pair's bitmaps over blocks lays them side by side, and their
   popcounts add. Link counts come from the planes in the same way.
3. Each pair's count goes back to the blocks that hold it (one short row a pair and block),
   and the block's postings spread it to the documents.

Within a task texts are cut before spaces that follow a character other than white space.
No token of A or B reaches over such a place (A's pattern starts a new word there, B has no
piece with a space after another character), so both token sequences are those of the whole
text, and equal pieces are tokenized once.

Null, empty, very long and repeated rows: a null or empty text has no tokens, zeros and an
empty ``groups_sha256``; so does a text whose joined tokens differ from space and text (it
holds U+2581, say). Texts are never cut short; a block ends when its postings are many, and
postings beyond a page of them go in further pages. Rows with one id, or none, count each as
a document. An empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.text import text_slices
from keelson.session import materialise

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPECIAL = ("<|endoftext|>",)  # A's special tokens: text that reads like one is ordinary text
# Fixed value: how a byte-level vocabulary of this kind cuts text into words.
A_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 16 << 20  # text of a block, about
BLOCK_DOCS = 1 << 16  # a document's number in its block has 16 bits
PAGE = 1 << 21  # postings of a block's page, and of a block, about
MAX_TYPES = 300_000  # text pieces that a task remembers, and their links
MAX_LINKS = 3_000_000
_CUT = re.compile(r"(?<=[^\s▁])(?= )")
_SHIFT = 16  # bits of a document's number, and of a B id


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes
    for themselves, the others in order from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, the bytes of each of their ids, and their ids in decimal."""

    def __init__(self, folder: str):
        import json

        import sentencepiece
        import tiktoken

        with open(f"{folder}/{A_FILE}", encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{B_FILE}")
        letters = _byte_of_letter()
        merged = {"".join(m) if isinstance(m, list) else m.replace(" ", ""): n for n, m in enumerate(model["merges"])}
        # A merges by rank, and its ids are the ranks: every token is a letter or the next merge
        if any(len(t) > 1 and t not in merged for t in model["vocab"] if t not in SPECIAL) or any(model["vocab"][t] != n + 256 for t, n in merged.items()):
            raise ValueError(f"{A_FILE}: ids aren't in the order of the merges")
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if t not in SPECIAL}
        self.a = tiktoken.Encoding("a", pat_str=A_PATTERN, mergeable_ranks={b: i for i, b in self.a_bytes.items()}, special_tokens={})
        self.b_bytes = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes[i] = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode("utf-8")
        if len(self.b_bytes) > 1 << _SHIFT:
            raise ValueError("ids of the second tokenizer must fit 16 bits")
        self.lone_space = self.b.encode("a ")[len(self.b.encode("a")) :]
        self.n_a = 1 + max(self.a_bytes)
        n_b = len(self.b_bytes)
        self.a_list = [self.a_bytes.get(i, b"") for i in range(self.n_a)]
        self.b_list = [self.b_bytes[i] for i in range(n_b)]
        self.a_size, self.b_size = (np.array([len(x) for x in each], np.int64) for each in (self.a_list, self.b_list))
        # decimal ids followed by what separates them: A , | then B , ; and a line end after a piece
        self.shown = [b"%d%s" % (i, end) for n, ends in ((self.n_a, (b",", b"|")), (n_b, (b",", b";", b"\n"))) for end in ends for i in range(n)]

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B of each piece; a piece starts with a space."""
        encode = self.a.encode_ordinary
        a = [encode(p) for p in pieces]
        b = self.b.encode([p[1:] for p in pieces], num_threads=1)
        return a, [self.lone_space if p == " " else ids for p, ids in zip(pieces, b)]


_loaded: dict[str, Tokenizers] = {}


def tokenizers(folder: str = TOKENIZERS) -> Tokenizers:
    if folder not in _loaded:
        _loaded[folder] = Tokenizers(folder)
    return _loaded[folder]


def group_links(a_ids: np.ndarray, b_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed pairs, their link counts) of one group."""
    a, n_a = np.unique(a_ids, return_counts=True)
    b, n_b = np.unique(b_ids, return_counts=True)
    return ((a << _SHIFT)[:, None] | b[None]).ravel(), (n_a[:, None] * n_b[None]).ravel()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] numbers), then those of the next start."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


class Pieces:
    """Tokenized text pieces by number: their figures, written groups and links."""

    def __init__(self, tok: Tokenizers):
        self.tok = tok
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.written: list[bytes] = []
        self.figures = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, whether the joined bytes fit
        self.starts = np.zeros(1, np.int64)  # of each piece's links
        self.pairs = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)

    def add(self, pieces: list[str]) -> None:
        """Tokenize new pieces, a few thousand at a time."""
        found = [self._read(pieces[s : s + 4096]) for s in range(0, len(pieces), 4096)]
        for p in pieces:
            self.number[p] = len(self.number)
        for f in found:
            self.written += f[1]
        self.figures = np.concatenate([self.figures, *[f[0] for f in found]])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate([f[2] for f in found]))])
        self.pairs = np.concatenate([self.pairs, *[f[3] for f in found]])
        self.links = np.concatenate([self.links, *[f[4] for f in found]])

    def links_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(how many pairs each of the pieces has, the pairs, their links)."""
        sizes = self.starts[numbers + 1] - self.starts[numbers]
        at = _ranges(self.starts[numbers], sizes)
        return sizes, self.pairs[at], self.links[at]

    def _read(self, pieces: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """(figures, written groups, number of pairs, pairs, links) of pieces."""
        tok, n = self.tok, len(pieces)
        a_ids, b_ids = tok.encode(pieces)
        raw = [p.encode("utf-8") for p in pieces]
        fits = np.ones(n, bool)
        for ids, table, size in ((a_ids, tok.a_list, tok.a_size), (b_ids, tok.b_list, tok.b_size)):
            flat = list(chain.from_iterable(ids))
            ends = np.concatenate(([0], np.cumsum(size[flat] if flat else [], dtype=np.int64)))[np.cumsum([len(x) for x in ids])]
            if b"".join([table[t] for t in flat]) != b"".join(raw) or (ends != np.cumsum([len(r) for r in raw])).any():
                fits &= [b"".join([table[t] for t in x]) == r for x, r in zip(ids, raw)]
        if not fits.all():
            a_ids, b_ids, raw = ([x if fit else [] for x, fit in zip(each, fits)] for each in (a_ids, b_ids, raw))
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a_ids, b_ids))
        a_end, b_end = np.cumsum(tok.a_size[a]), np.cumsum(tok.b_size[b])
        # a group ends where tokens of both end; all pieces lie one after another
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        a_first, b_first = (np.concatenate(([0], np.searchsorted(e, ends, side="right"))) for e in (a_end, b_end))
        p, q = np.diff(a_first), np.diff(b_first)
        piece_end = np.cumsum([len(r) for r in raw])
        of = np.searchsorted(piece_end, ends)  # the piece of each group
        n_groups, n_links = np.bincount(of, minlength=n), np.zeros(n, np.int64)
        np.add.at(n_links, of, p * q)

        few = p * q <= 64
        sizes = np.where(few, p * q, 0)
        inner = _ranges(np.zeros(len(p), np.int64), sizes)
        width = np.repeat(q, sizes)
        pairs = a[np.repeat(a_first[:-1], sizes) + inner // np.maximum(width, 1)] << _SHIFT | b[np.repeat(b_first[:-1], sizes) + inner % np.maximum(width, 1)]
        keys, links = [np.repeat(of, sizes) << 32 | pairs], [np.ones(len(pairs), np.int64)]
        for g in np.flatnonzero(~few).tolist():
            many, times = group_links(a[a_first[g] : a_first[g + 1]], b[b_first[g] : b_first[g + 1]])
            keys.append(of[g] << 32 | many)
            links.append(times)
        key, link = _added(np.concatenate(keys), np.concatenate(links))

        # A's tokens, then B's, of one group after another, each with what follows it
        n_tokens, last = len(a) + len(b), np.zeros(len(ends), bool)
        last[np.flatnonzero(np.diff(of, append=n))] = True
        a_group, b_group = np.repeat(np.arange(len(p)), p), np.repeat(np.arange(len(q)), q)
        a_ends, b_ends = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_ends[a_first[1:] - 1] = True
        b_ends[b_first[1:] - 1] = True
        codes = np.zeros(n_tokens, np.int64)
        codes[np.arange(len(a)) + b_first[a_group]] = a + a_ends * tok.n_a
        codes[np.arange(len(b)) + a_first[b_group + 1]] = b + 2 * tok.n_a + b_ends * (1 + last[b_group]) * len(tok.b_list)
        lines = b"".join([tok.shown[c] for c in codes.tolist()]).split(b"\n")
        written = [b""] * n
        for i, line in zip(np.flatnonzero(n_groups).tolist(), lines):
            written[i] = line
        figures = np.stack([n_a, n_b, n_groups, n_links, fits], axis=1).astype(np.int64)
        return figures, written, np.bincount(key >> 32, minlength=n), key & 0xFFFFFFFF, link


def _added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their values."""
    if len(keys) == 0:
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], np.add.reduceat(values, starts)


# -- compressed bitmaps ---------------------------------------------------------------
def is_dense(size: np.ndarray | int, n_docs: int) -> np.ndarray | bool:
    """Whether bits take less room than 16-bit numbers."""
    return size * 16 > (n_docs + 7) // 8 * 8


def pack_bitmaps(sizes: np.ndarray, docs: np.ndarray, n_docs: int) -> tuple[bytes, bytes]:
    """(numbers of the sparse bitmaps, bits of the dense ones), one bitmap after another.

    ``docs`` holds the sorted document numbers of each bitmap, ``sizes`` how many."""
    dense = is_dense(sizes, n_docs)
    of = np.repeat(dense, sizes)
    rows = np.repeat(np.cumsum(dense) - 1, sizes)[of]
    out = []
    for start in range(0, int(dense.sum()), 512):
        mine = (rows >= start) & (rows < start + 512)
        bits = np.zeros((min(512, int(dense.sum()) - start), (n_docs + 7) // 8 * 8), bool)
        bits[rows[mine] - start, docs[of][mine]] = True
        out.append(np.packbits(bits, axis=1).tobytes())
    return docs[~of].astype("<u2").tobytes(), b"".join(out)


def unpack_bitmaps(sizes: np.ndarray, sparse: bytes, dense: bytes, n_docs: int) -> np.ndarray:
    """The document numbers of all bitmaps, one after another."""
    is_bits = is_dense(sizes, n_docs)
    of = np.repeat(is_bits, sizes)
    docs = np.zeros(int(sizes.sum()), np.int64)
    docs[~of] = np.frombuffer(sparse, "<u2")
    width = (n_docs + 7) // 8
    bits = np.frombuffer(dense, np.uint8).reshape(-1, width) if width else np.zeros((0, 0), np.uint8)
    found = [np.nonzero(np.unpackbits(bits[s : s + 512], axis=1))[1] for s in range(0, len(bits), 512)]
    docs[of] = np.concatenate(found) if found else 0
    return docs


def popcounts(sizes_of_sparse: np.ndarray, dense: bytes, n_docs: int) -> np.ndarray:
    """Documents of each bitmap: the length of a sparse one (negative entries are dense), the bits set in a dense one."""
    out = sizes_of_sparse.astype(np.int64)
    bits = np.frombuffer(dense, np.uint8).reshape(-1, max(1, (n_docs + 7) // 8))
    out[out < 0] = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    return out


def pack_planes(links: np.ndarray) -> list[bytes]:
    """Bit planes of the multiplicities less one, in posting order."""
    more = links - 1
    return [np.packbits(((more >> k) & 1).astype(bool)).tobytes() for k in range(int(more.max(initial=0)).bit_length())]


def unpack_planes(planes: list[bytes], n: int) -> np.ndarray:
    links = np.ones(n, np.int64)
    for k, plane in enumerate(planes):
        links += np.unpackbits(np.frombuffer(plane, np.uint8), count=n).astype(np.int64) << k
    return links


# -- blocks ---------------------------------------------------------------------------
_OWN = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = (
    "block long, page int, n_docs int, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs array<long>, counts array<int>, sums array<long>, sparse binary, dense binary, planes array<binary>"
)
_ARROW = pa.schema(
    [("block", pa.int64()), ("page", pa.int32()), ("n_docs", pa.int32()), ("doc_ids", pa.list_(pa.int64()))]
    + [(c, pa.list_(pa.int64())) for c in _OWN]
    + [("groups_sha256", pa.list_(pa.string())), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("sums", pa.list_(pa.int64()))]
    + [("sparse", pa.binary()), ("dense", pa.binary()), ("planes", pa.list_(pa.binary()))]
)


@dataclass
class Block:
    ids: list = field(default_factory=list)
    own: list = field(default_factory=list)  # n_a, n_b, n_groups, n_links, groups_sha256 of each document
    keys: list = field(default_factory=list)  # pair and document of each slice's postings
    links: list = field(default_factory=list)
    n_bytes: int = 0
    n_postings: int = 0

    def full(self) -> bool:
        return self.n_bytes >= BLOCK_BYTES or self.n_postings >= PAGE

    def pages(self, block: int) -> Iterator[pa.RecordBatch]:
        """The slices' postings merged, by pair and document; the first page holds the documents too."""
        keys, links = _added(np.concatenate(self.keys), np.concatenate(self.links))
        n_docs, pair = len(self.ids), keys >> _SHIFT
        starts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(pair) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(pair)))
        docs = keys & ((1 << _SHIFT) - 1)
        cuts = np.unique(np.searchsorted(starts, np.arange(0, max(1, len(pair)), PAGE)))
        for page, (p, q) in enumerate(zip(cuts.tolist(), [*cuts[1:].tolist(), len(starts)])):
            lo, hi = (int(starts[p]), int(starts[q]) if q < len(starts) else len(pair)) if len(starts) else (0, 0)
            sparse, dense = pack_bitmaps(sizes[p:q], docs[lo:hi], n_docs)
            counts = popcounts(np.where(is_dense(sizes[p:q], n_docs), -1, sizes[p:q]), dense, n_docs)
            sums = np.add.reduceat(links[lo:hi], starts[p:q] - lo) if q > p else links[:0]
            first = page == 0
            row = {
                "block": block, "page": page, "n_docs": n_docs, "doc_ids": self.ids if first else [],
                **{c: [o[i] for o in self.own] if first else [] for i, c in enumerate((*_OWN, "groups_sha256"))},
                "pairs": pair[starts[p:q]], "counts": counts, "sums": sums, "sparse": sparse, "dense": dense, "planes": pack_planes(links[lo:hi]),
            }
            yield pa.RecordBatch.from_arrays([pa.array([v], _ARROW.field(c).type) for c, v in row.items()], schema=_ARROW)


def tokenized(texts: list[str], known: Pieces) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """(n_a, n_b, n_groups, n_links, groups_sha256) of each text, and their postings:
    packed (pair, text number), sorted, with link counts."""
    pieces = [_CUT.split(" " + t) if t else [] for t in texts]
    new = list(dict.fromkeys(p for ps in pieces for p in ps if p not in known.number))
    if new:
        known.add(new)
    number = known.number
    types = np.array([number[p] for ps in pieces for p in ps], np.int64)
    at = np.concatenate(([0], np.cumsum([len(ps) for ps in pieces])))
    before = np.concatenate((np.zeros((1, 5), np.int64), np.cumsum(known.figures[types], axis=0)))
    sums = before[at[1:]] - before[at[:-1]]
    fits = (sums[:, 4] == np.diff(at)) & (np.diff(at) > 0)
    sums[~fits] = 0
    own, types_list = [], types.tolist()
    for fit, a, b, figures in zip(fits.tolist(), at[:-1].tolist(), at[1:].tolist(), sums[:, :4].tolist()):
        digest = hashlib.sha256(b";".join([known.written[i] for i in types_list[a:b]])).hexdigest() if fit else ""
        own.append((*figures, digest))
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    keys, times = _added((types << _SHIFT | doc)[fits[doc]], np.ones(int(fits[doc].sum()), np.int64))
    sizes, pairs, links = known.links_of(keys >> _SHIFT)
    return own, *_added(pairs << _SHIFT | np.repeat(keys & ((1 << _SHIFT) - 1), sizes), links * np.repeat(times, sizes))


def _blocks(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, block, number = Pieces(tokenizers(folder)), Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, start = batch.column("id").to_pylist(), 0
            for part in text_slices(batch.column("text").fill_null(""), SLICE_BYTES):
                if len(block.ids) + len(part) > BLOCK_DOCS or block.full():
                    yield from block.pages(number)
                    block, number = Block(), number + 1
                own, keys, links = tokenized(part.to_pylist(), known)
                block.keys.append(keys + len(block.ids))
                block.links.append(links)
                block.ids += ids[start : start + len(part)]
                block.own += own
                block.n_bytes += part.nbytes
                block.n_postings += len(keys)
                start += len(part)
                if len(known.number) > MAX_TYPES or len(known.pairs) > MAX_LINKS:
                    known.clear()
        if block.ids:
            yield from block.pages(number)

    return run


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """The inverted index of all documents, written once: a row per block and page."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return materialise(docs.sparkSession, rows.mapInArrow(_blocks(folder), BLOCKS), "alignment")


def _pair_counts(blocks: DataFrame) -> DataFrame:
    each = blocks.select(F.inline(F.arrays_zip("pairs", "counts", "sums")))
    return each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n_docs"), F.sum("sums").alias("n_links"))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a_id, b_id, n_docs, n_links): documents that hold the pair linked, and its links, corpus-wide."""
    a, b = F.shiftright("pair", _SHIFT), F.col("pair").bitwiseAND((1 << _SHIFT) - 1)
    return _pair_counts(blocks).select(a.alias("a_id"), b.alias("b_id"), "n_docs", "n_links")


def _spread(key, postings: pa.Table, counts: pa.Table) -> pa.Table:
    """A page's pair counts spread to its documents."""
    order = np.argsort(counts.column("pair").to_numpy())
    count, best = counts.column("n_docs").to_numpy()[order], counts.column("best").to_numpy(zero_copy_only=False)[order]
    row = {c: postings.column(c)[0].as_py() for c in ("n_docs", "counts", "sparse", "dense", "planes")}
    sizes, n = np.array(row["counts"], np.int64), row["n_docs"]
    docs = unpack_bitmaps(sizes, row["sparse"], row["dense"], n)
    links = unpack_planes(row["planes"], len(docs))
    score, hits = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(score, docs, links * np.repeat(count, sizes))
    np.add.at(hits, docs, links * np.repeat(best, sizes))
    at = np.flatnonzero(score)
    block = pa.array(np.full(len(at), key[0].as_py()), pa.int64())
    return pa.table([block, pa.array(at, pa.int32()), pa.array(hits[at]), pa.array(score[at])], names=["block", "at", "n_best", "count_sum"])


def align(blocks: DataFrame) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every
    document of an index: how many of its links are among the most widespread of their A id
    (ties included), and the sum of the pairs' counts over its links."""
    spark = blocks.sparkSession
    counts = materialise(spark, _pair_counts(blocks).select("pair", "n_docs"), "alignment-counts")
    # one row an A id: no larger than the vocabulary
    top = counts.groupBy(F.shiftright("pair", _SHIFT).alias("a")).agg(F.max("n_docs").alias("most"))
    counts = counts.join(F.broadcast(top), F.shiftright("pair", _SHIFT) == F.col("a"))
    counts = counts.select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))
    held = blocks.select(F.col("block").alias("to_block"), F.col("page").alias("to_page"), F.explode("pairs").alias("pair"))
    back = held.join(counts, "pair").select("to_block", "to_page", "pair", "n_docs", "best").groupBy("to_block", "to_page")
    postings = blocks.filter(F.size("pairs") > 0).select("block", "page", "n_docs", "counts", "sparse", "dense", "planes").groupBy("block", "page")
    spread = postings.cogroup(back).applyInArrow(_spread, "block long, at int, n_best long, count_sum long")
    scores = spread.groupBy("block", "at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    own = F.arrays_zip("doc_ids", *_OWN, "groups_sha256")
    docs = blocks.filter("page = 0").select("block", F.posexplode(own).alias("at", "own"))
    joined = docs.join(scores, ["block", "at"], "left")
    return joined.select(
        F.col("own.doc_ids").alias("doc_id"),
        *[F.col(f"own.{c}").alias(c) for c in _OWN],
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        F.col("own.groups_sha256").alias("groups_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(index(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
