"""N-gram Jaccard join: a prefix-tree join over globally ordered shingle sets.

Two documents link when ``100 * |intersection| >= percent * |union|`` of their
sets of distinct ``width``-word shingles (64-bit hashes; a shorter text has its
whole word sequence as its one shingle; a text without words has an empty set
and links with nothing).

1. ``_shingle_entries`` hashes the texts a slice at a time and sends each
   slice's shingles to hash buckets, packed a row per slice and bucket. A
   shingle that many documents of one slice share goes once, with its count.
2. ``_document_frequency`` counts each bucket's shingles over the corpus and
   returns to the slices those that occur in two documents or more, with the
   logarithm of their count: (rare first, then hash) is the global order.
3. ``_ordered_sets`` rebuilds each document's ordered set. A document with too
   few shared shingles to reach the threshold drops out here; it can't link.
4. Equal sets become one class. Classes that share a shingle within their
   prefixes (the first ``n - ceil(t n) + 1`` in the global order) may link; the
   components of that relation are cut into blocks of bounded volume. A class
   goes to the tile of its block and another one only if a class there shares a
   shingle of its prefix; which blocks hold a shingle is kept as bits.
5. ``_join_tiles`` joins pairs of blocks: one side's sets form a prefix tree,
   the other side's sets walk it together. Overlaps are counted once per shared
   path, and a subtree is left when its remaining length can't reach the
   threshold any more. A tile returns the number of links of each class and a
   spanning forest of them, never all pairs.
6. Connected components of the forests give the groups.

No step meets a hot shingle, group or document in one task: slices
pre-aggregate hot shingles, equal sets collapse map-side, a large group is cut
into tiles. Links within a group of near copies are all verified, so that work
grows with the square of the number of *different* texts that share prefix
shingles, not of the component that chains of them form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.columns import own_columns, row_hash
from keelson.llm.components import connected_components
from keelson.llm.text import shingle_sets, slices
from keelson.session import materialise

LOCAL_HOT = 16  # documents of one slice that share a shingle before it is sent as a count
BUCKET_BYTES = 8 << 20  # packed entries of one hash bucket, about
BLOCK_SHINGLES = 1 << 20  # shingles of one side of a tile, about
TREE_SHINGLES = 1 << 16  # shingles of one prefix tree inside a tile
PROBES = 256  # sets that walk a tree together

_SHARED = np.dtype([("lo", "<u4"), ("hi", "u1"), ("doc", "<u2")])
_COUNTED = np.dtype([("lo", "<u4"), ("hi", "u1"), ("n", "<u4")])
_LEVELLED = np.dtype([("lo", "<u4"), ("hi", "u1"), ("doc", "<u2"), ("level", "u1")])
_HELD = np.dtype([("token", "<u8"), ("doc", "<u2")])
_META = np.dtype([("id", "<i8"), ("no_id", "u1"), ("text_hash", "<i8"), ("n", "<u4"), ("sig1", "<i8"), ("sig2", "<i8")])
_EVERY = 0xFFFF  # stands for "all documents of the slice that hold it"
_LOW40 = np.uint64((1 << 40) - 1)
_LOW56 = np.uint64((1 << 56) - 1)

_ENTRY_SCHEMA = "bucket int, slice long, kind int, packed binary"
_SET_SCHEMA = "id long, text_hash long, n int, sig1 long, sig2 long, prefix int, tokens binary"


def _token(bucket: np.ndarray | int, low: np.ndarray) -> np.ndarray:
    return ((np.asarray(bucket, dtype=np.uint64) << np.uint64(40)) | low) & _LOW56


def _level(counts: np.ndarray) -> np.ndarray:
    return np.minimum(127, np.floor(4 * np.log2(counts))).astype(np.uint8)


def _need(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    return -(-n * percent // 100)


def _shingle_entries(n_buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            for docs in slices(batch, "text"):
                yield _slice_entries(docs, (part << 32) | seq, n_buckets, width)
                seq += 1

    return run


def _slice_entries(docs: pa.RecordBatch, slice_id: int, n_buckets: int, width: int) -> pa.RecordBatch:
    hashes, at = shingle_sets(docs.column("text"), width)
    sizes = np.diff(at)
    rows: list[tuple[int, int, bytes]] = []

    meta = np.zeros(docs.num_rows, dtype=_META)
    ids = docs.column("id")
    meta["id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
    meta["no_id"] = ids.is_null().to_numpy(zero_copy_only=False)
    meta["text_hash"] = docs.column("text_hash").to_numpy(zero_copy_only=False)
    meta["n"] = sizes
    some = sizes > 0
    if some.any():
        starts = at[:-1][some]
        meta["sig1"][some] = np.add.reduceat(hashes * np.uint64(0xD6E8FEB86659FD93), starts).view(np.int64)
        meta["sig2"][some] = np.add.reduceat((hashes >> np.uint64(29)) * (hashes | np.uint64(1)), starts).view(np.int64)
    home = slice_id % n_buckets
    rows.append((home, 3, meta.tobytes()))

    order = np.argsort(hashes, kind="stable")
    h, doc = hashes[order], np.repeat(np.arange(docs.num_rows), sizes)[order].astype(np.uint16)
    low = h & _LOW40
    bucket = ((h >> np.uint64(40)) * np.uint64(n_buckets) >> np.uint64(24)).astype(np.int64)
    firsts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate((firsts, [len(h)])))
    hot = counts >= LOCAL_HOT
    in_hot = np.repeat(hot, counts)

    def packed(kind: int, buckets: np.ndarray, rec: np.ndarray) -> None:
        cuts = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1]))) if len(buckets) else []
        for s, e in zip(cuts, [*cuts[1:], len(buckets)]):
            rows.append((int(buckets[s]), kind, rec[s:e].tobytes()))

    cold = ~in_hot
    rec = np.zeros(int(cold.sum()), dtype=_SHARED)
    rec["lo"], rec["hi"], rec["doc"] = low[cold] & np.uint64(0xFFFFFFFF), low[cold] >> np.uint64(32), doc[cold]
    packed(0, bucket[cold], rec)
    if hot.any():
        hf = firsts[hot]
        rec = np.zeros(len(hf), dtype=_COUNTED)
        rec["lo"], rec["hi"], rec["n"] = low[hf] & np.uint64(0xFFFFFFFF), low[hf] >> np.uint64(32), counts[hot]
        packed(1, bucket[hf], rec)
        held = np.zeros(int(in_hot.sum()), dtype=_HELD)
        held["token"], held["doc"] = _token(bucket[in_hot], low[in_hot]), doc[in_hot]
        rows.append((home, 2, held.tobytes()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()),
            pa.array([slice_id] * len(rows), pa.int64()),
            pa.array([r[1] for r in rows], pa.int32()),
            pa.array([r[2] for r in rows], pa.binary()),
        ],
        names=["bucket", "slice", "kind", "packed"],
    )


def _document_frequency(table: pa.Table) -> pa.Table:
    kinds = table.column("kind").to_numpy()
    packed, slice_ids = table.column("packed"), table.column("slice").to_numpy()
    bucket = table.column("bucket")[0].as_py()
    out_slice, out_kind, out_packed = [], [], []
    keys, weights, docs, spans = [], [], [], []
    for i, kind in enumerate(kinds.tolist()):
        raw = packed[i].as_buffer()
        if kind >= 2:
            out_slice.append(slice_ids[i]), out_kind.append(kind), out_packed.append(raw.to_pybytes())
            continue
        rec = np.frombuffer(raw, dtype=_COUNTED if kind else _SHARED)
        keys.append(rec["lo"].astype(np.uint64) | (rec["hi"].astype(np.uint64) << np.uint64(32)))
        weights.append(rec["n"].astype(np.int64) if kind else np.ones(len(rec), np.int64))
        docs.append(np.full(len(rec), _EVERY, np.uint16) if kind else rec["doc"])
        spans.append((slice_ids[i], len(rec)))
    if keys:
        key, weight, doc = np.concatenate(keys), np.concatenate(weights), np.concatenate(docs)
        del keys, weights, docs
        order = np.argsort(key)
        sorted_key = key[order]
        firsts = np.flatnonzero(np.concatenate(([True], sorted_key[1:] != sorted_key[:-1])))
        sums = np.add.reduceat(weight[order], firsts)
        count = np.empty(len(key), np.int64)
        count[order] = np.repeat(sums, np.diff(np.concatenate((firsts, [len(key)]))))
        kept = count >= 2
        rec = np.zeros(len(key), dtype=_LEVELLED)
        rec["lo"], rec["hi"], rec["doc"], rec["level"] = key & np.uint64(0xFFFFFFFF), key >> np.uint64(32), doc, _level(count)
        at = 0
        for slice_id, length in spans:
            mine = rec[at : at + length][kept[at : at + length]]
            at += length
            if len(mine):
                out_slice.append(slice_id), out_kind.append(0), out_packed.append(mine.tobytes())
    return pa.table(
        {
            "bucket": pa.array([bucket] * len(out_slice), pa.int32()),
            "slice": pa.array(out_slice, pa.int64()),
            "kind": pa.array(out_kind, pa.int32()),
            "packed": pa.array(out_packed, pa.binary()),
        }
    )


def _ordered_sets(percent: int):
    def run(table: pa.Table) -> pa.Table:
        kinds, buckets, packed = table.column("kind").to_numpy(), table.column("bucket").to_numpy(), table.column("packed")
        meta, held, tokens, docs = None, None, [], []
        hot_token, hot_level = [], []
        for i, kind in enumerate(kinds.tolist()):
            raw = packed[i].as_buffer()
            if kind == 3:
                meta = np.frombuffer(raw, dtype=_META)
            elif kind == 2:
                held = np.frombuffer(raw, dtype=_HELD)
            else:
                rec = np.frombuffer(raw, dtype=_LEVELLED)
                token = _token(int(buckets[i]), rec["lo"].astype(np.uint64) | (rec["hi"].astype(np.uint64) << np.uint64(32)))
                every = rec["doc"] == _EVERY
                hot_token.append(token[every]), hot_level.append(rec["level"][every])
                tokens.append((token | (rec["level"].astype(np.uint64) << np.uint64(56)))[~every])
                docs.append(rec["doc"][~every])
        if held is not None:
            ht, hl = np.concatenate(hot_token), np.concatenate(hot_level)
            order = np.argsort(ht)
            level = hl[order][np.searchsorted(ht[order], held["token"])]
            tokens.append(held["token"] | (level.astype(np.uint64) << np.uint64(56)))
            docs.append(held["doc"])
        n = meta["n"].astype(np.int64)
        sets: list[bytes | None] = [None] * len(meta)
        prefix = np.zeros(len(meta), np.int64)
        if tokens:
            token, doc = np.concatenate(tokens), np.concatenate(docs).astype(np.int64)
            order = np.lexsort((token, doc))
            token = token[order]
            held_n = np.bincount(doc, minlength=len(meta))
            at = np.concatenate(([0], np.cumsum(held_n)))
            need = _need(n, percent)
            for d in np.flatnonzero((n > 0) & (held_n >= need)).tolist():
                sets[d] = token[at[d] : at[d + 1]].astype("<i8").tobytes()
                prefix[d] = n[d] - need[d] + 1 - (n[d] - held_n[d])
        return pa.table(
            {
                "id": pa.array(meta["id"], pa.int64(), mask=meta["no_id"].astype(bool)),
                "text_hash": pa.array(meta["text_hash"], pa.int64()),
                "n": pa.array(meta["n"].astype(np.int32), pa.int32()),
                "sig1": pa.array(meta["sig1"], pa.int64()),
                "sig2": pa.array(meta["sig2"], pa.int64()),
                "prefix": pa.array(prefix, pa.int32()),
                "tokens": pa.array(sets, pa.binary()),
            }
        )

    return run


def _prefix_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(s.as_buffer(), dtype="<i8")[:p] for s, p in zip(batch.column("tokens"), batch.column("prefix").to_pylist())]
        if sets:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(sets), pa.int64()),
                    pa.array(np.repeat(batch.column("sig1").to_numpy(), [len(s) for s in sets]), pa.int64()),
                ],
                names=["token", "node"],
            )


class _Tree:
    """Prefix tree over ordered sets, kept as the sorted list of the sets: a
    node is a run of neighbours with a common beginning."""

    def __init__(self, nodes: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray]):
        self.universe = np.unique(np.concatenate(sets))
        ranks = [np.searchsorted(self.universe, s) for s in sets]
        order = sorted(range(len(sets)), key=lambda i: ranks[i].tolist())
        self.nodes, self.sizes = nodes[order], sizes[order]
        self.sets = [ranks[i] for i in order]
        self.lengths = np.array([len(s) for s in self.sets])

    def links(self, nodes: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
        """(index in the tree, indexes of the probes that link with it)."""
        has = np.zeros((len(sets), len(self.universe)), dtype=bool)
        for i, s in enumerate(sets):
            at = np.searchsorted(self.universe, s)
            at = np.minimum(at, len(self.universe) - 1)
            has[i, at[self.universe[at] == s]] = True
        left = has.sum(axis=1)  # shingles of each probe that the tree knows
        stack = [(0, len(self.sets), 0, np.arange(len(sets)), np.zeros(len(sets), np.int64))]
        while stack:
            lo, hi, depth, active, overlap = stack.pop()
            first, last = self.sets[lo], self.sets[hi - 1]
            if hi - lo == 1:
                common = len(first)
            else:
                m = min(len(first), len(last))
                differ = np.flatnonzero(first[depth:m] != last[depth:m])
                common = depth + int(differ[0]) if len(differ) else m
            size, longest = int(self.sizes[lo:hi].min()), int(self.lengths[lo:hi].max())
            total = sizes[active] + size
            need = -(-total * percent // (100 + percent))
            while True:
                # what may still be added below here, from the tree's side and from the probe's
                bound = overlap + np.minimum(longest - depth, left[active] - overlap)
                alive = bound >= need
                if not alive.all():
                    active, overlap, need = active[alive], overlap[alive], need[alive]
                if len(active) == 0 or depth == common:
                    break
                step = min(common, depth + 64)
                overlap = overlap + has[np.ix_(active, first[depth:step])].sum(axis=1)
                depth = step
            if len(active) == 0:
                continue
            child = lo
            while child < hi and self.lengths[child] == depth:  # sets that end here
                exact = -(-(sizes[active] + self.sizes[child]) * percent // (100 + percent))
                found = active[(overlap >= exact) & (nodes[active] != self.nodes[child])]
                if len(found):
                    yield child, found
                child += 1
            while child < hi:
                token = self.sets[child][depth]
                a, b = child + 1, hi
                while a < b:
                    mid = (a + b) // 2
                    a, b = (mid + 1, b) if self.sets[mid][depth] == token else (a, mid)
                stack.append((child, a, depth, active, overlap))
                child = a


def _chunks(lengths: np.ndarray, volume: int, most: int) -> Iterator[tuple[int, int]]:
    start, filled = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and (filled + n > volume or i - start >= most):
            yield start, i
            start, filled = i, 0
        filled += n
    if start < len(lengths):
        yield start, len(lengths)


def _tile(nodes: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], side: np.ndarray, same: bool, percent: int) -> tuple[list, dict]:
    order = np.lexsort((nodes, sizes))
    nodes, sizes, side, sets = nodes[order], sizes[order], side[order], [sets[i] for i in order.tolist()]
    lengths = np.array([len(s) for s in sets])
    trees, probes = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
    parent: dict[int, int] = {}
    edges, counts = [], {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for s, e in _chunks(lengths[trees], TREE_SHINGLES, 4 * PROBES):
        mine = trees[s:e]
        tree = _Tree(nodes[mine], sizes[mine], [sets[i] for i in mine.tolist()])
        least, most = int(sizes[mine].min()), int(sizes[mine].max())
        near = probes[(sizes[probes] * 100 >= least * percent) & (most * 100 >= sizes[probes] * percent)]
        if same:  # each pair of a block once: probes from the tree's own chunk on
            near = near[near >= mine[0]]
        for ps, pe in _chunks(lengths[near], 16 * TREE_SHINGLES, PROBES):
            walk = near[ps:pe]
            for t, found in tree.links(nodes[walk], sizes[walk], [sets[i] for i in walk.tolist()], percent):
                a = int(tree.nodes[t])
                partners = nodes[walk[found]]
                if same:  # within the tree's own chunk a pair is met from both sides
                    partners = partners[(walk[found] > mine[-1]) | (partners > a)]
                for b in partners.tolist():
                    counts[a], counts[b] = counts.get(a, 0) + 1, counts.get(b, 0) + 1
                    ra, rb = root(a), root(b)
                    if ra != rb:
                        parent[rb] = ra
                        edges.append((a, b))
    return edges, counts


def _join_tiles(percent: int):
    def run(table: pa.Table) -> pa.Table:
        keys = table.select(["comp", "i", "j"]).to_pandas()
        out_a, out_b, out_n = [], [], []
        for (_, i, j), rows in keys.groupby(["comp", "i", "j"], sort=False).indices.items():
            part = table.take(pa.array(rows))
            sets = [np.frombuffer(s.as_buffer(), dtype="<i8") for s in part.column("tokens")]
            edges, counts = _tile(part.column("node").to_numpy(), part.column("n").to_numpy().astype(np.int64), sets, part.column("side").to_numpy(), i == j, percent)
            for a, b in edges:
                out_a.append(a), out_b.append(b), out_n.append(0)
            for a, n in counts.items():
                out_a.append(a), out_b.append(a), out_n.append(n)
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64()), "links": pa.array(out_n, pa.int64())})

    return run


def shingle_classes(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """Steps 1-3: a row per document with its set size, set signature and,
    where it may link, its ordered set; written to the shared folder."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, size * len("1234567") // 6 // BUCKET_BYTES + 1)  # about six bytes of text a word
    entries = rows.mapInArrow(_shingle_entries(n_buckets, width), _ENTRY_SCHEMA)
    levelled = entries.groupBy("bucket").applyInArrow(_document_frequency, _ENTRY_SCHEMA)
    sets = levelled.groupBy("slice").applyInArrow(_ordered_sets(percent), _SET_SCHEMA)
    return materialise(spark, sets, "ngram-sets")


def _met_blocks(held: DataFrame) -> DataFrame:
    """(node, other): the blocks, its own among them, that hold a class which shares a prefix
    shingle with the node. ``held``: (token, node, block) of the components of several blocks."""
    held = held.select("token", "node", F.expr("block div 64").alias("word"), F.expr("shiftleft(1L, block % 64)").alias("bit"))
    met = held.groupBy("token", "word").agg(F.bit_or("bit").alias("bits"))
    seen = held.select("token", "node").join(met, "token").groupBy("node", "word").agg(F.bit_or("bits").alias("bits"))
    set_bits = F.expr("explode(filter(sequence(0, 63), b -> (shiftright(bits, b) & 1L) = 1L))")
    return seen.select("node", "word", set_bits.alias("bit")).select("node", (F.col("word") * 64 + F.col("bit")).cast("int").alias("other"))


def jaccard_groups(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """Columns: id, text_hash, n, component_id, n_links, first_of_group; a row per row of ``docs``.

    ``component_id`` is the smallest id reachable by links (null only if all
    ids of the group are null), ``n_links`` the number of other distinct sets
    that link with the row's set, ``first_of_group`` marks the rows that carry
    the group's smallest (id, text_hash), nulls last. Repeated rows get equal
    results; empty or null texts stand alone; an empty table gives no rows;
    columns other than the two named are not read."""
    docs_t = shingle_classes(spark, docs, id_col, text_col, width, percent)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    classes = docs_t.filter("n > 0").groupBy("sig1", "sig2").agg(F.min(order).alias("lead"))
    sets = (
        docs_t.filter("tokens is not null")
        .groupBy("sig1")
        .agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("tokens").alias("tokens"))
    )
    sets = materialise(spark, sets, "ngram-classes")

    prefixes = sets.select("sig1", "prefix", "tokens").mapInArrow(_prefix_tokens, "token long, node long")
    shared = prefixes.groupBy("token").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead < last").select("token", "lead")
    near = prefixes.join(shared, "token").filter("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    blocks = connected_components(spark, materialise(spark, near, "ngram-near"))

    placed = sets.select(F.col("sig1").alias("node"), (F.octet_length("tokens") / 8).cast("long").alias("volume")).join(blocks, "node")
    cuts = placed.groupBy("comp").agg(F.ceil(F.sum("volume") / F.lit(BLOCK_SHINGLES)).cast("int").alias("cuts"))
    placed = placed.join(cuts, "comp").select("node", "comp", "cuts", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int").alias("block"))
    placed = materialise(spark, placed, "ngram-blocks")
    member = sets.select(F.col("sig1").alias("node"), "n", "tokens").join(placed, "node")
    if (placed.agg(F.max("cuts")).first()[0] or 1) > 1:
        others = _met_blocks(prefixes.join(placed.filter("cuts > 1"), "node"))
        member = member.join(others, "node", "left").withColumn("other", F.coalesce("other", F.lit(0)))
    else:
        member = member.withColumn("other", F.lit(0))
    tiles = member.select(
        "comp",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
        "node",
        "n",
        "tokens",
        "cuts",
    )
    volume = sets.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    bins = max(16, volume // (8 << 20))
    whole = F.col("cuts") == 1  # small components share a bin; a tile of a larger one is a group by itself
    links = (
        tiles.withColumn("bin", F.when(whole, F.pmod(F.xxhash64("comp"), F.lit(bins)))).withColumn("large", F.when(~whole, F.col("comp")))
        .groupBy("bin", "large", "i", "j")
        .applyInArrow(_join_tiles(percent), "a long, b long, links long")
    )
    links = materialise(spark, links, "ngram-links")

    groups = connected_components(spark, links.filter("a <> b").select("a", "b"))
    counts = links.filter("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n_links"))
    known = classes.join(groups, classes["sig1"] == groups["node"], "left").select(
        "sig1", "sig2", "lead", F.coalesce("comp", "sig1").alias("comp")
    )
    leads = known.groupBy("comp").agg(F.min("lead").alias("lead"))
    per_class = (
        known.drop("lead")
        .join(leads, "comp")
        .join(counts, F.col("sig1") == counts["node"], "left")
        .select("sig1", "sig2", "lead", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    )
    rows = docs_t.select("id", "text_hash", "n", "sig1", "sig2")
    joined = rows.filter("n > 0").join(per_class, ["sig1", "sig2"])
    linked = joined.select(
        "id", "text_hash", "n", F.col("lead.id").alias("component_id"), "n_links", (order.eqNullSafe(F.col("lead"))).alias("first_of_group")
    )
    alone = rows.filter("n = 0").select(
        "id", "text_hash", "n", F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("first_of_group")
    )
    return linked.unionByName(alone)


def first_of_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id.

    Of rows with equal id and equal text the one with the smallest hash of all its
    columns stays, whatever is rerun; texts without words are groups of their own."""
    groups = jaccard_groups(spark, docs, id_col, text_col, width, percent)
    firsts = materialise(spark, groups.filter("first_of_group").select("id", "text_hash").distinct(), "ngram-firsts")
    key = F.struct(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    named = docs.select(key.alias("__row"), row_hash(docs).alias("__tie"), F.struct(*own_columns(docs)).alias("__own"))
    kept = named.join(firsts.select(F.struct("id", "text_hash").alias("__first")), F.col("__row").eqNullSafe(F.col("__first")), "left_semi")
    return kept.groupBy("__row").agg(F.min_by("__own", "__tie").alias("__own")).select("__own.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_groups(spark, docs).select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "component_id", "n_links"
    )

