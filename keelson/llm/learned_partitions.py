"""Approximate nearest neighbours by learned partitions.

Fitted on a bounded sample of distinct vectors: the sample's neighbour graph is cut into
parts of equal size (spectral bisection, then moves to where most neighbours are while
there is room), and a small classifier (one hidden layer, numpy) learns from each
vector the parts of its neighbours. Every row is indexed under its most probable part; a
query looks into its several most probable ones. How many is found on rows of the sample
that neither graph nor classifier saw, queries and neighbours alike, so that the recall
there reaches ``target_recall``.

Within the parts looked into the search is exact: rows and queries meet in tiles of
bounded size, (part, slice of its rows, slice of its queries), so a part that holds a third
of all rows is only more tiles. Distances are Euclidean, in double precision, from the
original vectors. A query that finds fewer than ``k`` rows is searched again in all parts.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
rows without an id or vectors of another length than the most frequent (the shorter, on
ties). Nearest first, ties to the smaller id. A query never finds rows of its own id; rows
of equal id and vector count once; rows of one id and different vectors are queries and
candidates of their own. Fewer than two rows, or none, give no neighbours. Only the columns
named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.session import materialise

K = 10
SAMPLE = 16_384  # vectors that the index is fitted on, and their bytes
SAMPLE_BYTES = 32 << 20
PART_SAMPLE = 192  # vectors of the sample a part
MAX_PARTS = 64
TILE_BYTES = 4 << 20  # vectors of a tile, as doubles, on each side
TARGET_RECALL = 0.95


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as doubles, a row each."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = len(vectors)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


# -- fitting --------------------------------------------------------------------------
def neighbours(x: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of x for each row number in ``rows``."""
    d = (x**2).sum(axis=1)[None, :] - 2 * (x[rows] @ x.T)
    d[np.arange(len(rows)), rows] = np.inf
    return np.argpartition(d, k - 1, axis=1)[:, :k]


def neighbour_graph(spark: SparkSession, x: np.ndarray, k: int) -> np.ndarray:
    """``neighbours`` of all rows, blocks of rows as Spark tasks; x is the bounded sample."""
    shared, n, block = spark.sparkContext.broadcast(x.astype(np.float32)), len(x), 512

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.column("id").to_pylist():
                rows = np.arange(b * block, min(n, (b + 1) * block))
                near = neighbours(shared.value, rows, k)
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(near.tolist(), pa.list_(pa.int32()))], names=["row", "near"])

    n_blocks = -(-n // block)
    found = spark.range(0, n_blocks, 1, min(n_blocks, 16)).mapInArrow(run, "row long, near array<int>").toArrow()
    out = np.zeros((n, k), np.int64)
    out[found["row"].to_numpy()] = np.array(found["near"].to_pylist(), np.int64)
    return out


def _bisect(nodes: np.ndarray, a: np.ndarray, b: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """The ``size`` nodes of one side: power iteration towards the second eigenvector of the
    normalised graph of the nodes' edges (a, b), then a cut at the wanted size."""
    n = len(nodes)
    degree = np.bincount(a, minlength=n) + 1.0
    root = np.sqrt(degree)
    trivial = root / np.linalg.norm(root)
    v = rng.normal(size=n)
    for _ in range(60):
        v -= trivial * (trivial @ v)
        w = v / root
        v = (np.bincount(a, weights=w[b], minlength=n) + w) / root + v
        v /= max(np.linalg.norm(v), 1e-300)
    return np.argsort(v / root, kind="stable")[:size]


def balanced_parts(near: np.ndarray, n_parts: int, rounds: int = 6, slack: float = 0.05, seed: int = 7) -> np.ndarray:
    """A part for each node of a neighbour graph; sizes within ``slack`` of equal."""
    n, k = near.shape
    rng = np.random.default_rng(seed)
    a, b = np.repeat(np.arange(n), k), near.ravel()
    a, b = np.concatenate((a, b)), np.concatenate((b, a))
    part = np.zeros(n, np.int64)
    todo = [(np.arange(n), 0, n_parts)]
    while todo:
        nodes, first, parts = todo.pop()
        if parts == 1 or len(nodes) == 0:
            part[nodes] = first
            continue
        left = parts // 2
        at = np.full(n, -1)
        at[nodes] = np.arange(len(nodes))
        inside = (at[a] >= 0) & (at[b] >= 0)
        mine = np.zeros(len(nodes), bool)
        mine[_bisect(nodes, at[a[inside]], at[b[inside]], round(len(nodes) * left / parts), rng)] = True
        todo += [(nodes[mine], first, left), (nodes[~mine], first + left, parts - left)]
    room = int(np.ceil(n / n_parts * (1 + slack)))
    least = int(np.floor(n / n_parts * (1 - slack)))
    size = np.bincount(part, minlength=n_parts)
    for _ in range(rounds):
        held = np.zeros((n, n_parts), np.int32)
        np.add.at(held, (a, part[b]), 1)
        gain = held.max(axis=1) - held[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())].tolist():
            to = int(np.argmax(np.where(size < room, held[i], -1)))
            if held[i, to] > held[i, part[i]] and size[part[i]] > least:
                size[part[i]] -= 1
                size[to] += 1
                part[i] = to
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """Classifier of vectors to parts: standardised inputs, one hidden layer."""

    mean: np.ndarray
    scale: float
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    probes: int = 1

    @property
    def n_parts(self) -> int:
        return len(self.out_bias)

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum((x - self.mean) * self.scale @ self.hidden + self.hidden_bias, 0)
        return z @ self.out + self.out_bias

    def best(self, x: np.ndarray) -> np.ndarray:
        return np.argmax(self.scores(x), axis=1) if len(x) else np.zeros(0, np.int64)

    def probed(self, x: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :n] if len(x) else np.zeros((0, n), np.int64)


def train_router(x: np.ndarray, wanted: np.ndarray, width: int = 128, epochs: int = 20, rate: float = 2e-3, seed: int = 7) -> Router:
    """Cross entropy against ``wanted`` (a row of part probabilities per vector), by Adam."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    mean = x.mean(axis=0)
    scale = 1 / max(float((x - mean).std()), 1e-300)
    x = ((x - mean) * scale).astype(np.float32)
    p = [
        rng.normal(0, np.sqrt(2 / d), (d, width)).astype(np.float32),
        np.zeros(width, np.float32),
        rng.normal(0, np.sqrt(1 / width), (width, wanted.shape[1])).astype(np.float32),
        np.zeros(wanted.shape[1], np.float32),
    ]
    m, v, t = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
    order = np.arange(n)
    for epoch in range(epochs):
        rng.shuffle(order)
        for s in range(0, n, 256):
            pick = order[s : s + 256]
            xb = x[pick]
            h = np.maximum(xb @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (z / z.sum(axis=1, keepdims=True) - wanted[pick]) / len(pick)
            dh = (dz @ p[2].T) * (h > 0)
            grads = [xb.T @ dh + 1e-4 * p[0], dh.sum(axis=0), h.T @ dz + 1e-4 * p[2], dz.sum(axis=0)]
            t += 1
            step = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
            for w, g, a, b in zip(p, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= step * a / (np.sqrt(b) + 1e-8)
    return Router(mean, scale, *[w.astype(np.float64) for w in p])


def probes_needed(router: Router, x: np.ndarray, k: int, target: float) -> int:
    """Parts to look into so that rows of x find ``target`` of their k nearest in x."""
    if len(x) <= 1:
        return router.n_parts
    k = min(k, len(x) - 1)
    near = neighbours(x, np.arange(len(x)), k)
    order = router.probed(x, router.n_parts)
    rank = np.argsort(order, axis=1)
    at = rank[np.arange(len(x))[:, None], router.best(x)[near]]
    share = np.cumsum(np.bincount(at.ravel(), minlength=router.n_parts)) / at.size
    return int(min(router.n_parts, np.searchsorted(share, target) + 1))


def fit(spark: SparkSession, vectors: DataFrame, k: int = K, target_recall: float = TARGET_RECALL, max_sample: int = SAMPLE) -> Router:
    """``vectors``: column ``vector``, cleaned. The sample is the distinct vectors with the
    smallest hashes; every fourth is held back to find the number of parts to look into."""
    hashed = vectors.select("vector", F.xxhash64("vector").alias("h"))
    facts = hashed.agg(F.approx_count_distinct("h").alias("n"), F.max(F.size("vector")).alias("d")).first()
    size = min(max_sample, SAMPLE_BYTES // (8 * (facts["d"] or 1)))
    share = min(1.0, 2 * size / max(1, facts["n"]))
    some = hashed.filter((F.col("h") / 2.0**64 + 0.5) <= share).groupBy("h").agg(F.min("vector").alias("vector"))
    x = matrix(some.orderBy("h").limit(size).select("vector").toArrow()["vector"])
    n_parts = min(MAX_PARTS, len(x) // PART_SAMPLE)
    if n_parts < 2:
        d = x.shape[1]
        return Router(np.zeros(d), 1.0, np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    held = np.arange(len(x)) % 4 == 3
    seen = x[~held]
    near = neighbour_graph(spark, seen, min(k, len(seen) - 1))
    part = balanced_parts(near, n_parts)
    wanted = np.zeros((len(seen), n_parts), np.float32)
    np.add.at(wanted, (np.repeat(np.arange(len(seen)), near.shape[1]), part[near].ravel()), 1)
    wanted[np.arange(len(seen)), part] += 1
    router = train_router(seen, wanted / wanted.sum(axis=1, keepdims=True))
    router.probes = probes_needed(router, x[held][:4096], k, target_recall)
    return router


# -- index and search -----------------------------------------------------------------
def clean(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector) of the rows that take part."""
    vector = F.col(f"`{vector_col}`")
    if rows.schema[vector_col].dataType.simpleString() != "array<float>":
        vector = vector.cast("array<double>")
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = rows.filter("id is not null and vector is not null").filter(finite & F.exists("vector", lambda v: v != 0))
    length = good.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return good.filter(F.size("vector") == (length["d"] if length else 0))


def _part_of(spark: SparkSession, router: Router, n: int | None) -> Column:
    """The part of a vector, or with n its n most probable parts."""
    shared = spark.sparkContext.broadcast(router)

    @F.arrow_udf("int" if n is None else "array<int>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            x = matrix(vectors)
            if n is None:
                yield pa.array(shared.value.best(x), pa.int32())
            else:
                yield pa.array(shared.value.probed(x, n).tolist(), pa.list_(pa.int32()))

    return udf("vector")


def build(spark: SparkSession, rows: DataFrame, router: Router) -> DataFrame:
    """The index of all cleaned rows: (id, vector, part), written once."""
    return materialise(spark, rows.withColumn("part", _part_of(spark, router, None)), "ann-index")


def nearest(x: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, ids, distances) of each query's k nearest rows, exactly.

    A matrix product finds all rows that may belong; their distances are then taken from
    differences. Of equal vectors only the smallest ids can be needed."""
    keys = np.ascontiguousarray(x).view(f"V{x.shape[1] * 8}").ravel()
    _, first, of = np.unique(keys, return_index=True, return_inverse=True)
    order = np.lexsort((ids, of))
    again = np.zeros(len(order), bool)
    again[1:] = (of[order][1:] == of[order][:-1]) & (ids[order][1:] == ids[order][:-1])
    order = order[~again]
    starts = np.searchsorted(of[order], np.arange(len(first) + 1))
    x = x[first]
    unit = 1 / max(np.abs(x).max(), np.abs(queries).max())
    xs = x * unit
    x2 = (xs**2).sum(axis=1)
    for s in range(0, len(queries), 256):
        qs = queries[s : s + 256] * unit
        q2 = (qs**2).sum(axis=1)
        rough = x2[None, :] + q2[:, None] - 2 * (qs @ xs.T)
        # of the k + 1 nearest distinct vectors one may hold no other id than the query's
        edge = np.partition(rough, min(k, len(x) - 1), axis=1)[:, min(k, len(x) - 1)]
        limit = edge + 1e-13 * (len(x[0]) + 8) * (q2 + x2.max())
        for i in range(len(qs)):
            near = np.flatnonzero(rough[i] <= limit[i])
            distance = np.sqrt(((x[near] - queries[s + i]) ** 2).sum(axis=1))
            rows = [order[starts[j] : min(starts[j] + k + 1, starts[j + 1])] for j in near]
            distance, found = np.repeat(distance, [len(r) for r in rows]), ids[np.concatenate(rows)]
            other = found != query_ids[s + i]
            distance, found = distance[other], found[other]
            top = np.lexsort((found, distance))[:k]
            yield s + i, found[top], distance[top]


def _tile(k: int):
    def run(key, rows: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("of", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if rows.num_rows == 0 or queries.num_rows == 0:
            return schema.empty_table()
        query_ids, of = queries["id"].to_numpy(), queries["of"].to_numpy()
        out = list(nearest(matrix(rows["vector"]), rows["id"].to_numpy(), matrix(queries["vector"]), query_ids, k))
        times = [len(found) for _, found, _ in out]
        at = np.repeat([i for i, _, _ in out], times)
        return pa.table([query_ids[at], of[at], np.concatenate([f for _, f, _ in out]), np.concatenate([d for _, _, d in out])], schema=schema)

    return run


def _looked_up(values: list[int], at: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)) for v in values]), at)


def _search(index: DataFrame, asked: DataFrame, n_parts: int, k: int) -> DataFrame:
    """``asked``: (id, of, vector, part), a row per query and part to look into."""
    width = len(index.select("vector").head(1)[0][0]) * 8
    tile = max(256, TILE_BYTES // width)

    def tiles(df: DataFrame) -> list[int]:
        held = {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}
        return [max(1, -(-held.get(p, 0) // tile)) for p in range(n_parts)]

    row_tiles, query_tiles = tiles(index), tiles(asked)

    def sliced(key: str, n: list[int]) -> Column:
        return F.pmod(F.xxhash64(key), _looked_up(n, F.col("part"))).cast("int")

    def every(n: list[int]) -> Column:
        return F.explode(F.sequence(F.lit(0), _looked_up(n, F.col("part")) - 1))

    rows = index.withColumn("row_tile", sliced("id", row_tiles)).withColumn("query_tile", every(query_tiles))
    # rows of one id share a slice, so that repeated rows meet; queries are dealt by id too
    queries = asked.withColumn("query_tile", sliced("id", query_tiles)).withColumn("row_tile", every(row_tiles))
    key = ["part", "row_tile", "query_tile"]
    hits = rows.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(_tile(k), "query_id long, of long, vec_id long, score double")
    order = Window.partitionBy("query_id", "of").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(spark: SparkSession, index: DataFrame, queries: DataFrame, router: Router, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest indexed rows found for each query.

    ``queries`` are cleaned rows (id, vector)."""
    if index.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = queries.select("id", F.xxhash64("vector").alias("of"), "vector").dropDuplicates(["id", "of"])
    asked = materialise(spark, asked.withColumn("parts", _part_of(spark, router, router.probes)), "ann-queries")
    found = _search(index, asked.withColumn("part", F.explode("parts")).drop("parts"), router.n_parts, k)
    if router.probes < router.n_parts:
        found = materialise(spark, found, "ann-found")
        whole = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), "of")
        short = asked.join(whole, ["id", "of"], "left_anti").drop("parts")
        if not short.isEmpty():
            again = short.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(router.n_parts - 1))))
            full = _search(index, again, router.n_parts, k)
            found = found.join(short.select(F.col("id").alias("query_id"), "of"), ["query_id", "of"], "left_anti").unionByName(full)
    return found.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id is divisible by 100 against all others."""
    rows = clean(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    router = fit(spark, rows)
    index = build(spark, rows, router)
    return search(spark, index, index.filter(F.col("id") % 100 == 0).select("id", "vector"), router)
