"""Operator 8: exact top-k inner products by dual-tree cover-tree search.

Vectors are dealt to cells around a bounded sample of pivots and cells are cut
into blocks of at most about ``BLOCK`` rows.  Each task builds a cover tree
over a block and one over the queries that meet it, and walks both at once: a
pair of nodes is pruned if even the largest inner product that their centres
and covering radii allow is below the worst kth score of the node's queries.
A query first searches its own block; the scores found there prune whole
pairs of query groups and blocks before any vector is sent to them.

Defined cases: vectors that are null or hold a null or a non-finite component
take no part, nor do rows without vec_id; shorter vectors count as filled up
with zeros; only the query's own row is left out, so that a repeated row is a
candidate; ties go to the smaller vec_id; scores beyond 64 bits are held at
the bounds; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved

K = 10
PIVOTS = 32
BLOCK = 4096
LEAF = 64
#: Queries that one task holds, about.
QUERIES = 8192
LOW = -(2**63) + 1
SCALE = 1024


class Node:
    __slots__ = ("center", "children", "norm", "points", "radius")

    def __init__(self, x: np.ndarray, points: np.ndarray, center: int):
        self.center, self.points, self.children = x[center], points, []
        self.norm = float(np.linalg.norm(self.center))
        self.radius = float(np.sqrt(((x[points] - self.center) ** 2).sum(axis=1).max()))


def cover_tree(x: np.ndarray) -> Node:
    """Levels halve the covering radius; siblings' centres lie further apart than it.

    Groups under a quarter of a leaf are put together into leaves.
    """
    root = Node(x, np.arange(len(x)), 0)
    todo = [(root, root.radius)]
    while todo:
        node, scale = todo.pop()
        if len(node.points) <= LEAF or node.radius == 0:
            continue
        scale = min(scale, node.radius) / 2
        rest, center, groups = node.points, node.center, []
        while len(rest):
            far = np.sqrt(((x[rest] - center) ** 2).sum(axis=1))
            near = far <= scale
            if near.any():
                groups.append(rest[near])
            rest, far = rest[~near], far[~near]
            if len(rest):
                center = x[rest[int(far.argmax())]]
        small = [g for g in groups if len(g) < LEAF // 4]
        groups = [g for g in groups if len(g) >= LEAF // 4]
        if small:
            loose = np.concatenate(small)
            groups += [loose[i:i + LEAF] for i in range(0, len(loose), LEAF)]
        for g in groups:
            child = Node(x, g, int(g[0]))
            node.children.append(child)
            if len(g) < len(node.points):
                todo.append((child, scale))
    return root


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products as long, held at the bounds."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] >= 2**52:
        wide = a.astype(object) @ b.astype(object).T
        return np.clip(wide, LOW, 2**63 - 1).astype(np.int64)
    return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64)


class Best:
    """The k best candidates of each query so far; ``floor``: scores known to be reached elsewhere."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.score = np.full((n, k), LOW, np.int64)
        self.ids = np.full((n, k), 2**63 - 1, np.int64)
        self.floor = floor

    def worst(self, q: np.ndarray) -> np.ndarray:
        return np.maximum(self.score[q, -1], self.floor[q])

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        score = np.concatenate([self.score[q], score], axis=1)
        ids = np.concatenate([self.ids[q], np.broadcast_to(ids, (len(q), len(ids)))], axis=1)
        order = np.lexsort((ids, -score), axis=-1)[:, :self.score.shape[1]]
        self.score[q] = np.take_along_axis(score, order, 1)
        self.ids[q] = np.take_along_axis(ids, order, 1)


def dual_search(queries: np.ndarray, q_rows: np.ndarray, data: np.ndarray, d_rows: np.ndarray, d_ids: np.ndarray,
                floor: np.ndarray, k: int = K) -> Best:
    """The best of ``data`` for each query, without the query's own row."""
    best = Best(len(queries), k, floor)
    x, y = queries.astype(float), data.astype(float)

    def bound(q: Node, d: Node) -> float:
        most = float(q.center @ d.center) + q.radius * d.norm + d.radius * q.norm + q.radius * d.radius
        return most + abs(most) * 1e-9 + 1

    todo = [(cover_tree(x), cover_tree(y))]
    while todo:
        q, d = todo.pop()
        if bound(q, d) < best.worst(q.points).min():
            continue
        if not q.children and not d.children:
            score = products(queries[q.points], data[d.points])
            own = q_rows[q.points][:, None] == d_rows[d.points][None, :]
            score[own] = LOW
            best.add(q.points, score, d_ids[d.points])
        elif d.children and (not q.children or d.radius >= q.radius):
            todo += sorted(((q, c) for c in d.children), key=lambda p: bound(*p))  # the most promising is last
        else:
            todo += [(c, d) for c in q.children]
    return best


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, width)


FOUND = "query_row long, query_id long, vec_id long, score long"


def _found(best: Best, rows, ids) -> pa.Table:
    at = np.nonzero(best.score > LOW)
    return pa.table({"query_row": rows[at[0]], "query_id": ids[at[0]], "vec_id": best.ids[at], "score": best.score[at]})


def _pack(width: int, pivots: np.ndarray):
    """Rows with the vector as bytes and the cell of the nearest pivot."""
    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                lists = part.column(3)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                v = np.zeros((len(lists), width), np.int64)
                inside = np.arange(width)[None, :] < sizes[:, None]
                v[inside] = lists.flatten().to_numpy(zero_copy_only=False)
                x = v.astype(float)
                far = (x**2).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(axis=1)[None, :]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1).cast(pa.int64()), part.column(2),
                     pa.array(far.argmin(axis=1), pa.int64()), pa.array([r.tobytes() for r in v], pa.binary())],
                    ["row_id", "vec_id", "is_query", "cell", "vec"])

    return pack


def _own_block(width: int, k: int):
    """Search of a block by its own queries; also the ball around the block and around its queries.

    Rows of kind 0 are candidates; kind 1 is the block, kind 2 its queries with their worst kth score.
    """
    def search(t: pa.Table) -> pa.Table:
        rows, ids = t["row_id"].to_numpy(), t["vec_id"].to_numpy()
        v = _matrix(t["vec"], width)
        asks = np.flatnonzero(t["is_query"].to_numpy(zero_copy_only=False))
        block = t["block"][0].as_py()
        x = v.astype(float)

        def ball(which, kind, floor):
            c = x[which].mean(axis=0)
            r = float(np.sqrt(((x[which] - c) ** 2).sum(axis=1).max())) * (1 + 1e-9) + 1e-6
            return {"kind": kind, "block": block, "center": c.tolist(), "radius": r, "score": floor}

        out = [ball(np.arange(len(v)), 1, None)]
        if len(asks):
            best = dual_search(v[asks], rows[asks], v, rows, ids, np.full(len(asks), LOW), k)
            out.append(ball(asks, 2, int(best.score[:, -1].min())))
            for i, a in enumerate(asks):
                for s, d in zip(best.score[i], best.ids[i]):
                    if s > LOW:
                        out.append({"kind": 0, "block": block, "query_row": rows[a], "query_id": ids[a], "vec_id": d, "score": s,
                                    "worst": best.score[i, -1]})
        return pa.Table.from_pylist(out, _OWN)

    return search


_OWN = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("center", pa.list_(pa.float64())), ("radius", pa.float64()),
                  ("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
                  ("worst", pa.int64())])
OWN = ("kind int, block long, center array<double>, radius double, query_row long, query_id long, vec_id long, "
       "score long, worst long")


@F.arrow_udf(T.DoubleType())
def _ball_bound(c1: pa.Array, r1: pa.Array, c2: pa.Array, r2: pa.Array) -> pa.Array:
    """Largest inner product of a vector in one ball with one in the other."""
    def matrix(c):
        return c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1)

    a, b = matrix(c1), matrix(c2)
    ra, rb = r1.to_numpy(zero_copy_only=False), r2.to_numpy(zero_copy_only=False)
    most = (a * b).sum(axis=1) + ra * np.linalg.norm(b, axis=1) + rb * np.linalg.norm(a, axis=1) + ra * rb
    return pa.array(most + np.abs(most) * 1e-9 + 1)


def _other_blocks(width: int, k: int):
    def search(queries: pa.Table, data: pa.Table) -> pa.Table:
        if not queries.num_rows or not data.num_rows:
            return pa.Table.from_pylist([], pa.schema([(c.split()[0], pa.int64()) for c in FOUND.split(", ")]))
        rows = queries["row_id"].to_numpy()
        best = dual_search(_matrix(queries["vec"], width), rows, _matrix(data["vec"], width), data["row_id"].to_numpy(),
                           data["vec_id"].to_numpy(), queries["worst"].to_numpy(), k)
        best.score[best.score < queries["worst"].to_numpy()[:, None]] = LOW  # can't be among the k best
        return _found(best, rows, queries["vec_id"].to_numpy())

    return search


def integer_vectors(table: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """row_id, vec_id and floor(scale * x) of the vectors that take part."""
    x = F.col(vector)
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = table.select(F.monotonically_increasing_id().alias("row_id"), "vec_id", x)
    return rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & fine).select(
        "row_id", "vec_id", F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v"))


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``vectors``: row_id, vec_id, v (array of long).  Returns query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    width = max(1, vectors.select(F.max(F.size("v"))).first()[0] or 0)
    sample = vectors.orderBy(F.xxhash64("vec_id"), "row_id").limit(PIVOTS).collect()  # bounded
    pivots = np.zeros((max(1, len(sample)), width))
    for i, r in enumerate(sample):
        pivots[i, :len(r["v"])] = r["v"]
    flagged = vectors.select("row_id", "vec_id", F.coalesce(is_query, F.lit(False)).alias("is_query"), "v")
    rows = saved(flagged.mapInArrow(_pack(width, pivots), "row_id long, vec_id long, is_query boolean, cell long, vec binary"),
                 "topk-cells")
    cells = rows.groupBy(F.col("cell").alias("c")).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    rows = rows.join(F.broadcast(cells), F.col("cell") == F.col("c"))  # at most PIVOTS rows
    rows = rows.withColumn("block", F.col("cell") * (1 << 32) + F.pmod(F.xxhash64("row_id"), "parts"))
    rows = saved(rows.select("block", "row_id", "vec_id", "is_query", "vec"), "topk-rows")

    own = saved(rows.groupBy("block").applyInArrow(_own_block(width, k), OWN), "topk-own")
    blocks = own.where("kind = 1").select(F.col("block").alias("d"), F.col("center").alias("dc"), F.col("radius").alias("dr"))
    groups = own.where("kind = 2").select(F.col("block").alias("q"), F.col("center").alias("qc"),
                                          F.col("radius").alias("qr"), F.col("score").alias("floor"))
    # query groups against blocks, one row for each ball: the block form of a query set against all rows
    pairs = groups.crossJoin(blocks).where("q <> d").withColumn("most", _ball_bound("qc", "qr", "dc", "dr"))
    pairs = saved(pairs.where(F.col("most") >= F.col("floor")).select("q", "d"), "topk-pairs")

    first = own.where("kind = 0")
    worst = first.groupBy(F.col("query_row").alias("w_row")).agg(F.min("worst").alias("worst"))
    asks = rows.where("is_query").join(worst, F.col("row_id") == F.col("w_row"), "left")
    asks = asks.select(F.col("block").alias("own"), "row_id", "vec_id", "vec", F.coalesce("worst", F.lit(LOW)).alias("worst"))
    parts = max(1, -(-asks.count() // QUERIES))
    part = F.pmod(F.xxhash64("q"), F.lit(parts))
    sent = pairs.join(asks, F.col("q") == F.col("own")).select(
        F.col("d").alias("block"), part.alias("part"), "row_id", "vec_id", "vec", "worst")
    met = pairs.select("d", part.alias("part")).distinct()
    held = met.join(rows, F.col("d") == F.col("block"))
    held = held.select(*[F.col(c).alias(c) for c in ("block", "part", "row_id", "vec_id", "vec")])
    rest = sent.groupBy("block", "part").cogroup(held.groupBy("block", "part")).applyInArrow(_other_blocks(width, k), FOUND)

    every = first.select("query_row", "query_id", "vec_id", "score").unionByName(rest)
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
