"""Operator 13: ranked lexical search by sparse ball trees.

A document is a sparse vector of term values, an item a sparse vector of term
weights, and the score their inner product.  Items are taken in groups of a
bounded number of terms.  For a group every document is read once; what is
kept are its terms that occur in the group, as others add nothing to a score.

Documents are ordered by their heaviest terms, so that similar ones and copies
lie together, and cut into blocks of ``BLOCK``.  Each block gets a ball tree:
nodes are halved by the nearer of two far documents, down to ``LEAF``; a node
has a centroid, the radius that covers its documents, and for each term a
reach: how far any document lies beyond the centroid there.  Dimensions are
scaled by the root of the term's weight, which leaves inner products as they
are and keeps radii from being ruled by terms that weigh next to nothing.

The inner product of an item and any document of a ball is at most that with
the centroid plus the lesser of norm times radius and the inner product with
the reaches (an item has a few dozen of thousands of terms, and the radius
alone, which covers all of them, prunes nothing), rounded up with a margin far
above the error of the floats.  A search takes nodes best-first and stops when the
greatest bound left lies below the worst of its best ``k``; leaves are scored
exactly, in 64-bit integers.  A first round searches the most promising leaves
of every block; the ``k``-th best of these scores is a floor that the second
round, over all blocks, starts from.  Equal scores are never pruned.

Nothing but the terms of one group (at most ``GROUP_TERMS``) is broadcast.

Defined cases: a null text has no terms; a document without terms counts
nowhere; null doc_ids rank last among equal scores; repeated rows of documents
are documents of their own; rows that repeat an item (id and text) count once;
an item without terms has no rows; extra columns are ignored; empty tables
give no rows.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, saved, small_batches

K = 10
#: Terms, with repeats, of the items that are searched together (one item at least).
GROUP_TERMS = 1 << 18
#: Documents of a ball tree, and of a leaf at most.
BLOCK = 2048
LEAF = 16
#: Leaves of a block that the first round searches, and leaves scored together at most.
FIRST, TOGETHER = 3, 64
#: Value of a term: ``UNIT * tf div (SCALE * tf + SLOPE * m)``.
UNIT, SCALE, SLOPE, FLAT, PERCENT = 1_000_000_000, 1000, 8, 10, 90
#: Relative margin of a bound, far above the error of sums of doubles.
MARGIN = 1e-9
_KEEP = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(128)) + bytes(range(128, 256))
_FOLD = _KEEP.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))


def terms(text: str | bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of other characters beyond ASCII; A-Z lower-cased."""
    if not text:
        return []
    data = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
    return data.translate(_FOLD).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


# ----------------------------------------------------------------- documents
VECTORS = "doc_id long, n long, terms binary, tfs binary"


def _vectors(batches, vocabulary):
    """Of each document its number of terms and its terms of the vocabulary with their counts."""
    place = vocabulary.value
    for b in batches:
        raw = b.column(1).cast(pa.binary())
        for at in range(0, b.num_rows, 256):
            n, ids, tfs = [], [], []
            for t in raw.slice(at, 256).to_pylist():
                w = terms(t)
                n.append(len(w))
                own = Counter(map(place.get, w))
                own.pop(None, None)
                keys = np.fromiter(own.keys(), np.int32, len(own))
                order = np.argsort(keys)
                ids.append(keys[order].tobytes())
                tfs.append(np.fromiter(own.values(), np.int32, len(own))[order].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(at, 256).cast(pa.int64()), pa.array(n, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())], ["doc_id", "n", "terms", "tfs"])


def _frequencies(batches, size: int):
    """Documents that hold each term, counted in a part of the table."""
    df = np.zeros(size, np.int64)
    for b in batches:
        df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.int32), minlength=size)
    found = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(df[found])], ["term", "df"])


def _heaviest(batches, shared):
    """The terms of a document that weigh most in it, as the order of the blocks."""
    w = shared.value
    for b in batches:
        one, two = [], []
        for ids, tfs in zip(b.column("terms").to_pylist(), b.column("tfs").to_pylist()):
            t = np.frombuffer(ids, np.int32)
            best = t[np.argsort(-(w[t] * np.minimum(np.frombuffer(tfs, np.int32), 4)), kind="stable")[:2]].tolist()
            best += [-1] * (2 - len(best))
            one.append(best[0])
            two.append(best[1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(one, pa.int32()), pa.array(two, pa.int32())],
                                         [*b.schema.names, "first", "second"])


# --------------------------------------------------------------------- trees
class Rows:
    """Sparse rows: entries of row i at ``at[i]:at[i + 1]``."""

    def __init__(self, at: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.at, self.term, self.value = at, term, value

    def take(self, rows: np.ndarray) -> "Rows":
        size = np.diff(self.at)[rows]
        at = np.r_[0, np.cumsum(size)]
        of = np.repeat(self.at[rows] - at[:-1], size) + np.arange(at[-1])
        return Rows(at, self.term[of], self.value[of])

    def sums(self, entries: np.ndarray) -> np.ndarray:
        """Sums of the entries of each row."""
        total = np.r_[np.zeros(1, entries.dtype), np.cumsum(entries)]
        return total[self.at[1:]] - total[self.at[:-1]]


def _up(x: np.ndarray) -> np.ndarray:
    """Short floats that are no smaller."""
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


class BallTree:
    """Balls over the rows of one block; rows of a node are ``start:end`` in the tree's order.

    ``value`` are exact integers; ``scale`` are the roots of the term weights.
    """

    def __init__(self, rows: Rows, scale: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(rows.at) - 1)
        scaled = Rows(rows.at, rows.term, rows.value * scale[rows.term])
        self.squares = scaled.sums(scaled.value ** 2)
        self.dense = np.zeros(len(scale))  # of one vector at a time
        self.start, self.end, self.child, self.radius, self.centroids = [], [], [], [], []
        self._build(scaled, leaf)
        del self.dense, self.squares
        n = [len(c[0]) for c in self.centroids]
        node = np.repeat(np.arange(len(n), dtype=np.int32), n)
        term = np.concatenate([c[0] for c in self.centroids])
        by_term = np.argsort(term, kind="stable")
        # centroids and reaches by term: which nodes hold it, with what value, rounded up
        self.c_term, first = np.unique(term[by_term], return_index=True)
        self.c_at, self.c_node = np.r_[first, len(term)], node[by_term]
        self.c_value, self.c_reach = (_up(np.concatenate([c[i] for c in self.centroids])[by_term]) for i in (1, 2))
        del self.centroids
        self.radius = np.array(self.radius)
        self.rows = rows.take(self.order)

    def state(self) -> dict:
        """Plain arrays and lists, which need no class to be read."""
        own = vars(self)
        return own | {"rows": (self.rows.at, self.rows.term, self.rows.value)}

    @classmethod
    def of(cls, state: dict) -> "BallTree":
        tree = cls.__new__(cls)
        vars(tree).update(state | {"rows": Rows(*state["rows"])})
        return tree

    def _node(self, scaled: Rows, start: int, end: int) -> tuple[Rows, np.ndarray]:
        own = scaled.take(self.order[start:end])
        terms_, inverse = np.unique(own.term, return_inverse=True)
        centre = np.bincount(inverse, own.value, minlength=len(terms_)) / (end - start)
        highest = np.zeros(len(terms_))
        np.maximum.at(highest, inverse, own.value)
        away = self._away(own, self.order[start:end], terms_, centre)
        self.start.append(start)
        self.end.append(end)
        self.child.append(-1)
        self.centroids.append((terms_, centre, highest - centre * (1 - MARGIN)))
        # squared distances carry rounding errors of the norms they come from
        error = MARGIN * (self.squares[self.order[start:end]].max(initial=0.0) + centre @ centre)
        self.radius.append(math.sqrt(max(away.max(initial=0.0), 0.0) + error) * (1 + MARGIN))
        return own, away

    def _away(self, own: Rows, which: np.ndarray, term: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Squared distances of rows from one vector."""
        self.dense[term] = value
        out = self.squares[which] - 2 * own.sums(own.value * self.dense[own.term]) + value @ value
        self.dense[term] = 0
        return out

    def _build(self, scaled: Rows, leaf: int) -> None:
        parts = [(len(self.start), *self._node(scaled, 0, len(self.order)))]
        while parts:
            node, own, away = parts.pop()
            start, end = self.start[node], self.end[node]
            if end - start <= leaf:
                continue
            which = self.order[start:end]
            far = []
            for _ in range(2):  # two documents far from each other
                i = int(away.argmax())
                one = slice(own.at[i], own.at[i + 1])
                away = self._away(own, which, own.term[one], own.value[one])
                far.append(away)
            # nearer to the first of them or to the second; copies and ties are halved
            lead = far[0] - far[1]
            cut = np.argsort(lead, kind="stable")
            middle = int((lead < 0).sum())
            if not leaf // 2 <= middle <= end - start - leaf // 2:
                middle = (end - start) // 2
            self.order[start:end] = which[cut]
            self.child[node] = len(self.start)
            left = (len(self.start), *self._node(scaled, start, start + middle))
            right = (len(self.start), *self._node(scaled, start + middle, end))
            parts += [left, right]

    def bounds(self, term: np.ndarray, w: np.ndarray, root: np.ndarray) -> np.ndarray:
        """What no score of each node exceeds, for an item of these sorted terms with weights ``w``."""
        place = np.searchsorted(self.c_term, term)
        held = (place < len(self.c_term)) & (self.c_term[np.minimum(place, len(self.c_term) - 1)] == term)
        place, q = place[held], root[term[held]]
        size = self.c_at[place + 1] - self.c_at[place]
        of = np.repeat(self.c_at[place] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        node, q = self.c_node[of], np.repeat(q, size)
        centre = np.bincount(node, self.c_value[of] * q, minlength=len(self.start))
        beyond = np.bincount(node, self.c_reach[of] * q, minlength=len(self.start))
        norm = math.sqrt(float(w.sum())) * (1 + MARGIN)
        return (centre + np.minimum(beyond, norm * self.radius)) * (1 + MARGIN) + 1

    def scores(self, leaves: list[int], dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of some leaves and their exact scores; ``dense`` has the item's weights."""
        rows = np.concatenate([np.arange(self.start[n], self.end[n]) for n in leaves])
        own = self.rows.take(rows)
        return rows, np.add.reduceat(dense[own.term] * own.value, own.at[:-1])  # no row is empty

    def search(self, term, w, root, dense, rank, k: int, floor: int, leaves: int | None = None) -> list[tuple[int, int]]:
        """The best rows (score, row) with at least ``floor`` points, best-first.

        ``rank`` orders the rows among equal scores; ``leaves`` ends the search
        after so many.  Leaves are scored together, one, two, four and so on,
        so that few calls serve many leaves and the first ones raise the floor.
        """
        bound = self.bounds(term, w, root)
        queue, step, least = [(-bound[0], 0)], 1, max(floor, 1)
        best_row, best = np.empty(0, np.int64), np.empty(0, np.int64)
        while queue:
            some: list[int] = []
            while queue and len(some) < step and -queue[0][0] >= least:
                node = heapq.heappop(queue)[1]
                if self.child[node] < 0:
                    some.append(node)
                    continue
                for c in (self.child[node], self.child[node] + 1):
                    heapq.heappush(queue, (-bound[c], c))
            if not some:
                break
            row, found = self.scores(some, dense)
            good = found >= least
            best_row, best = np.r_[best_row, row[good]], np.r_[best, found[good]]
            if len(best) > k:
                top = np.lexsort((rank[best_row], -best))[:k]
                best_row, best = best_row[top], best[top]
            if len(best) == k:
                least = max(least, int(best.min()))
            if leaves is not None:
                leaves -= len(some)
                if leaves <= 0:
                    break
            step = min(2 * step, TOGETHER)
        return list(zip(best.tolist(), best_row.tolist()))


def _blocks(batches, shared, total: int, length: int, block: int):
    """A pickled tree for every ``block`` rows of a sorted partition: (ids, tree)."""
    w = shared.value
    scale = np.sqrt(w.astype(float))
    held: list = []

    def tree():
        ids = [r[0] for r in held]
        n = np.array([r[1] for r in held], object)  # exact, however many terms there are
        m = np.array([FLAT + PERCENT * x * total // length for x in n], np.int64)
        at = np.r_[0, np.cumsum([len(r[2]) // 4 for r in held])]
        term = np.frombuffer(b"".join(r[2] for r in held), np.int32)
        tf = np.frombuffer(b"".join(r[3] for r in held), np.int32).astype(np.int64)
        value = (UNIT * tf // (SCALE * tf + SLOPE * np.repeat(m, np.diff(at)))).astype(np.int32)  # below UNIT / SCALE
        found = BallTree(Rows(at, term, value), scale)
        missing = np.array([x is None for x in ids])[found.order]
        numbers = np.array([x or 0 for x in ids], np.int64)[found.order]
        rank = np.empty(len(ids), np.int64)
        rank[np.lexsort((numbers, missing))] = np.arange(len(ids))
        return pa.RecordBatch.from_arrays(
            [pa.array([pickle.dumps((numbers, missing, rank, found.state()), pickle.HIGHEST_PROTOCOL)], pa.binary())], ["tree"])

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "terms", "tfs"))):
            if row[2]:
                held.append(row)
            if len(held) >= block:
                yield tree()
                held.clear()
    if held:
        yield tree()


FOUND = "item int, doc_id long, score long"


def _found(batches, shared, floors, k: int, leaves: int | None):
    """The best rows of every block for every item of the group."""
    w, items = shared.value
    root, dense = np.sqrt(w.astype(float)), np.zeros(len(w), np.int64)
    for b in batches:
        for i in range(b.num_rows):
            numbers, missing, rank, state = pickle.loads(b.column(0)[i].as_py())
            tree = BallTree.of(state)
            item, doc, score = [], [], []
            for q, term in enumerate(items):
                own = w[term]
                dense[term] = own
                for s, row in tree.search(term, own, root, dense, rank, k, floors[q], leaves):
                    item.append(q)
                    doc.append(None if missing[row] else int(numbers[row]))
                    score.append(s)
                dense[term] = 0
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64()),
                                              pa.array(score, pa.int64())], ["item", "doc_id", "score"])


def _best(found: DataFrame, k: int) -> DataFrame:
    # each block sends k rows an item at most; of these Spark keeps k before the exchange
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


# -------------------------------------------------------------------- search
def item_groups(items: DataFrame, most: int = GROUP_TERMS):
    """Groups of items whose terms are at most ``most`` together: lists of (item_id, distinct terms).

    The items are read in order a partition at a time; one group is held.
    """
    group, held = [], 0
    chosen = items.select("item_id", "text").distinct().orderBy("item_id", "text")
    for row in chosen.toLocalIterator():
        own = sorted(set(terms(row["text"])))
        if not own:
            continue
        if group and held + len(own) > most:
            yield group
            group, held = [], 0
        group.append((row["item_id"], own))
        held += len(own)
    if group:
        yield group


def _search_group(docs: DataFrame, group: list, k: int, block: int, leaf_round: bool) -> DataFrame | None:
    spark = docs.sparkSession
    sc = spark.sparkContext
    place = {t: i for i, t in enumerate(sorted({t for _, own in group for t in own}))}
    words = sc.broadcast(place)
    vectors = saved(docs.select("doc_id", "text").mapInArrow(lambda b: _vectors(b, words), VECTORS), "lexical-vectors")
    total, length = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not total:
        return None
    size = len(place)
    df = vectors.select("terms").mapInArrow(lambda b: _frequencies(b, size), "term long, df long")
    w = np.zeros(size, np.int64)
    seen = np.zeros(size, np.int64)
    for r in df.groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most one row a term of the group
        seen[r["term"]] = r["df"]
    w[:] = [weight(total, int(d)) for d in seen]
    weights = sc.broadcast(w)

    placed = vectors.where(F.length("terms") > 0).mapInArrow(lambda b: _heaviest(b, weights), VECTORS + ", first int, second int")
    tie = F.xxhash64("doc_id", "terms", "tfs")
    blocks = placed.repartitionByRange(partitions(spark), "first", "second", tie).sortWithinPartitions("first", "second", tie)
    trees = saved(blocks.mapInArrow(lambda b: _blocks(b, weights, total, length, block), "tree binary"), "lexical-trees")

    queries = sc.broadcast((w, [np.array([place[t] for t in own], np.int64) for _, own in group]))
    floors = [1] * len(group)
    if leaf_round:
        first = _best(trees.mapInArrow(lambda b: _found(b, queries, floors, k, FIRST), FOUND), k)
        for r in first.where(F.col("rank") == k).collect():  # one number an item
            floors[r["item"]] = max(1, r["score"])
    found = _best(trees.mapInArrow(lambda b: _found(b, queries, floors, k, None), FOUND), k)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(group)], "item int, item_id long")
    return found.join(F.broadcast(names), "item").select(  # at most one row a term of the group
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked(items: DataFrame, docs: DataFrame, k: int = K, most: int = GROUP_TERMS, block: int = BLOCK,
           leaf_round: bool = True) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a score above 0 of every item."""
    small_batches(docs.sparkSession)
    out = None
    for group in item_groups(items, most):
        one = _search_group(docs, group, k, block, leaf_round)
        if one is not None:
            out = one if out is None else out.unionByName(one)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out
