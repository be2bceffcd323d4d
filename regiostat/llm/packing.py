"""Operator 2: conflict-constrained best-fit packing.

Documents are cut into pieces of at most ``CAPACITY`` words and packed into
bins of that capacity, largest first.  Open bins are ordered by residual and
carry two bitmaps: the sources and the duplicate clusters they hold.  A piece
goes to the successor of its size in that order; the search goes on through
larger residuals until a bin has neither its source nor its cluster, and opens
a new bin if none has.

Pieces are dealt by a hash to shards of about ``SHARD`` pieces, each packed by
one task; the number of shards grows with the table, so a hot source or
cluster is spread over all of them.

Defined cases: a document without words is one piece of length 0 and is
packed too; a null source or cluster conflicts with nothing; pieces of one
document conflict with each other through its cluster; repeated rows are
packed one by one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .mixing import word_count

CAPACITY = 2048
SHARD = 4096
SEED = 7


def _bitmap(values: list) -> tuple[np.ndarray, np.ndarray, int]:
    """Word index and bit of each value's place (bit 0 for null or unique values), and the words needed."""
    codes, uniques = pd.factorize(pd.Series(values, dtype=object), use_na_sentinel=True)
    often = np.bincount(codes[codes >= 0], minlength=len(uniques)) > 1
    place = np.where(often, np.cumsum(often) - 1, -1)
    place = np.append(place, -1)[codes]  # code -1 is null
    bits = np.where(place >= 0, np.uint64(1) << (np.maximum(place, 0) % 64).astype(np.uint64), np.uint64(0))
    return np.maximum(place, 0) // 64, bits, max(1, int(often.sum() + 63) // 64)


def best_fit(sizes, sources, clusters, capacity: int) -> np.ndarray:
    """Bin of each piece, pieces given in the order of packing."""
    n = len(sizes)
    s_word, s_bit, s_words = _bitmap(sources)
    c_word, c_bit, c_words = _bitmap(clusters)
    s_map = np.zeros((64, s_words), np.uint64)  # grows with the bins
    c_map = np.zeros((64, c_words), np.uint64)
    residual = np.empty(n + 1, np.int64)  # of the open bins, ascending; beside it the bins
    bins = np.empty(n + 1, np.int64)
    count = made = 0
    out = np.empty(n, np.int64)
    for k in range(n):
        size = sizes[k]
        at = int(np.searchsorted(residual[:count], size))
        found = -1
        step = 64
        while at < count:  # successor search
            some = bins[at:min(at + step, count)]
            free = ((s_map[some, s_word[k]] & s_bit[k]) | (c_map[some, c_word[k]] & c_bit[k])) == 0
            first = int(free.argmax())
            if free[first]:
                found = at + first
                break
            at += len(some)
            step *= 4
        if found < 0:
            b, left = made, capacity - size
            made += 1
            if made > len(s_map):
                s_map = np.concatenate([s_map, np.zeros_like(s_map)])
                c_map = np.concatenate([c_map, np.zeros_like(c_map)])
        else:
            b, left = int(bins[found]), residual[found] - size
            residual[found:count - 1] = residual[found + 1:count]
            bins[found:count - 1] = bins[found + 1:count]
            count -= 1
        s_map[b, s_word[k]] |= s_bit[k]
        c_map[b, c_word[k]] |= c_bit[k]
        out[k] = b
        to = int(np.searchsorted(residual[:count], left, side="right"))  # after equals: older bins first
        residual[to + 1:count + 1] = residual[to:count]
        bins[to + 1:count + 1] = bins[to:count]
        residual[to], bins[to] = left, b
        count += 1
    return out


PACKED = ("doc_id long, source string, piece int, start_word long, n_words long, bin_id long, "
          "bin_position int, bin_offset long")


def _packer(capacity: int):
    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("n_words", "descending"), ("row_id", "ascending"), ("piece", "ascending")])
        sizes = rows["n_words"].to_numpy()
        found = best_fit(sizes, rows["source"].to_pylist(), rows["cluster"].to_pylist(), capacity)
        bins = pd.Series(sizes).groupby(found)
        return pa.table({
            **{c: rows[c] for c in ("doc_id", "source", "piece", "start_word", "n_words")},
            "bin_id": pa.array((rows["shard"][0].as_py() << 32) + found),
            "bin_position": pa.array(bins.cumcount().to_numpy(), pa.int32()),
            "bin_offset": pa.array(bins.cumsum().to_numpy() - sizes, pa.int64())})

    return pack


def pieces(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None) -> DataFrame:
    """row_id, doc_id, source, cluster, piece, start_word, n_words of every piece.

    The cluster is the column ``cluster``, as near-duplicate components, and
    without one the hash of the text: documents with equal texts conflict.
    """
    own = F.col(cluster) if cluster else F.when(F.length("text") > 0, F.xxhash64("text"))
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "source", own.alias("cluster"),
                       word_count(F.col("text")).alias("words"))
    last = F.greatest(F.lit(0), F.ceil(F.col("words") / capacity) - 1)
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    start = F.col("piece").cast("long") * capacity
    return rows.select("row_id", "doc_id", "source", "cluster", "piece", start.alias("start_word"),
                       F.least(F.lit(capacity), F.col("words") - start).cast("long").alias("n_words"))


def pack_pieces(rows: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Pack the result of :func:`pieces` (or a table with its columns)."""
    rows = saved(rows, "pack-pieces")
    shards = max(1, -(-rows.count() // shard))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(SEED), "row_id", "piece"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(_packer(capacity), PACKED)


def pack(docs: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, cluster: str | None = None) -> DataFrame:
    """The packing of whole documents: which words lie where in which bin."""
    return pack_pieces(pieces(docs, capacity, cluster), capacity, shard)
