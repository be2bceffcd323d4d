"""Which keys of a batch are stored already (O-05, O-36), for a large store.

Three things keep the check small however large the store is: only the
partitions that the batch touches are read; a Bloom filter of their keys,
built by one aggregation of fixed size, lets most new keys pass without a
join; what the filter can't rule out is settled exactly by an anti join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Partitions named in a filter; a batch that touches more is joined on the partition columns instead.
MAX_PARTITIONS = 10_000
#: Size of the filter (1 MB) and hash functions of a key: about 2.5 % false positives at a million keys.
BITS = 1 << 23
HASHES = 4


def touched_partitions(batch: DataFrame, columns: Sequence[str], most: int = MAX_PARTITIONS) -> list[tuple] | None:
    """The distinct partitions of a batch; None if there are more than ``most``."""
    rows = batch.select(*columns).distinct().limit(most + 1).collect()
    return None if len(rows) > most else sorted((tuple(r) for r in rows), key=lambda t: tuple((x is not None, x) for x in t))


def partition_filter(partitions: list[tuple], columns: Sequence[str]) -> Column:
    """A filter on literal partition values, which the scan prunes folders by:
    values of the last column are listed for each combination of the others."""
    if not partitions:
        return F.lit(False)

    def is_(column: str, value) -> Column:
        return F.col(column).isNull() if value is None else F.col(column) == F.lit(value)

    by_head: dict[tuple, list] = {}
    for p in partitions:
        by_head.setdefault(p[:-1], []).append(p[-1])
    terms = []
    for head, lasts in by_head.items():
        values = [v for v in lasts if v is not None]
        tail = [F.col(columns[-1]).isin(values)] if values else []
        tail += [F.col(columns[-1]).isNull()] if len(values) < len(lasts) else []
        terms.append(reduce(and_, [is_(c, v) for c, v in zip(columns, head)], reduce(or_, tail)))
    return reduce(or_, terms)


def _positions(keys: Sequence[str], bits: int, hashes: int) -> list[Column]:
    # two hashes give all positions; reduced first, as ANSI arithmetic must not overflow
    one = F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(bits))
    two = F.pmod(F.xxhash64(F.lit(2), *keys), F.lit(bits))
    return [F.pmod(one + F.lit(j) * two + F.lit(j * j), F.lit(bits)) for j in range(hashes)]


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (position % 64).cast("int"))


def bloom_filter(keys_of: DataFrame, keys: Sequence[str], bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """One row, ``bloom``: the filter as ``bits / 64`` words.

    Words are merged map side, so at most that many rows leave a task whatever
    the number of keys, and a key held by many rows costs nothing more.
    """
    at = keys_of.select(F.explode(F.array(*_positions(keys, bits, hashes))).alias("at"))
    words = at.groupBy(F.floor(F.col("at") / 64).cast("int").alias("word")).agg(F.bit_or(_bit(F.col("at"))).alias("mask"))
    every = keys_of.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"))
    full = every.join(words, "word", "left").select("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "mask")))  # bits / 64 entries by construction
    return full.agg(F.transform(ordered, lambda x: x["mask"]).alias("bloom"))


def might_contain(bloom: Column, keys: Sequence[str], bits: int = BITS, hashes: int = HASHES) -> Column:
    """False only if the key is surely not in the filter."""
    return reduce(and_, (F.element_at(bloom, (F.floor(p / 64) + 1).cast("int")).bitwiseAND(_bit(p)) != 0
                         for p in _positions(keys, bits, hashes)))


def new_rows(batch: DataFrame, stored: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = (),
             bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """Rows of ``batch`` whose key has no row in ``stored``: the result of a plain anti join.

    ``partition_by`` are key columns that ``stored`` is partitioned by.  The
    batch is read three times and should be a stored or checkpointed table.  A
    NULL in a key matches nothing, so its row is new.
    """
    keys = list(keys)
    if partition_by:
        touched = touched_partitions(batch, partition_by)
        if touched is not None:
            stored = stored.where(partition_filter(touched, partition_by))
        else:
            stored = stored.join(batch.select(*partition_by).distinct(), list(partition_by), "left_semi")
    known = stored.select(*keys)
    maybe = might_contain(bloom_filter(known, keys, bits, hashes).scalar(), keys, bits, hashes)
    marked = batch.withColumn("_maybe", F.coalesce(maybe, F.lit(True)))
    settled = marked.where("_maybe").join(known.distinct(), on=keys, how="left_anti")
    out = batch.columns
    return marked.where("not _maybe").select(*out).unionByName(settled.select(*out))
