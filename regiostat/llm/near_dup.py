"""Operator 1: MinHash near-duplicates with fast similarity sketching.

A sketch has ``COORDS`` coordinates.  Round r throws every shingle into one
bin by a hash of (r, shingle); a coordinate keeps the least value of the first
round that reaches its bin.  Rounds go on until all bins are filled, and from
round ``COORDS`` on each round serves one fixed bin, so that every coordinate
fills after twice as many rounds at most and estimates stay concentrated.

Bands of ``ROWS`` coordinates give buckets.  Documents with equal shingle sets
are one class, and only classes enter buckets.  Links are confirmed on the
full sets.  Which links are tried follows the components found so far: a
bucket whose members already are in one component needs no further test.
First every member is held against one hub of a bucket, in a few rounds; what
stays divided is compared block by block, all members against all, by their
sketches and then by their sets of shortened hashes; every pair that could
reach the threshold is confirmed.  So a group of thousands of copies costs a
few tests a document, no pair of a bucket is left out, and a group whose pairs
lie just below the threshold makes no rows of pairs.

Defined cases: a null or empty text, or one without words, has no shingles
and is linked with nothing; a shorter text than one shingle is one shingle;
component_id is the smallest doc_id reachable; a null doc_id keeps its own
row with null component_id and kept, and links nothing; rows that repeat a
doc_id are one node, with the union of their links; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, saved, saved_counted, words
from .components import components, hooked

#: Words of a shingle.
WIDTH = 5
PERCENT = 80
#: 32 bands of 4: a pair at similarity 0.8 shares no band with probability 5e-8.
BANDS = 32
ROWS = 4
COORDS = BANDS * ROWS
#: Rounds of hubs before buckets are compared block by block.
HUB_ROUNDS = 2
#: Hubs that a document is held against in a round after the first.
HUBS = 4
BLOCK = 256
#: Shingles that the documents of a block have together, about.
BLOCK_SHINGLES = 1 << 20
#: Pairs whose sketches agree in fewer coordinates lie six deviations below the threshold.
LEAST_AGREE = int(COORDS * (PERCENT / 100 - 6 * (0.8 * 0.2 / COORDS) ** 0.5))

_M1, _M2, _G = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(w: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array(w, dtype=object), categorize=False)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of the lower-cased (A-Z) text."""
    w = [x.lower() for x in words(text)] if text else []  # bytes.lower is A-Z only
    if not w:
        return np.empty(0, np.uint64)
    h = word_hashes(w)
    k = min(width, len(w))
    n = len(w) - k + 1
    s = np.full(n, k, np.uint64)
    for j in range(k):
        s = mixed(s * _G + h[j:j + n])
    return np.unique(s)


def sketch(s: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """The coordinates of a non-empty set, by rounds of hashed bin placement."""
    shift = np.uint64(64 - int(coords).bit_length() + 1)  # coords is a power of two
    out = np.zeros(coords, np.uint64)
    filled = np.zeros(coords, bool)
    start = 0
    while not filled.all():
        # as many rounds at once as fill all bins with high probability
        rounds = np.arange(start, min(2 * coords, start + 1 + int(1.3 * coords * np.log(coords) / len(s))), dtype=np.uint64)
        if not start and len(s) > 4 * coords:
            rounds = rounds[:1]
        y = mixed(mixed((rounds + np.uint64(1)) * _G)[:, None] ^ s[None, :])
        bins = y >> shift
        fixed = rounds >= coords
        bins[fixed] = (rounds[fixed] - np.uint64(coords))[:, None]
        # order by bin, then round, then value
        key = (bins << np.uint64(57)) | (rounds[:, None] << np.uint64(49)) | ((y << (np.uint64(64) - shift)) >> np.uint64(15))
        key = np.sort(key, axis=None)
        b = (key >> np.uint64(57)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        new = ~filled[b[first]]
        out[b[first[new]]] = key[first[new]]
        filled[b[first[new]]] = True
        start = int(rounds[-1]) + 1
    return out


def _sketches(batches, width: int):
    """doc_id, n_shingles, digest of the set, one byte of each coordinate, a key for each band."""
    odd = mixed(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    names = ["doc_id", "n_shingles", "d1", "d2", "bytes", "bands"]
    for batch in batches:
        texts = batch.column(1)
        for at in range(0, len(texts), 256):
            ids, n, d1, d2, low, bands = batch.column(0).slice(at, 256), [], [], [], [], []
            for t in texts.slice(at, 256).to_pylist():
                s = shingle_set(t, width)
                n.append(len(s))
                if not len(s):
                    for x in (d1, d2, low, bands):
                        x.append(None)
                    continue
                # two sums of mixed values: a 128-bit digest of the set
                d1.append(int(mixed(s).sum(dtype=np.uint64).view(np.int64)))
                d2.append(int(mixed(s ^ _G).sum(dtype=np.uint64).view(np.int64)))
                c = mixed(sketch(s))
                low.append(c.astype(np.uint8).tobytes())
                keys = mixed((c.reshape(BANDS, ROWS) * odd).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _G)
                bands.append(keys.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(low, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names)


def _sets(batches, width: int):
    for batch in batches:
        texts = batch.column(1)
        for at in range(0, len(texts), 256):
            sets = [shingle_set(t, width).view(np.int64) for t in texts.slice(at, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256).cast(pa.int64()),
                                              pa.array(sets, pa.list_(pa.int64()))], ["doc", "shingles"])


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, ca, cb) whose full sets reach the threshold."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.withColumn("common", F.size(F.array_intersect("sa", "sb")))
    union = F.size("sa") + F.size("sb") - F.col("common")
    return both.where(100 * F.col("common") >= PERCENT * union).select("a", "b", "ca", "cb")


def _block_pairs(rows: pa.Table) -> pa.Table:
    """Pairs of two blocks (or within one) in different components that could reach the threshold.

    A pair is compared in the first bucket that it shares only; that bucket is
    divided too, as it holds both components.  Sketches that agree too seldom
    go next.  Of the rest, the shortened
    hashes of one set are looked up in the other's: that counts all common
    shingles, and chance hits besides, so no link is lost.
    """
    doc, comp = rows["doc"].to_numpy(), rows["comp"].to_numpy()
    side, key = rows["side"].to_numpy(), rows["key"][0].as_py()
    bands = rows["bands"].combine_chunks().values.to_numpy().reshape(len(doc), -1)
    low = np.frombuffer(b"".join(rows["bytes"].to_pylist()), np.uint8).reshape(len(doc), -1)
    sets = rows["short"].combine_chunks()
    at, short = sets.offsets.to_numpy(), sets.values.to_numpy()
    size = np.diff(at)
    one = np.flatnonzero(side == 0)
    two = np.flatnonzero(side == 1)
    alone = not len(two)
    two = one if alone else two
    found = []
    for i in one:
        ok = two[(comp[two] != comp[i]) & (doc[two] > doc[i] if alone else True)]
        ok = ok[bands[i][(bands[ok] == bands[i]).argmax(axis=1)] == key]
        ok = ok[(low[ok] == low[i]).sum(axis=1) >= LEAST_AGREE]
        ok = ok[100 * np.minimum(size[ok], size[i]) >= PERCENT * np.maximum(size[ok], size[i])]
        if not len(ok):
            continue
        own = np.sort(short[at[i]:at[i + 1]])
        start = np.cumsum(size[ok]) - size[ok]
        theirs = short[np.repeat(at[ok] - start, size[ok]) + np.arange(size[ok].sum())]
        hit = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
        common = np.add.reduceat(hit, start, dtype=np.int64)
        ok = ok[100 * common >= PERCENT * (size[ok] + size[i] - common)]
        found += [(doc[i], doc[j], comp[i], comp[j]) if doc[i] > doc[j] else (doc[j], doc[i], comp[j], comp[i]) for j in ok]
    a, b, ca, cb = zip(*found) if found else ((),) * 4
    return pa.table({k: pa.array(v, pa.int64()) for k, v in (("a", a), ("b", b), ("ca", ca), ("cb", cb))})


def _divided(rows: DataFrame) -> DataFrame:
    """Rows (key, doc, size, comp) of the buckets whose members are in more than one component, with their sums."""
    ends = rows.groupBy(F.col("key").alias("k")).agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                                     F.count("*").alias("members"), F.sum("size").alias("shingles_in")).where("low <> high")
    return rows.join(ends, rows["key"] == ends["k"]).select("key", "doc", "size", "comp", "members", "shingles_in")


def _hub_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """Each document with the hubs it shares most buckets with, of those in another component.

    The hub of a bucket is its smallest member, in later turns one by another hash.
    """
    rank = F.col("doc") if turn == 0 else F.xxhash64(F.lit(turn), "key", "comp", "doc")
    hubs = rows.groupBy(F.col("key").alias("k")).agg(F.min_by(F.struct("doc", "comp"), rank).alias("hub"))
    pairs = rows.join(hubs, rows["key"] == hubs["k"]).where("comp <> hub.comp")
    pairs = pairs.groupBy("doc", "comp", "hub").agg(F.count("*").alias("n"))
    # a document lies in BANDS buckets at most, so it has at most as many hubs
    every = F.collect_list(F.struct("n", (-F.col("hub.doc")).alias("order"), "hub"))
    chosen = F.slice(F.sort_array(every, asc=False), 1, 1 if turn == 0 else HUBS)
    pairs = pairs.groupBy("doc", "comp").agg(chosen.alias("chosen"))
    pairs = pairs.select("doc", "comp", F.explode("chosen.hub").alias("hub"))
    return pairs.select(F.col("doc").alias("a"), F.col("hub.doc").alias("b"), F.col("comp").alias("ca"),
                        F.col("hub.comp").alias("cb"))


def _all_pairs(rows: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair of a bucket that lies in two components and could reach the threshold, block by block."""
    rows = rows if "members" in rows.columns else _divided(rows)
    low = sketches.select(F.col("doc_id").alias("d"), "bytes", "bands").distinct()
    short = F.transform("shingles", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    short = sets.where(F.size("shingles") > 0).select(F.col("doc").alias("e"), short.alias("short"))
    cut = rows.join(low, rows["doc"] == low["d"]).join(short, rows["doc"] == short["e"])
    blocks = F.greatest(F.lit(1), F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles_in") / BLOCK_SHINGLES)).cast("int")
    cut = cut.withColumn("blocks", blocks).withColumn("own", F.pmod(F.hash("doc"), F.col("blocks")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                     (F.col("own") > F.col("other")).cast("int").alias("side"), "doc", "comp", "bytes", "bands", "short")
    return cut.groupBy("key", "x", "y").applyInArrow(_block_pairs, "a long, b long, ca long, cb long").distinct()


def class_links(sketches: DataFrame, docs: DataFrame, width: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Confirmed links (a, b) between classes and the components they gave so far; ``sketches`` has one row a class."""
    bands = sketches.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("size"), F.explode("bands").alias("key"))
    bands = bands.withColumn("comp", F.col("doc"))
    buckets, state = saved_counted(_divided(bands).select("key", "doc", "size").distinct(), "dup-buckets")
    if not state["n"]:
        return None, None
    needed = buckets.select(F.col("doc").alias("needed")).distinct()
    sets = docs.where(F.col("doc_id").isNotNull()).join(needed, F.col("doc_id") == F.col("needed"), "left_semi")
    sets = sets.select("doc_id", "text").dropDuplicates()  # dealt by doc_id already
    sets = saved(sets.mapInArrow(lambda b: _sets(b, width), "doc long, shingles array<long>"), "dup-sets")

    links, comps = None, None
    rows = buckets.withColumn("comp", F.col("doc"))
    for turn in range(HUB_ROUNDS + 1):
        if comps is not None:
            own = buckets.join(comps, buckets["doc"] == comps["node"], "left").select(
                "key", "doc", "size", F.coalesce("component", "doc").alias("comp"))
            rows, state = saved_counted(_divided(own), "dup-divided")
            if not state["n"]:
                break
        pairs = _hub_pairs(rows, turn) if turn < HUB_ROUNDS else _all_pairs(rows, sketches, sets)
        found, state = saved_counted(confirm(pairs, sets), "dup-links")
        if state["n"]:
            links = found.select("a", "b") if links is None else links.unionByName(found.select("a", "b"))
        if turn < HUB_ROUNDS:
            comps = hooked(comps, found)
    return links, comps


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    docs = docs.select("doc_id", "text")
    sketches = saved(docs.mapInArrow(lambda b: _sketches(b, width), "doc_id long, n_shingles long, d1 long, d2 long, bytes binary, "
                                                "bands array<long>"), "dup-sketches")
    nodes = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = saved(nodes.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep")), "dup-classes")
    reps = classes.select(F.col("rep").alias("doc_id"), "n_shingles", "d1", "d2")
    chosen = nodes.join(reps, ["doc_id", "n_shingles", "d1", "d2"], "left_semi")
    links, comps = class_links(chosen, docs, width)
    own = ["n_shingles", "d1", "d2"]
    # rows that repeat a doc_id with other texts link the classes of these texts
    several = nodes.groupBy("doc_id").agg(F.min("d1").alias("low"), F.max("d1").alias("high")).where("low <> high")
    repeated = nodes.join(classes, own).join(several.select("doc_id"), "doc_id", "left_semi").where("doc_id <> rep")
    repeated = repeated.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    links = repeated if links is None else links.unionByName(repeated)
    if comps is None:
        comps = components(links)
    else:
        # what is left between the components so far
        one = comps.select(F.col("node").alias("x"), F.col("component").alias("xc"))
        two = comps.select(F.col("node").alias("y"), F.col("component").alias("yc"))
        left = links.join(one, F.col("a") == F.col("x"), "left").join(two, F.col("b") == F.col("y"), "left")
        top = components(left.select(F.coalesce("xc", "a").alias("a"), F.coalesce("yc", "b").alias("b")))
        top = top.select(F.col("node").alias("t"), F.col("component").alias("tc"))
        moved = comps.join(top, F.col("component") == F.col("t"), "left").select("node", F.coalesce("tc", "component").alias("component"))
        alone = top.join(comps, F.col("t") == F.col("node"), "left_anti").select(F.col("t").alias("node"), F.col("tc").alias("component"))
        comps = moved.unionByName(alone)
    rep = sketches.join(classes.withColumnRenamed("n_shingles", "m").withColumnRenamed("d1", "e1").withColumnRenamed("d2", "e2"),
                        (F.col("n_shingles") == F.col("m")) & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")), "left")
    out = rep.join(comps, rep["rep"] == comps["node"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def deduplicated(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row of each group: that with the smallest id.

    Rows whose id is null or stands in several rows are told apart by ids of
    their own beyond all others, so a row with an id of its own stays first.
    """
    key, gone, times = (free_name(docs.columns, n) for n in ("dup_key", "dup_gone", "dup_times"))
    several, state = saved_counted(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias(times))
                                   .where(F.col("doc_id").isNull() | (F.col(times) > 1))
                                   .select(F.col("doc_id").alias(gone)), "dup-several")
    keyed = docs.withColumn(key, F.col("doc_id").cast("long"))
    if state["n"]:
        own = F.col("doc_id").eqNullSafe(F.col(gone))
        last = docs.agg(F.max("doc_id")).first()[0] or 0
        apart = docs.join(several, own, "left_semi").withColumn(key, F.lit(last + 1) + F.monotonically_increasing_id())
        keyed = keyed.join(several, own, "left_anti").unionByName(saved(apart, "dup-apart"))
    verdict = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), width)
    verdict = verdict.where("not kept").select(F.col("doc_id").alias(gone))
    return keyed.join(saved(verdict, "dup-gone"), F.col(key) == F.col(gone), "left_anti").select(docs.columns)
