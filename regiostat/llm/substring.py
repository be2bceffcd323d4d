"""Operator 9: substring dedup by prefix-partitioned suffix trees.

Every word position with at least ``WINDOW`` words from there to the end of
its document is a suffix.  Suffixes are split into groups by prefixes of two,
four, eight or all ``WINDOW`` words: the shortest prefix that is not frequent
over the whole corpus, so that no group outgrows ``GROUP`` suffixes by a
common phrase.  One task sorts the suffixes of a group, which lays out its
subtree: leaves under one node of depth ``WINDOW`` stand side by side.  The
leaves of such a node in other documents than its smallest are repeats, and
overlapping repeats merge into maximal ones.

Before the shuffle, each chunk of documents builds the same nodes among its
own suffixes, so that a passage of very many documents leaves a chunk once.
A suffix travels as a 56-bit fingerprint of its first ``WINDOW`` words beside
its group, with its document and position delta-coded.

Defined cases: a null text has no words; a document of fewer words than a
window loses none; equal doc_ids are not smaller than each other; a row with
null doc_id loses nothing and takes nothing from others; rows that repeat a
doc_id are told apart by their texts; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved, words
from .near_dup import mixed, word_hashes

WINDOW = 13
PREFIXES = (2, 4, 8)
#: Suffixes of a group, about; also the largest count of a prefix that is not extended.
GROUP = 700_000
#: Suffixes of a chunk, whose repeats are resolved before the shuffle.
CHUNK = 700_000
_G = np.uint64(0x9E3779B97F4A7C15)


def rolled(h: np.ndarray, window: int = WINDOW) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the prefixes and of the whole window at each start of a word-hash sequence."""
    n = len(h) - window + 1
    f, prefixes = np.zeros(n, np.uint64), []
    for j in range(window):
        f = f * _G + h[j:j + n]
        if j + 1 in PREFIXES:
            prefixes.append(mixed(f + np.uint64(j)))
    return prefixes, mixed(f)


class Chunk:
    """Documents whose suffixes are taken together."""

    def __init__(self):
        self.docs, self.size = [], 0

    def add(self, doc_id: int, tag: int, text: str) -> None:
        w = words(text)
        if len(w) >= WINDOW:
            self.docs.append((doc_id, tag, word_hashes(w)))
            self.size += len(w) - WINDOW + 1

    def suffixes(self):
        """doc_id, tag, position, prefix hashes and window hash of all suffixes, documents ascending."""
        docs = sorted(self.docs, key=lambda d: d[:2])
        ids = np.array([d[0] for d in docs], np.int64)
        tags = np.array([d[1] for d in docs], np.int64)
        lengths = np.array([len(d[2]) for d in docs])
        prefixes, f = rolled(np.concatenate([d[2] for d in docs]))
        starts = np.cumsum(lengths) - lengths
        own = np.repeat(np.arange(len(docs)), lengths)
        position = np.arange(int(lengths.sum())) - np.repeat(starts, lengths)
        inside = np.flatnonzero(position <= np.repeat(lengths, lengths) - WINDOW)
        own, position = own[inside], position[inside]
        return ids[own], tags[own], position, [p[inside] for p in prefixes], f[inside]


def _chunks(batches):
    chunk = Chunk()
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            for doc_id, tag, text in zip(*(c.to_pylist() for c in part.columns[:3])):
                chunk.add(doc_id, tag, text)
                if chunk.size >= CHUNK:
                    yield chunk
                    chunk = Chunk()
    if chunk.size:
        yield chunk


def _counter(share: float):
    """Counts of the prefixes with at least ``share`` of a chunk's suffixes, and the suffixes (level -1)."""
    def count(batches):
        for chunk in _chunks(batches):
            *_, prefixes, f = chunk.suffixes()
            level, key, n = [-1], [0], [len(f)]
            for k, p in enumerate(prefixes):
                least = max(2, int(share * len(f)))
                rough = p >> np.uint64(44)
                p = p[np.bincount(rough.astype(np.int64), minlength=1 << 20)[rough] >= least]
                u, c = np.unique(p, return_counts=True)
                often = c >= least
                level += [k] * int(often.sum())
                key += u[often].view(np.int64).tolist()
                n += c[often].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), pa.array(key, pa.int64()),
                                              pa.array(n, pa.int64())], ["level", "key", "n"])

    return count


def spans_of(ids, tags, position):
    """doc_id, tag, start and end of the covered words, windows merged; input in order of all three."""
    if not len(ids):
        return (np.empty(0, np.int64),) * 4
    new = np.r_[True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]) | (position[1:] > position[:-1] + WINDOW)]
    s = np.flatnonzero(new)
    e = np.r_[s[1:], len(ids)] - 1
    return ids[s], tags[s], position[s], position[e] + WINDOW


def squeezed(*columns: np.ndarray) -> bytes:
    """Integer columns as deltas in byte planes, compressed."""
    rest = np.stack([np.diff(x, prepend=0) for x in columns]).astype(np.int64)
    planes = rest.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unsqueezed(k: int, n: int, data: bytes) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * k * n, codec="zstd", asbytes=True), np.uint8).reshape(k, 8, n)
    return np.cumsum(np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64).reshape(k, n), axis=1)


def _packed(f, ids, tags, position) -> bytes:
    """Fingerprints in byte planes, then the rest."""
    low = f.view(np.uint8).reshape(-1, 8)[:, :7].T
    return np.ascontiguousarray(low).tobytes() + squeezed(ids, tags, position)


def _unpacked(n: int, data: bytes):
    f = np.zeros((n, 8), np.uint8)
    f[:, :7] = np.frombuffer(data, np.uint8, 7 * n).reshape(7, n).T
    return f.view(np.uint64).ravel(), *unsqueezed(3, n, data[7 * n:])


def _later(f, ids):
    """Which suffixes share their node with one of a smaller document."""
    order = np.argsort(f, kind="stable")
    s = f[order]
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    least = np.minimum.reduceat(ids[order], first)
    out = np.empty(len(f), bool)
    out[order] = ids[order] > np.repeat(least, np.diff(np.r_[first, len(f)]))
    return out


def _splitter(groups: int, frequent: list[np.ndarray]):
    def split(batches):
        for chunk in _chunks(batches):
            ids, tags, position, prefixes, f = chunk.suffixes()
            key, open_ = prefixes[0].copy(), np.ones(len(f), bool)
            for k, deeper in enumerate([*prefixes[1:], f]):
                if not len(frequent[k]):
                    break
                at = np.minimum(np.searchsorted(frequent[k], key), len(frequent[k]) - 1)
                open_ &= frequent[k][at] == key
                key[open_] = deeper[open_]
            group = (mixed(key) % np.uint64(groups)).astype(np.int64)
            later = _later(f, ids)
            g, n, kind, data = [], [], [], []
            # what the chunk has settled itself goes along, to any group
            done = spans_of(ids[later], tags[later], position[later])
            if len(done[0]):
                g.append(int(done[0][0] % groups))
                n.append(len(done[0]))
                kind.append(1)
                data.append(squeezed(*done))
            order = np.flatnonzero(~later)
            order = order[np.argsort(group[order], kind="stable")]
            ends = np.searchsorted(group[order], np.arange(groups + 1))
            for i in np.flatnonzero(np.diff(ends)):
                own = order[ends[i]:ends[i + 1]]
                g.append(int(i))
                n.append(len(own))
                kind.append(0)
                data.append(_packed(f[own], ids[own], tags[own], position[own]))
            out = pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(n, pa.int32()), pa.array(kind, pa.int32()),
                                              pa.array(data, pa.binary())], ["grp", "n", "kind", "data"])
            for at in range(0, out.num_rows, 64):
                yield out.slice(at, 64)

    return split


def _subtree(buckets: int):
    def build(rows: pa.Table) -> pa.Table:
        """The repeats of one group of suffixes, packed for each bucket of documents."""
        leaves, found = [], []
        for n, kind, data in zip(*(rows[c].to_pylist() for c in ("n", "kind", "data"))):
            if kind:
                found.append(unsqueezed(4, n, data))
            else:
                leaves.append(_unpacked(n, data))
        if leaves:
            f, ids, tags, position = (np.concatenate(x) for x in zip(*leaves))
            del leaves
            later = np.flatnonzero(_later(f, ids))
            later = later[np.lexsort((position[later], tags[later], ids[later]))]
            found.append(spans_of(ids[later], tags[later], position[later]))
        spans = [np.concatenate(x) for x in zip(*found)]
        bucket = (mixed(spans[0].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((spans[2], spans[1], spans[0], bucket))
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(ends))
        parts = [order[ends[i]:ends[i + 1]] for i in full]
        return pa.table({"bucket": pa.array(full, pa.int32()), "n": pa.array([len(p) for p in parts], pa.int32()),
                         "data": pa.array([squeezed(*(x[p] for x in spans)) for p in parts], pa.binary())})

    return build


def _by_document(rows: pa.Table) -> pa.Table:
    """The merged spans of each document of a bucket."""
    parts = [unsqueezed(4, n, data) for n, data in zip(rows["n"].to_pylist(), rows["data"].to_pylist())]
    ids, tags, start, end = np.concatenate(parts, axis=1)
    order = np.lexsort((start, tags, ids))
    ids, tags, pairs = ids[order], tags[order], np.stack([start, end], 1)[order]
    first = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])])
    spans = [merged(pairs[a:b]).astype(np.int32).tobytes() for a, b in zip(first, np.r_[first[1:], len(ids)])]
    return pa.table({"doc": pa.array(ids[first]), "own": pa.array(tags[first]), "spans": pa.array(spans, pa.binary())})


def merged(pairs: np.ndarray) -> np.ndarray:
    """Disjoint ascending spans of spans in order of their starts."""
    reach = np.maximum.accumulate(pairs[:, 1])
    first = np.flatnonzero(np.r_[True, pairs[1:, 0] > reach[:-1]])
    return np.stack([pairs[first, 0], reach[np.r_[first[1:], len(pairs)] - 1]], 1)


@F.arrow_udf(T.BinaryType())
def _packed_text(texts: pa.Array) -> pa.Array:
    out = []
    for t in texts.to_pylist():
        raw = b"" if t is None else t.encode()
        out.append(len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")
    return pa.array(out, pa.binary())


def _text(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True) if data else b""


_SPAN = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())


@F.arrow_udf(T.StructType().add("n_words", T.LongType()).add("n_removed", T.LongType())
             .add("kept_sha256", T.StringType()).add("spans", T.ArrayType(_SPAN)))
def _verdict(texts: pa.Array, blobs: pa.Array) -> pa.Array:
    rows = []
    for data, packed in zip(texts.to_pylist(), blobs.to_pylist()):
        w = _text(data).split()
        spans = np.frombuffer(packed or b"", np.int32).reshape(-1, 2)
        kept, at = [], 0
        for s, e in spans.tolist():
            kept += w[at:s]
            at = e
        kept += w[at:]
        rows.append({"n_words": len(w), "n_removed": len(w) - len(kept),
                     "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(),
                     "spans": [{"start": s, "end": e} for s, e in spans.tolist()]})
    return pa.array(rows, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                                     ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))


def repeat_spans(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc, own (its tag) and packed spans of repeated words, a row for each document that has some; ``docs`` has doc_id, tag, text."""
    spark = docs.sparkSession
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    # At least half of a prefix's count beyond GROUP is reported: a chunk leaves out less
    # than half of its share.  Words have two bytes or more with their space.
    share = group / 2 / max(total / 2, 1)
    counted = saved(rows.mapInArrow(_counter(share), "level int, key long, n long").groupBy("level", "key").agg(
        F.sum("n").alias("n")), "prefixes")
    suffixes = (counted.where("level = -1").agg(F.sum("n")).first() or [0])[0] or 0
    # at most 2 * suffixes / GROUP of each level
    often = counted.where((F.col("level") >= 0) & (F.col("n") > group // 2)).select("level", "key").collect()
    frequent = [np.sort(np.array([r["key"] for r in often if r["level"] == k], np.int64).view(np.uint64))
                for k in range(len(PREFIXES))]
    groups = max(1, -(-suffixes // group))
    shared = spark.sparkContext.broadcast(frequent)

    def split(batches):
        return _splitter(groups, shared.value)(batches)

    parts = rows.mapInArrow(split, "grp int, n int, kind int, data binary")
    found = parts.groupBy("grp").applyInArrow(_subtree(groups), "bucket int, n int, data binary")
    return found.groupBy("bucket").applyInArrow(_by_document, "doc long, own long, spans binary")


def tagged(docs: DataFrame) -> DataFrame:
    """doc_id, tag, text: the tag tells texts of a repeated doc_id apart, and is 0 if no doc_id repeats."""
    repeated = docs.groupBy("doc_id").count().where("doc_id IS NOT NULL AND count > 1").limit(1).count()
    tag = F.coalesce(F.xxhash64("text"), F.lit(0)) if repeated else F.lit(0).cast("long")
    return docs.select("doc_id", tag.alias("tag"), "text")


def dedup_substrings(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the removed word spans of every document."""
    docs = tagged(docs)
    found = repeat_spans(docs, group)
    texts = docs.select("doc_id", "tag", _packed_text("text").alias("packed"))
    out = texts.join(found, (F.col("doc_id") == F.col("doc")) & (F.col("tag") == F.col("own")), "left")
    return out.select("doc_id", _verdict("packed", "spans").alias("v")).select(
        "doc_id", "v.n_words", "v.n_removed", "v.kept_sha256", "v.spans")
