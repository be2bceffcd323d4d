"""Operator 5: language-model scores by a subword lattice.

The vocabulary is that of an existing tokenizer file; its scores order the
pieces and give the first weights.  One round of expected counts over all
segmentations of the training words turns them into unigram probabilities.  A
word's probability is the sum over all its segmentations, by a forward
recursion in log space; a document's is the product over its words and one
end.  Characters without a piece are spelled by byte pieces.

Beside it stands an add-one word model.  Frequent training words (those with
at least a ``HEAD``-th of all tokens, so at most ``HEAD``) are looked up where
the texts are read; the other words of a document are joined with the table of
all words, which holds each word's count and lattice score once and grows with
the corpus.

Defined cases: a null text is empty and has the end as its only token; rows
are told apart by their place in the scan, so repeated rows are scored one by
one; a null doc_id counts as training (its crc32 is null); an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .near_dup import mixed

#: Path of the piece vocabulary (a parameter; the file is read on the driver).
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
HEAD = 1 << 20
START = "▁"
#: Words that a task counts before it hands them on.
CACHE = 300_000
#: Pseudo-count of every piece.
PRIOR = 0.1
_G = np.uint64(0x9E3779B97F4A7C15)


class Lattice:
    """Unigram pieces with natural log probabilities."""

    def __init__(self, pieces: list[str], byte_at: list[int], logs: np.ndarray, end: float):
        self.pieces, self.byte_at, self.end = pieces, byte_at, end
        self.logs = logs.tolist()
        spelled = set(byte_at)
        self.place = {p: i for i, p in enumerate(pieces) if i not in spelled}
        self.longest = max(map(len, pieces), default=1)

    @classmethod
    def load(cls, path: str = VOCABULARY) -> Lattice:
        """Pieces of a tokenizer file; weights fall with the rank its scores give."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i))]
        byte_at = sorted((int(model.id_to_piece(i)[3:5], 16), k) for k, i in enumerate(ids) if model.is_byte(i))
        score = np.array([model.get_score(i) if not model.is_byte(i) else -1e6 for i in ids])
        weight = 1 / (2 + np.argsort(np.argsort(-score, kind="stable")))
        return cls([model.id_to_piece(i) for i in ids], [k for _, k in byte_at], np.log(weight / weight.sum()), math.log(1e-3))

    def edges(self, s: str):
        """For each end position the (start, piece or None, log probability) that reach it."""
        place, logs, longest = self.place, self.logs, self.longest
        for j in range(1, len(s) + 1):
            found = []
            for i in range(max(0, j - longest), j):
                k = place.get(s[i:j])
                if k is not None:
                    found.append((i, k, logs[k]))
            if s[j - 1] not in place:
                spelled = sum(logs[self.byte_at[b]] for b in s[j - 1].encode("utf-8", "surrogatepass"))
                found.append((j - 1, None, spelled))
            yield found

    def forward(self, s: str) -> list[float]:
        """Log of the summed probability of all segmentations of each prefix."""
        at = [0.0]
        for found in self.edges(s):
            terms = [at[i] + w for i, _, w in found]
            most = max(terms)
            at.append(most + math.log(sum([math.exp(t - most) for t in terms])) if len(terms) > 1 else most)
        return at

    def word(self, w: bytes) -> float:
        """Natural log probability of a word."""
        return self.forward(START + w.decode("utf-8", "surrogatepass"))[-1]

    def expected(self, w: bytes, n: int, into: np.ndarray) -> None:
        """Add n times the expected count of each piece over the word's segmentations."""
        s = START + w.decode("utf-8", "surrogatepass")
        edges, at = list(self.edges(s)), self.forward(s)
        # posterior of a position, backwards: its own times each edge's share of its forward sum
        mass = [0.0] * len(s) + [float(n)]
        for j in range(len(s), 0, -1):
            for i, k, x in edges[j - 1]:
                p = mass[j] * math.exp(at[i] + x - at[j])
                mass[i] += p
                for piece in [k] if k is not None else [self.byte_at[b] for b in s[j - 1].encode("utf-8", "surrogatepass")]:
                    into[piece] += p


class Grid:
    """The recursions of a :class:`Lattice` for many words at once, in columns of words of equal length."""

    #: Longer words take the plain recursion.
    LONGEST = 48

    def __init__(self, lattice: Lattice):
        self.lattice, self.logs = lattice, np.array(lattice.logs)
        pieces = [p for p in lattice.place if len(p) <= self.LONGEST]
        keys = np.array([self._key(p) for p in pieces], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([lattice.place[p] for p in pieces])[order]
        self.full = np.zeros(1 << 20, bool)
        self.full[keys >> np.uint64(44)] = True

    @staticmethod
    def _key(piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = mixed((h + np.uint64(ord(c) + 1)) * _G)
        return int(h[0])

    def _cells(self, codes: np.ndarray) -> dict:
        """By (start, length): which words have a piece there, and which piece."""
        n, size = codes.shape
        out, h = {}, np.zeros((n, size), np.uint64)
        for k in range(1, min(self.lattice.longest, size) + 1):
            h = mixed((h[:, :size - k + 1] + codes[:, k - 1:] + np.uint64(1)) * _G)
            rows, starts = np.nonzero(self.full[h >> np.uint64(44)])
            if not len(rows):
                continue
            key = h[rows, starts]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            true = self.keys[at] == key
            rows, starts, ids = rows[true], starts[true], self.ids[at[true]]
            order = np.argsort(starts, kind="stable")
            rows, ids = rows[order], ids[order]
            ends = np.searchsorted(starts[order], np.arange(size + 1))
            for i in range(size):
                if ends[i] < ends[i + 1]:
                    out[i, k] = rows[ends[i]:ends[i + 1]], ids[ends[i]:ends[i + 1]]
        return out

    def _columns(self, words: list[bytes]):
        """Words by length: their places, cells and forward sums; then the places of the rest."""
        texts = [START + w.decode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(t) for t in texts])
        rest = np.flatnonzero(sizes > self.LONGEST).tolist()
        for size in np.unique(sizes[sizes <= self.LONGEST]):
            places = np.flatnonzero(sizes == size)
            codes = np.frombuffer("".join([texts[i] for i in places]).encode("utf-32-le", "surrogatepass"), np.uint32)
            cells = self._cells(codes.reshape(len(places), size).astype(np.uint64))
            at = np.full((size + 1, len(places)), -np.inf)
            at[0] = 0
            for j in range(1, size + 1):
                for k in range(1, min(self.lattice.longest, j) + 1):
                    if (j - k, k) in cells:
                        rows, ids = cells[j - k, k]
                        at[j, rows] = np.logaddexp(at[j, rows], at[j - k, rows] + self.logs[ids])
            # a character without a piece is left to the plain recursion
            whole = np.isfinite(at).all(axis=0)
            single = np.zeros(len(places), int)
            for i in range(size):
                if (i, 1) in cells:
                    single[cells[i, 1][0]] += 1
            whole &= single == size
            rest += places[~whole].tolist()
            yield places, whole, cells, at
        yield np.array(rest, int), None, None, None

    def words(self, words: list[bytes]) -> np.ndarray:
        """Natural log probability of each word."""
        out = np.zeros(len(words))
        for places, whole, _, at in self._columns(words):
            if whole is None:
                out[places] = [self.lattice.word(words[i]) for i in places]
            else:
                out[places[whole]] = at[-1, whole]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray, into: np.ndarray) -> None:
        """Add the expected counts of the pieces over all segmentations of the words."""
        for places, whole, cells, at in self._columns(words):
            if whole is None:
                for i in places:
                    self.lattice.expected(words[i], int(counts[i]), into)
                continue
            size = len(at) - 1
            mass = np.zeros(at.shape)
            mass[size, whole] = counts[places[whole]]
            for j in range(size, 0, -1):
                for k in range(1, min(self.lattice.longest, j) + 1):
                    if (j - k, k) in cells:
                        rows, ids = cells[j - k, k]
                        on = mass[j, rows] > 0
                        rows, ids = rows[on], ids[on]
                        p = mass[j, rows] * np.exp(at[j - k, rows] + self.logs[ids] - at[j, rows])
                        mass[j - k, rows] += p
                        into += np.bincount(ids, weights=p, minlength=len(into))


def _many(batches, size: int = 50_000):
    """Batches put together to at least ``size`` rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= size:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _word_counts(batches):
    """Words of all texts with their counts in training texts, summed before the shuffle."""
    counts: Counter = Counter()

    def part():
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
                                          ["word", "n"])

    for batch in batches:
        for text, held_out in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = text.encode("utf-8", "surrogatepass").lower().split() if text else ()  # bytes.lower is A-Z only
            if held_out:
                for w in set(found):
                    counts.setdefault(w, 0)
            else:
                counts.update(found)
            if len(counts) > CACHE:
                yield part()
                counts.clear()
    if counts:
        yield part()


def is_held_out(doc_id, modulus: int = 7, rest: int = 2):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == rest, F.lit(False))


def train(docs: DataFrame, vocabulary: str = VOCABULARY) -> tuple[DataFrame, int, int, int, Lattice]:
    """Words of all texts (word, c, lw): count in the training texts and log probability by the lattice.

    Also the number of training texts, of their tokens and of their distinct tokens, and the lattice.
    """
    spark = docs.sparkSession
    counted = docs.select("text", "held_out").mapInArrow(_word_counts, "word binary, n long")
    counts = saved(counted.groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
    texts = docs.where(~F.col("held_out")).count()
    total = counts.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    first = Lattice.load(vocabulary)
    before = spark.sparkContext.broadcast(first)  # the size of the vocabulary

    def expect(batches):
        grid = Grid(before.value)
        into = np.zeros(len(before.value.pieces))
        for part in _many(batches):
            grid.expected(part["word"].to_pylist(), part["c"].to_numpy(), into)
        k = np.flatnonzero(into)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(into[k], pa.float64())], ["piece", "n"])

    taught = counts.where("c > 0").select("word", "c")
    pieces = taught.mapInArrow(expect, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    n = np.full(len(first.pieces), PRIOR)
    for r in pieces.collect():  # at most the vocabulary
        n[r["piece"]] += r["n"]
    every = n.sum() + texts + PRIOR
    lattice = Lattice(first.pieces, first.byte_at, np.log(n / every), math.log((texts + PRIOR) / every))
    after = spark.sparkContext.broadcast(lattice)

    def weigh(batches):
        grid = Grid(after.value)
        for part in _many(batches):
            lw = pa.array(grid.words(part["word"].to_pylist()), pa.float64())
            yield from part.append_column("lw", lw).to_batches()

    words = saved(counts.select("word", "c").mapInArrow(weigh, "word binary, c long, lw double"), "lm-words")
    return words, texts, (total["n"] or 0) + texts, total["v"] + (1 if texts else 0), lattice


_SPLIT = ("row_id long, doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, "
          "rare array<binary>, times array<int>")


def _splitter(shared):
    """Sums over the frequent words of each text, and its other words."""
    def split(batches):
        head = shared.value
        names = [c.split()[0] for c in _SPLIT.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = [[] for _ in range(6)]
                for text in part.column(3).to_pylist():
                    found = Counter(text.encode("utf-8", "surrogatepass").lower().split()) if text else {}
                    known, logs, score, rare, times, size = 0, 0.0, 0.0, [], [], 1
                    for w, n in found.items():
                        size += n
                        x = head.get(w)
                        if x is None:
                            rare.append(w)
                            times.append(n)
                        else:
                            known += n
                            logs += n * x[0]
                            score += n * x[1]
                    for column, value in zip(out, (size, known, logs, score, rare, times)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1).cast(pa.int64()), part.column(2),
                     pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()),
                     pa.array(out[3], pa.float64()), pa.array(out[4], pa.list_(pa.binary())),
                     pa.array(out[5], pa.list_(pa.int32()))], names)

    return split


def score_documents(docs: DataFrame, held_out=None, vocabulary: str = VOCABULARY, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    ``held_out``: condition of the documents that do not teach.
    """
    spark = docs.sparkSession
    held = is_held_out(F.col("doc_id")) if held_out is None else held_out
    docs = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", held.alias("held_out"), "text")
    words, ends, tokens, distinct, lattice = train(docs, vocabulary)
    least = max(1, -(-tokens // head))
    frequent = words.where(F.col("c") >= least).toArrow()  # at most ``head`` words
    known = {w: (math.log10(c + 1), lw) for w, c, lw in zip(*(x.to_pylist() for x in frequent.columns))}
    shared = spark.sparkContext.broadcast(known)

    parts = saved(docs.mapInArrow(_splitter(shared), _SPLIT), "lm-parts")
    rare = parts.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row_id", F.col("r.rare").alias("rare"), F.col("r.times").alias("times"))
    rare = rare.join(words.where(F.col("c") < least), F.col("rare") == F.col("word"))  # holds every word of the table
    rare = rare.groupBy(F.col("row_id").alias("row")).agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("rare_logs"),
        F.sum(F.col("times") * F.col("lw")).alias("rare_score"))
    out = parts.drop("rare", "times").join(rare, F.col("row_id") == F.col("row"), "left")
    end = math.log10(ends + 1)
    over = math.log10(tokens + distinct + 1)
    base = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + F.lit(end) - F.col("n_tokens") * F.lit(over)
    seen = F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(1 if ends else 0)
    return out.select("doc_id", "held_out", "n_tokens", seen.cast("long").alias("n_known"),
                      F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
                      ((F.col("score") + F.coalesce("rare_score", F.lit(0.0)) + lattice.end) / math.log(10)).alias("score"))
