"""Operator 10: language identification, words first, then character n-grams.

A known word scores by its log frequency in each language.  A word that the
model does not know backs off to its longest character n-grams that the model
knows, from five characters down to one; their mean log frequency stands for
the word.

The classifier is fitted on a sample of at most ``fit_docs`` labelled
documents (in expectation; the same share of ``fit_docs`` for each language),
chosen by a hash of the id, and keeps the ``max_words`` and ``max_grams``
most frequent entries.  Training and prediction read every whole text, and
every n-gram of a run of letters however long it is (text without blanks is
one run); memory is bounded by going through a run in slices.

Defined cases: a null text, a text without letters, or a model without any
language gives ``und`` with score 0; a null label teaches nothing; repeated
rows are predicted one by one; extra columns stay as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, saved

UNKNOWN = "und"
FIT_DOCS = 4000
MAX_WORDS = 60_000
MAX_GRAMS = 60_000
LONGEST = 5
#: Entries of a task's memory of unseen words, and the longest word it holds.
CACHE = 50_000
CACHE_LETTERS = 200
#: N-grams of a run that are held at once.
SLICE = 10_000
#: Words, letters of long words, and n-grams that a training task counts before it hands them on.
COUNTED_WORDS, COUNTED_LETTERS, COUNTED_GRAMS = 300_000, 2_000_000, 1_000_000
#: Words that count as independent when the score is turned into a probability.
EVIDENCE = 10
#: A language must be at least this probable for a document to be accepted.
LEAST_SCORE = 0.5
_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> list[str]:
    """Lower-cased runs of letters; empty if there is no letter."""
    found = _WORD.findall(text.lower()) if text else []
    if not any(c.isalpha() for w in found for c in w):  # stops at the first letter
        return []
    return found


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between its two boundary marks."""
    return [g for part in gram_slices(word, n) for g in part]


def gram_slices(word: str, n: int):
    """The same in lists of at most ``SLICE``."""
    s = f"_{word}_"
    end = len(s) - n + 1
    for at in range(0, end, SLICE):
        yield [s[i:i + n] for i in range(at, min(at + SLICE, end))]


@dataclass
class Model:
    langs: list[str]
    rows: dict[str, int]  # words as "word", n-grams as "\tgram"
    logs: np.ndarray  # row, language

    def vector(self, word: str) -> np.ndarray | None:
        """Log frequencies of a word, by backoff if the word is unknown."""
        at = self.rows.get(word)
        if at is not None:
            return self.logs[at]
        for n in range(LONGEST, 0, -1):
            total, times = np.zeros(len(self.langs)), 0
            for part in gram_slices(word, n):
                known = [i for g in part if (i := self.rows.get("\t" + g)) is not None]
                if known:
                    total += self.logs[known].sum(axis=0)
                    times += len(known)
            if times:
                return total / times
        return None

    def predict(self, text: str | None, cache: dict) -> tuple[str, float]:
        found = letters(text)
        if not found or not self.langs:
            return UNKNOWN, 0.0
        total, at, times, seen = np.zeros(len(self.langs)), [], [], 0
        for word, n in Counter(found).items():
            i = self.rows.get(word)
            if i is not None:
                at.append(i)
                times.append(n)
                continue
            if len(word) > CACHE_LETTERS:
                v = self.vector(word)
            else:
                if word not in cache:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[word] = self.vector(word)
                v = cache[word]
            if v is not None:
                total += v * n
                seen += n
        if at:
            t = np.array(times, float)
            total += t @ self.logs[at]
            seen += int(t.sum())
        mean = total / max(seen, 1) * min(max(seen, 1), EVIDENCE)
        p = np.exp(mean - mean.max())
        best = int(p.argmax())  # ties: the first language in code point order
        return self.langs[best], float(p[best] / p.sum())


def _count_grams(batches):
    """(lang, kind, gram, n) of a part of the sample, summed before the shuffle."""
    counts: Counter = Counter()
    long = 0
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word, n in Counter(letters(text)).items():
                counts[lang, word] += n
                if len(word) > CACHE_LETTERS:
                    long += len(word)
            if len(counts) > COUNTED_WORDS or long > COUNTED_LETTERS:
                yield from _gram_batches(counts)
                counts.clear()
                long = 0
    yield from _gram_batches(counts)


def _gram_batches(counts: Counter):
    out: Counter = Counter()
    for (lang, word), n in counts.items():
        out[lang, 0, word] += n
        for k in range(1, LONGEST + 1):
            for part in gram_slices(word, k):
                for g in part:
                    out[lang, k, "\t" + g] += n
                if len(out) > COUNTED_GRAMS:
                    yield _gram_batch(out)
                    out.clear()
    if out:
        yield _gram_batch(out)


def _gram_batch(out: Counter) -> pa.RecordBatch:
    lang, kind, gram = zip(*out)
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(kind, pa.int32()), pa.array(gram, pa.string()),
         pa.array(out.values(), pa.int64())], ["lang", "kind", "gram", "n"])


def fit(docs: DataFrame, training: Column | None = None, fit_docs: int = FIT_DOCS,
        max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """Fit on labelled documents; ``training`` says which rows may teach."""
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = (rows if training is None else rows.where(training)).select("doc_id", "text", "lang")
    per = saved(rows.groupBy(F.col("lang").alias("of")).count(), "lang-sizes")
    share = F.lit(float(fit_docs) / max(per.count(), 1)) / F.col("count")
    point = F.pmod(F.xxhash64(F.lit(10), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = lookup(rows, per, {"lang": "of"}, "inner").where(point < share)
    counted = sample.select("text", "lang").mapInArrow(_count_grams, "lang string, kind int, gram string, n long")
    counted = counted.groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n"))
    by_gram = counted.groupBy("kind", "gram").agg(F.sum("n").alias("total"),
                                                  F.collect_list(F.struct("lang", "n")).alias("by"))

    def top(which: Column, k: int) -> pa.Table:  # bounded: k rows of one entry for each language
        # as Arrow, which takes a tenth of what rows of Python objects would
        return by_gram.where(which).orderBy(F.desc("total"), "gram").limit(k).select("kind", "gram", "by").toArrow()

    kept = pa.concat_tables([top(F.col("kind") == 0, max_words), top(F.col("kind") > 0, max_grams)]).combine_chunks()
    by = kept["by"].combine_chunks()
    entry = np.repeat(np.arange(len(kept)), np.diff(by.offsets.to_numpy()))
    lang = by.flatten().field("lang").dictionary_encode()
    names = lang.dictionary.to_pylist()
    langs = sorted(names)
    place = np.array([langs.index(x) for x in names], int)
    counts = np.zeros((len(kept), len(langs)))
    if len(entry):
        counts[entry, place[lang.indices.to_numpy()]] = by.flatten().field("n").to_numpy()
    kinds = kept["kind"].to_numpy()
    logs = np.zeros_like(counts)
    for kind in set(kinds.tolist()):
        own = kinds == kind
        logs[own] = np.log((counts[own] + 0.5) / (counts[own].sum(axis=0) + 0.5 * own.sum()))
    return Model(langs, {g: i for i, g in enumerate(kept["gram"].to_pylist())}, logs)


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with the struct column ``out``: lang, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most max_words + max_grams rows
    cache: dict = {}  # of a task: it outlives the batches

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        known = shared.value
        found = [known.predict(t, cache) for at in range(0, len(texts), 256) for t in texts.slice(at, 256).to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
            ["lang", "score"])

    return docs.withColumn(out, predict(F.col(text)))


def accepted(language: Column, least: float = LEAST_SCORE) -> Column:
    return (language["lang"] != UNKNOWN) & (language["score"] >= least)
