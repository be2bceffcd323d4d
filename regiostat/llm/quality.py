"""Operator 6: quality rules with robust multivariate outliers.

Plain counts of every whole text give base rules and a vector of transformed
statistics.  For each language and source, the minimum covariance determinant
is found by concentration steps: every step takes the h = (n + p + 1) / 2 of n
documents nearest by Mahalanobis distance and estimates mean and covariance
from them, so junk of up to nearly half a group does not enter.  Several
robust starts go on until their determinant stops falling, and the fit of the
least determinant is kept.  A step is one pass over all groups and starts that
sums moments per distance bin, so no group of documents meets in one task; of
the bin in which h ends, the moments count by the share that is taken.  A
document is rejected if its distance lies beyond the chi-square quantile of
1 - ``TAIL``.

Defined cases: a null text has no words and fails the base rules; null is a
language and a source of its own; groups under ``LEAST`` documents are pooled
by language, then altogether, and what is still smaller than ``LEAST`` keeps
all that pass the base rules; where a group varies by less than ``FLOORS`` it
gets that deviation, elsewhere its own; repeated rows are documents of their own; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lookup, saved

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
#: A start ends when a step lowers the logarithm of its determinant by less.
FALL = 1e-3
LEAST = 60
#: Share of regular documents beyond the cutoff if statistics were Gaussian.
TAIL = 1e-3
#: Least standard deviation of each transformed statistic.
FLOORS = (0.08, 0.04, 0.06, 0.06)
FEATURES = ("f_word_length", "f_symbols", "f_dup_lines", "f_repeats")
#: Statistics are held in integers of this unit, so that sums are exact.
UNIT = 4096
P = len(FEATURES)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def text_counts(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    w = raw.split()
    triples = list(zip(w, w[1:], w[2:]))
    repeats = 0
    if len(set(triples)) < len(triples):
        often = Counter(triples)
        reach = 0
        for i, t in enumerate(triples):
            if often[t] > 1:
                repeats += i + 3 - max(i, reach)
                reach = i + 3
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(w), len(text) - sum(text.count(c) for c in SPACES), sum(text.count(c) for c in SYMBOLS),
            len(lines) - len(set(lines)), repeats, len(lines))


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counts(texts: pa.Array) -> pa.Array:
    rows = [text_counts(t) for t in texts.to_pylist()]
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))],
                                      list(COUNTS))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, lang, source, the counts and ``base_failed`` of every document."""
    out = docs.select("doc_id", "lang", "source", _counts(F.col(text)).alias("c"))
    out = out.select("doc_id", "lang", "source", *[f"c.{c}" for c in COUNTS])
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _features() -> dict:
    """Transformed statistics in integer units, of documents with words.

    Shares are taken by the arcsine of their root, which evens out their
    variance; lengths by their logarithm.
    """
    n = F.greatest(F.col("n_words"), F.lit(1))

    def share(c, of):
        return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(c) / F.greatest(of, F.lit(1)))))

    value = {"f_word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
             "f_symbols": share("n_symbols", F.col("word_chars")),
             "f_dup_lines": share("n_dup_lines", F.col("n_lines")),
             "f_repeats": share("n_repeat_words", n)}
    return {k: F.round(v * UNIT).cast("long") for k, v in value.items()}


def chi2_cdf(x: float, dof: int) -> float:
    if dof <= 2:
        return math.erf(math.sqrt(x / 2)) if dof == 1 else 1 - math.exp(-x / 2)
    return chi2_cdf(x, dof - 2) - (x / 2) ** (dof / 2 - 1) * math.exp(-x / 2) / math.gamma(dof / 2)


def chi2_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < p else (low, mid)
    return low


@lru_cache(100_000)
def consistency(h: int, n: int) -> tuple[float, ...]:
    """Makes the covariance of the nearest ``h`` of ``n`` consistent for a Gaussian of 1, 2, .. P dimensions."""
    return tuple(h / n / chi2_cdf(chi2_quantile(h / n, k), k + 2) for k in range(1, P + 1))


VALUES = [f"m{i}" for i in range(P)] + [f"q{i}{j}" for i, j in PAIRS]
MODEL = "gid long, start int, before double, logdet double, " + ", ".join(f"{c} double" for c in VALUES)


def _model(pdf: pd.DataFrame, start, before, logdet, mean: np.ndarray, inverse: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"gid": pdf["gid"], "start": start, "before": before, "logdet": logdet}
                        | {f"m{i}": mean[:, i] for i in range(P)} | {f"q{i}{j}": inverse[:, i, j] for i, j in PAIRS})


def _symmetric(values) -> np.ndarray:
    """Matrices (a row a group) of the columns in the order of ``PAIRS``."""
    out = np.zeros((len(values[0]), P, P))
    for (i, j), v in zip(PAIRS, values):
        out[:, i, j] = out[:, j, i] = v
    return out


def _floored(cov: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Consistent covariance, and the logarithm of the determinant that fits of a group are compared by.

    In units of ``FLOORS``, the variance along each principal axis is raised to
    1 where it is below.  Only the other axes decide which documents are the
    nearest half, so the factor is that of their number.
    """
    unit = np.outer(FLOORS, FLOORS)
    w, v = np.linalg.eigh(cov / unit)
    vary = w[:, ::-1] * factors > 1  # from the widest axis on: whether so many axes vary
    count = np.where(vary.any(axis=1), P - vary[:, ::-1].argmax(axis=1), 1)
    own = np.take_along_axis(factors, count[:, None] - 1, 1)
    logdet = np.log(np.maximum(w * factors[:, -1:], 1.0)).sum(axis=1)
    return np.einsum("gij,gj,gkj->gik", v, np.maximum(w * own, 1.0), v) * unit, logdet


def _invert(frames):
    """Mean, inverse covariance and determinant of each fit from its moments (a row a group and start)."""
    for pdf in frames:
        h = pdf["h"].to_numpy(float)
        share = ((pdf["h"] - pdf["n_in"]) / pdf["n_edge"].clip(lower=1)).to_numpy(float)

        def moment(name):
            return (pdf[f"{name}_in"].to_numpy(float) + share * pdf[f"{name}_edge"].to_numpy(float)) / h

        mean = np.stack([moment(f"s{i}") for i in range(P)], 1) / UNIT
        cov = _symmetric([moment(f"s{i}{j}") / UNIT**2 - mean[:, i] * mean[:, j] for i, j in PAIRS])
        factors = np.array([consistency(int(a), int(b)) for a, b in zip(pdf["h"], pdf["all"])]).reshape(-1, P)
        cov, logdet = _floored(cov, factors)
        yield _model(pdf, pdf["start"], pdf["before"], logdet, mean, np.linalg.inv(cov))


def _distance():
    d = [F.col(f) / UNIT - F.col(f"m{i}") for i, f in enumerate(FEATURES)]
    return sum((d[i] * d[j] * F.col(f"q{i}{j}") * (1 if i == j else 2) for i, j in PAIRS), F.lit(0.0))


#: Quantiles from which starts are taken are this many to a half of the documents.
HALF = 16


def _plain_starts(frames):
    """Starts 0 and 1 of each group, without correlation: median and quartiles; middle and width of the shortest half."""
    for pdf in frames:
        grid = np.stack([np.stack(pdf[f]).astype(float) for f in FEATURES], 2) / UNIT  # group, quantile, feature
        low, middle, high = grid[:, HALF // 2], grid[:, HALF], grid[:, HALF + HALF // 2]
        at = (grid[:, HALF:] - grid[:, :HALF + 1]).argmin(axis=1)[:, None]
        left = np.take_along_axis(grid, at, 1)[:, 0]
        right = np.take_along_axis(grid, at + HALF, 1)[:, 0]
        for start, mean, width in ((0, middle, high - low), (1, (left + right) / 2, right - left)):
            var = np.maximum(width / 1.349, FLOORS) ** 2
            yield _model(pdf, start, np.inf, np.inf, mean, (1 / var)[:, :, None] * np.eye(P))


def _correlated_starts(frames):
    """Starts 2 and 3: start 1 with the correlations of squashed deviations, and of their directions."""
    for pdf in frames:
        mean = pdf[[f"m{i}" for i in range(P)]].to_numpy()
        width = 1 / np.sqrt(pdf[[f"q{i}{i}" for i in range(P)]].to_numpy())
        for start, kind in ((2, "t"), (3, "d")):
            c = _symmetric([pdf[f"{kind}{i}{j}"].to_numpy(float) for i, j in PAIRS])
            root = np.sqrt(np.maximum(np.einsum("gii->gi", c), 1.0))
            w, v = np.linalg.eigh(c / root[:, :, None] / root[:, None, :])
            cor = np.einsum("gij,gj,gkj->gik", v, np.maximum(w, 0.05), v)
            cov = cor * width[:, :, None] * width[:, None, :]
            yield _model(pdf, start, np.inf, np.inf, mean, np.linalg.inv(cov))


def _starts(stats: DataFrame) -> DataFrame:
    """Four robust starts of each group."""
    at = [k / (2 * HALF) for k in range(2 * HALF + 1)]
    q = stats.groupBy("gid").agg(*[F.percentile_approx(f, at, 1000).alias(f) for f in FEATURES])
    plain = saved(q.mapInPandas(_plain_starts, MODEL), "quality-starts")
    near = lookup(stats, saved(plain.where("start = 1").drop("start"), "quality-start"), {"gid": "gid"}, "inner")
    z = [(F.col(f) / UNIT - F.col(f"m{i}")) * F.sqrt(f"q{i}{i}") for i, f in enumerate(FEATURES)]
    near = near.select("gid", *VALUES, *[x.alias(f"z{i}") for i, x in enumerate(z)])
    length = F.greatest(reduce(lambda a, b: a + b, (F.col(f"z{i}") * F.col(f"z{i}") for i in range(P))), F.lit(1e-12))

    def total(x, name):  # in integers, so that sums are exact
        return F.sum(F.round(x * (1 << 20)).cast("long")).alias(name)

    sums = [total(F.tanh(f"z{i}") * F.tanh(f"z{j}"), f"t{i}{j}") for i, j in PAIRS]
    sums += [total(F.col(f"z{i}") * F.col(f"z{j}") / length, f"d{i}{j}") for i, j in PAIRS]
    near = near.groupBy("gid").agg(*[F.first(c).alias(c) for c in VALUES], *sums)
    return plain.unionByName(near.mapInPandas(_correlated_starts, MODEL))


def _step(stats: DataFrame, model: DataFrame) -> DataFrame:
    """One concentration step over all groups and starts; ``before`` is the determinant that a start had."""
    near = lookup(stats, model, {"gid": "gid"}, "inner")
    # 64 bins for each factor e of the distance; the model's own columns go before the sums
    near = near.withColumn("bin", F.floor(F.log(_distance() + 1e-6) * 64))
    names = [f"s{i}" for i in range(P)] + [f"s{i}{j}" for i, j in PAIRS]
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    sums += [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}{j}") for i, j in PAIRS]
    bins = near.groupBy("gid", "start", "bin").agg(F.count("*").alias("n"), F.first("logdet").alias("before"), *sums)
    fit = W.partitionBy("gid", "start")
    upto = fit.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumn("nearer", F.coalesce(F.sum("n").over(upto), F.lit(0))).withColumn("all", F.sum("n").over(fit))
    bins = bins.withColumn("h", F.least("all", F.floor((F.col("all") + P + 1) / 2)))
    inside = F.col("nearer") + F.col("n") <= F.col("h")
    bins = bins.where(F.col("nearer") < F.col("h"))
    moments = bins.groupBy("gid", "start").agg(
        *[F.first(c).alias(c) for c in ("before", "all", "h")],
        *[F.sum(F.when(inside, F.col(c)).otherwise(0)).alias(f"{c}_in") for c in ["n", *names]],
        *[F.sum(F.when(inside, 0).otherwise(F.col(c))).alias(f"{c}_edge") for c in ["n", *names]])
    return moments.mapInPandas(_invert, MODEL)


def fits(values: DataFrame) -> DataFrame:
    """Every fit that a concentration step gave, from all starts until no determinant falls any more."""
    model, trail = saved(_starts(values), "quality-model"), []
    while True:
        trail.append(saved(_step(values, model), "quality-model"))
        # floors bound the determinant from below, so this ends
        model = saved(trail[-1].where(F.col("logdet") < F.col("before") - FALL), "quality-falling")
        if model.isEmpty():
            return reduce(DataFrame.unionByName, trail)


def judge(stats: DataFrame, least: int = LEAST, tail: float = TAIL) -> DataFrame:
    """``stats`` (of :func:`statistics`) with ``distance`` (null: not judged) and ``kept``."""
    stats = saved(stats, "quality-stats")
    passing = stats.where(~F.col("base_failed"))
    by_pair = passing.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_pair = by_pair.withColumn("pooled", F.sum(F.when(F.col("n") < least, F.col("n")).otherwise(0)).over(
        W.partitionBy("lang")))  # a row for each pair: few
    own = F.xxhash64(F.lit(2), "lang", "source")
    groups = by_pair.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"),
                            F.when(F.col("n") >= least, own)
                            .when(F.col("pooled") >= least, F.xxhash64(F.lit(1), "lang"))
                            .otherwise(F.xxhash64(F.lit(0))).alias("gid"))
    passing = lookup(passing, saved(groups, "quality-groups"), {"lang": "g_lang", "source": "g_source"})
    values = saved(passing.select("gid", *[v.alias(k) for k, v in _features().items()]), "quality-features")
    best = fits(values).groupBy("gid").agg(F.min(F.struct("logdet", "start", *VALUES)).alias("fit"))
    sizes = values.groupBy("gid").agg(F.count("*").alias("group_size"))
    model = saved(best.select("gid", *[f"fit.{c}" for c in VALUES]).join(sizes, "gid"), "quality-model")

    out = lookup(stats, saved(groups, "quality-groups"), {"lang": "g_lang", "source": "g_source"})
    out = out.select("*", *[v.alias(k) for k, v in _features().items()])
    out = lookup(out, model, {"gid": "gid"})
    judged = ~F.col("base_failed") & (F.col("group_size") >= least)
    out = out.withColumn("distance", F.when(judged, _distance()))
    far = F.coalesce(F.col("distance") > chi2_quantile(1 - tail, P), F.lit(False))
    out = out.withColumn("kept", ~F.col("base_failed") & ~far)
    return out.select("doc_id", "lang", "source", *COUNTS, "base_failed", "distance", "kept")


def filter_quality(docs: DataFrame) -> DataFrame:
    """One verdict row per document; see :func:`judge`."""
    return judge(statistics(docs))
