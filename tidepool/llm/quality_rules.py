"""Quality rules with robust multivariate outliers (minimum covariance determinant).

Every whole text gets surface counts, a base rule (too short, or mostly repeated three-word windows), and a
vector of transformed ratios: log mean word length, and the square roots of symbols per character, of
repeated lines per line and of repeated words per word. For each language and source a minimum covariance
determinant estimate (mean and covariance of the most concentrated ``COVERAGE`` of the rows) is fitted to all
rows that pass the base rule, and rows whose squared Mahalanobis distance passes the chi-square quantile of
``TAIL`` are rejected.

The fit runs as Spark aggregations over a small table of vectors. It starts from medians and quartiles
(fixed-width histograms, so the start does not depend on task order); each concentration step puts the rows'
distances in logarithmic bins and sums counts and moments by (group, bin), partially before the shuffle, so a
group with a third of all rows is never in one task. Only groups' bins, at most ``BINS`` a group, meet in a
task, where the innermost bins that hold ``COVERAGE`` of the rows give the next mean and covariance.

Variances get a documented floor (``FLOOR``, squared, on the diagonal): ratios that are zero for most rows
would else have a singular estimate and any value above zero would be infinitely far. Every floor is small enough
that its ratio can cross the cutoff alone: in a group where a ratio is mostly zero, some 85 % of the lines being
repeats, 47 % of the words or 8 % of the characters being symbols reject a document that is otherwise ordinary.

Defined cases: a null or empty text has no words and fails the base rule. Repeated rows count and are judged
each. A null language or source is a value of its own. Groups with fewer than ``LEAST`` rows share the
estimate of the small groups of their language, then of all small groups; if those are still too few, the
base rule alone decides. An empty table gives no rows. Extra columns are ignored (the filter keeps them).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm import common as C
from tidepool.llm import text_stats as S

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
COVERAGE = 0.75
STEPS = 5
TAIL = 1e-6
LEAST = 100
#: Least standard deviation of each transformed ratio. The largest repeated shares that pass the base rule (v2 up to 1,
#: v3 up to 0.707) lie more than sqrt(CUTOFF) = 5.78 floors from zero, so each can reject by itself.
FLOOR = (0.03, 0.05, 0.16, 0.115)
DIM = len(FLOOR)
BINS, FINE = 1200, 16       # distance bins a group at most, bins per power of two
WIDTH = 0.002               # of the start's histograms
V = [f"v{i}" for i in range(DIM)]
PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]


def chi2_cdf(x: float, even: int) -> float:
    """Distribution function of chi-square with an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half ** k / math.factorial(k) for k in range(even // 2))


def chi2_quantile(p: float, even: int) -> float:
    lo, hi = 0.0, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, even) < p else (lo, mid)
    return hi


#: Makes the covariance of the inner rows right for normal data.
CONSISTENCY = COVERAGE / chi2_cdf(chi2_quantile(COVERAGE, DIM), DIM + 2)
CUTOFF = chi2_quantile(1 - TAIL, DIM)


def statistics(docs: DataFrame) -> DataFrame:
    """Counts, base rule and vector of every row: doc_id, mark (of the text), lang, source, counts, v0.."""
    C.small_batches(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.xxhash64(F.col("text").cast("string")).alias("mark"),
                        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    counted = named.mapInArrow(S.add_statistics, "doc_id long, mark long, lang string, source string, " + S.SCHEMA)
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return counted.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
        "v0": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "v1": F.sqrt(F.col("n_symbols") / F.greatest("word_chars", F.lit(1))),
        "v2": F.sqrt(F.col("n_dup_lines") / lines),
        "v3": F.sqrt(F.col("n_repeat_words") / words)})


def _fit_groups(rows: DataFrame) -> DataFrame:
    """(lang, source) -> the group whose estimate judges it; null where there are too few rows."""
    own = rows.filter("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.when(F.col("n") < LEAST, F.col("n")).otherwise(0)
    by_lang = F.sum(small).over(W.partitionBy("lang"))
    named = own.withColumn("in_lang", by_lang).withColumn("rest", F.col("in_lang") < LEAST)
    total = named.filter((F.col("n") < LEAST) & F.col("rest")).agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    key = F.to_json(F.struct("lang", "source"))
    return named.select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"),
        F.when(F.col("n") >= LEAST, F.concat(F.lit("own"), key))
        .when(~F.col("rest"), F.concat(F.lit("lang"), F.to_json(F.struct("lang"))))
        .when(total >= LEAST, F.lit("rest")).alias("fit"))


def _model(fit: str, mean: np.ndarray, cov: np.ndarray) -> dict:
    inv = np.linalg.inv(cov + np.diag(np.square(FLOOR)))
    return {"m_fit": fit, **{f"m{i}": float(mean[i]) for i in range(DIM)},
            **{f"p{i}{j}": float(inv[i, j]) * (1 if i == j else 2) for i, j in PAIRS}}


MODEL = "m_fit string, " + ", ".join([f"m{i} double" for i in range(DIM)] + [f"p{i}{j} double" for i, j in PAIRS])


def _start(rows: DataFrame) -> DataFrame:
    """First model of each group: medians, and scales from quartiles, read off histograms."""
    bins = (rows.select("fit", F.posexplode(F.array(*V)).alias("k", "v"))
            .groupBy("fit", "k", F.floor(F.col("v") / WIDTH).alias("bin")).agg(F.count("*").alias("n")))
    w = W.partitionBy("fit", "k")
    share = F.sum("n").over(w.orderBy("bin")) / F.sum("n").over(w)
    found = bins.withColumn("share", share).groupBy("fit", "k").agg(*[
        (F.min(F.when(F.col("share") >= q, F.col("bin"))) * WIDTH).alias(name)
        for q, name in ((0.25, "lo"), (0.5, "mid"), (0.75, "hi"))])

    def build(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield pd.DataFrame([_model(f, np.array(mid), np.diag(np.square(np.array(scale))))
                                for f, mid, scale in zip(p["fit"], p["mid"], p["scale"], strict=True)],
                               columns=[c.split()[0] for c in MODEL.split(", ")])

    scale = (F.col("hi") - F.col("lo")) / 1.349
    wide = found.groupBy("fit").agg(*[
        F.transform(F.array_sort(F.collect_list(F.struct("k", x.alias("x")))), lambda s: s["x"]).alias(name)
        for x, name in ((F.col("mid"), "mid"), (scale, "scale"))])
    return wide.mapInPandas(build, MODEL)


def distance(rows: DataFrame, models: DataFrame) -> DataFrame:
    """Adds ``distance2``, the squared Mahalanobis distance under the row's model (null without one)."""
    gap = [F.col(f"v{i}") - F.col(f"m{i}") for i in range(DIM)]
    d2 = sum((gap[i] * gap[j] * F.col(f"p{i}{j}") for i, j in PAIRS), F.lit(0.0))
    joined = rows.join(models, rows["fit"] == models["m_fit"], "left").withColumn("distance2", d2)
    return joined.drop(*models.columns)


def _concentrate(rows: DataFrame, models: DataFrame) -> DataFrame:
    """One concentration step: the next models."""
    level = F.floor(F.log2(F.col("distance2") + 1e-9) * FINE)
    at = F.least(F.greatest(level, F.lit(-BINS // 2)), F.lit(BINS // 2)).alias("bin")
    moments = [F.sum(v).alias(f"s{i}") for i, v in enumerate(V)] + [
        F.sum(F.col(V[i]) * F.col(V[j])).alias(f"q{i}{j}") for i, j in PAIRS]
    # settled, as Spark would else deal the partial sums by group alone
    bins = C.settle(distance(rows, models).groupBy("fit", at).agg(F.count("*").alias("n"), *moments))

    def update(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("bin")
        n = p["n"].cumsum()
        inner = p[(n - p["n"]) < COVERAGE * n.iloc[-1]]
        size = inner["n"].sum()
        mean = np.array([inner[f"s{i}"].sum() for i in range(DIM)]) / size
        cov = np.zeros((DIM, DIM))
        for i, j in PAIRS:
            cov[i, j] = cov[j, i] = inner[f"q{i}{j}"].sum() / size - mean[i] * mean[j]
        return pd.DataFrame([_model(p["fit"].iloc[0], mean, cov * CONSISTENCY)])

    return bins.groupBy("fit").applyInPandas(update, MODEL)


def judge(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, mark, counts, base_failed, distance2, kept."""
    raw = C.settle(statistics(docs))
    groups = _fit_groups(raw)
    rows = C.settle(raw.join(groups, raw["lang"].eqNullSafe(groups["g_lang"])
                             & raw["source"].eqNullSafe(groups["g_source"]), "left").drop("g_lang", "g_source"))
    fitted = rows.filter("not base_failed and fit is not null")
    models = C.settle(_start(fitted))
    for _ in range(STEPS):
        models = C.settle(_concentrate(fitted, models))
    judged = distance(rows, models)
    inside = F.coalesce(F.col("distance2") <= CUTOFF, F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & inside).select(
        "doc_id", "mark", *S.FIELDS[:-1], "base_failed", "distance2", "kept")


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; a row is known by its id and text."""
    out = judge(docs).filter("not kept").select(
        F.col("doc_id").alias("__gone_id"), F.col("mark").alias("__gone_mark")).distinct()
    text_mark = F.xxhash64(F.col("text").cast("string"))
    return docs.join(out, F.col("doc_id").cast("long").eqNullSafe(F.col("__gone_id"))
                     & (text_mark == F.col("__gone_mark")), "left_anti")
