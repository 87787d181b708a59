"""Language identification by nearest centroid over TF-IDF vectors of character n-grams.

A whole text is lower-cased, everything but letters becomes one space, and its 1-, 2- and 3-grams are hashed
to ``DIM`` features. A vector is (1 + log count) * idf, scaled to length 1. Document frequencies
are counted over all training rows. Each language's training vectors, at most ``SAMPLE`` of them (those with
the smallest keyed hash of doc_id, so the choice does not depend on the data's layout), are clustered into up to
``CLUSTERS`` centroids by spherical k-means. A text gets the language of the centroid with the largest cosine, which
is its score; it is ``rejected`` if the cosine is below what ``REJECT`` of that centroid's own members have, less
``MARGIN``.

At most ``LANGUAGES`` languages are learned (those with most training rows), so the model that is
broadcast stays below LANGUAGES * CLUSTERS * DIM * 4 bytes (67 MB); four languages take 0.3 MB.

Defined cases: a null text, and one without a letter, is ``und`` with score 0 and not rejected; so is every text
if nothing was learned. Rows with a null doc_id or lang are predicted but not learned from. Repeated rows are
rows. Ties go to the first centroid in the order of language names. Extra columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm import common as C

DIM = 4096
SAMPLE = 500
CLUSTERS = 4
LANGUAGES = 1024
REJECT, MARGIN = 0.005, 0.05
AT_ONCE = 256              # documents whose vectors are held at once
STEPS = 12

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def counts(texts: list[bytes]) -> np.ndarray:
    """Texts x DIM counts of hashed n-grams; a row of zeros has no letter."""
    lowered = [t.decode("utf-8", "replace").lower() for t in texts]
    points = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), np.fromiter((len(t) + 1 for t in lowered), np.int64, len(texts)))
    is_letter = letters()[points]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]                        # the first other character after a letter stands for the gap
    c = np.where(is_letter[keep], points[keep], 32).astype(np.uint32)
    owner = owner[keep] * DIM
    out = np.zeros(len(texts) * DIM, np.int64)
    factor = np.uint32(0x9E3779B1)
    h = c * factor
    for n in range(1, 4):
        if n > 1:
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * factor + c[n - 1:]
            h = h * np.uint32(0x85EBCA6B)
            same = owner[:-n + 1] == owner[n - 1:]
        else:
            same = c != 32
        feature = (h ^ (h >> np.uint32(13))) * factor >> np.uint32(20)
        out += np.bincount(owner[:len(h)][same] + feature[same], minlength=len(out))
    return out.reshape(-1, DIM)


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.zeros(found.shape, np.float32)
    np.log(found, out=v, where=found > 0, casting="unsafe")
    v += found > 0
    v *= idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def clusters(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; the same rows give the same centroids."""
    mean = v.mean(axis=0)
    seeds = [int(np.argmax(v @ mean))]
    near = v @ v[seeds[0]]
    while len(seeds) < k:
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, v @ v[seeds[-1]])
    centre = v[seeds]
    for _ in range(STEPS):
        at = np.argmax(v @ centre.T, axis=1)
        sums = np.stack([v[at == j].sum(axis=0) if (at == j).any() else centre[j] for j in range(k)])
        centre = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)
    return centre


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    for lo, _, texts in C.chunks(batch):
        for k in range(0, len(texts), AT_ONCE):
            yield lo + k, texts[k:k + AT_ONCE]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(DIM, np.int64), 0
    for batch in batches:
        for _, texts in _slices(batch):
            total += (counts(texts) > 0).sum(axis=0)
            rows += len(texts)
    # feature DIM stands for the number of documents
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM + 1), pa.int32()), pa.array(np.append(total, rows))], names=["feature", "n"])


def fit(rows: DataFrame) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(idf, language of each centroid, centroids, least cosines) from (doc_id, lang, text)."""
    rows = rows.filter("lang is not null and doc_id is not null and text is not null")
    df = np.zeros(DIM + 1)
    for r in rows.select("text").mapInArrow(_document_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        df[r["feature"]] = r["n"]
    idf = (np.log((1 + df[DIM]) / (1 + df[:DIM])) + 1).astype(np.float32)

    turn = F.xxhash64(F.lit(7), "doc_id")
    names = F.broadcast(rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES))  # at most LANGUAGES rows
    # four times the sample by its share of the hash range, so that no task ranks more than that of a language
    share = (F.col("turn").cast("double") + 2.0 ** 63) / 2.0 ** 64
    near = rows.select("lang", turn.alias("turn")).join(names, "lang").filter(share * F.col("n") < 4 * SAMPLE)
    ranked = near.withColumn("at", F.row_number().over(W.partitionBy("lang").orderBy("turn")))
    last = ranked.filter(F.col("at") <= SAMPLE).groupBy("lang").agg(F.max("turn").alias("last"))
    chosen = rows.withColumn("turn", turn).join(F.broadcast(last), "lang").filter("turn <= last").select("lang", "turn", "text")

    def train(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["turn", "text"]).head(SAMPLE)
        v = np.concatenate([vectors(counts([t.encode("utf-8", "surrogatepass") for t in p["text"].iloc[i:i + AT_ONCE]]), idf)
                            for i in range(0, len(p), AT_ONCE)])
        v = v[v.any(axis=1)]
        if not len(v):
            return pd.DataFrame({"lang": pd.Series([], dtype=object), "k": pd.Series([], dtype="int32"),
                                 "centre": pd.Series([], dtype=object), "least": pd.Series([], dtype="float64")})
        centre = clusters(v, min(CLUSTERS, len(v)))
        near = v @ centre.T
        at = np.argmax(near, axis=1)
        least = [np.quantile(near[at == j, j], REJECT) if (at == j).any() else 0.0 for j in range(len(centre))]
        return pd.DataFrame({"lang": p["lang"].iloc[0], "k": range(len(centre)), "centre": [c.astype("<f4").tobytes() for c in centre], "least": least})

    model = sorted(chosen.groupBy("lang").applyInPandas(train, "lang string, k int, centre binary, least double").collect(), key=lambda r: (r["lang"], r["k"]))
    centres = np.stack([np.frombuffer(r["centre"], "<f4") for r in model]) if model else np.zeros((0, DIM), np.float32)
    return idf, [r["lang"] for r in model], centres, np.array([r["least"] for r in model])


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, names, centres, least = model.value
        names = np.array([*names, "und"], object)
        for batch in batches:
            for lo, texts in _slices(batch):
                v = vectors(counts(texts), idf)
                some = v.any(axis=1) & (len(centres) > 0)
                best, score, bad = np.full(len(texts), len(names) - 1), np.zeros(len(texts)), np.zeros(len(texts), bool)
                if some.any():
                    near = v[some] @ centres.T
                    best[some] = np.argmax(near, axis=1)
                    score[some] = np.clip(near.max(axis=1), 0, 1)
                    bad[some] = score[some] < least[best[some]] - MARGIN
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), batch.column(1).slice(lo, len(texts)), pa.array(names[best].tolist(), pa.string()),
                     pa.array(score), pa.array(bad)], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])
    return run


def identify(docs: DataFrame, held_out=None) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, rejected; learns from rows not held out.

    ``held_out`` is a Column over ``doc_id`` (default: crc32 of the id as text leaves 2 modulo 4).
    """
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2 if held_out is None else held_out
    C.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")).withColumn("held_out", F.coalesce(out, F.lit(False)))
    model = docs.sparkSession.sparkContext.broadcast(fit(rows.filter("not held_out")))
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        _predict(model), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
