"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is lower-cased, white space becomes one blank, and every n-gram of SIZES characters is hashed into BUCKETS
places. In how many toxic and other training texts a place occurs gives its log-count ratio. A place is a feature if its
ratio is at least LEAST_Z standard errors away from zero, however many there are. A logistic regression (Spark ML, sparse
vectors) is trained on presence times ratio, and the product of both is the weight of a place. A text's score is the
logistic of the sum of the weights of the places it has.

Null and empty texts have no n-gram and get the score of the intercept. Repeated rows get equal scores. With no
labelled rows of both kinds every score is the base rate (0.001 if there are none at all). Of documents that repeat a
labelled doc_id the one with the smallest text is learnt from. No text, row or feature is left out for a count or size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from recordweave.llm.common import labelled_sample, remainder, stage, table, trim, unused

#: Most labelled rows that the classifier is fitted on.
MAX_TRAIN = 20_000
FOLDS = 5
THRESHOLD = 0.5
SIZES = (3, 4, 5)
BUCKETS = 1 << 20
SLICES = 16
#: Standard errors between a place's log-count ratio and zero, and the regularisation: both chosen on an inner fold.
LEAST_Z = 3.0
REGULARISATION = 1e-3
CHUNK = 1 << 20
#: Rows of features that are made at a time.
AT_ONCE = 256
#: A sparse vector as Spark ML stores it.
VECTOR = "struct<type tinyint, size int, indices array<int>, values array<double>>"
_FACTORS = np.random.default_rng(20240302).integers(1, 1 << 63, max(SIZES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def places(text: str | None) -> Iterator[np.ndarray]:
    """Hash places of all n-grams of a text, with repeats, in pieces of bounded size."""
    if not text:
        return
    raw = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), "<u4")
    for start in range(0, len(raw), CHUNK):
        part = raw[start : start + CHUNK + max(SIZES) - 1].astype(np.uint64)
        key = part * _FACTORS[0]
        for n in range(2, max(SIZES) + 1):
            if len(part) < n:
                break
            key = key[: len(part) - n + 1] + part[n - 1 :] * _FACTORS[n - 1]
            if n in SIZES:
                h = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                yield (h >> np.uint64(44)).astype(np.int64)[:CHUNK]


def present(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Distinct places of a text; `seen` is an all-false buffer of BUCKETS, handed back all false."""
    found = []
    for p in places(text):
        p = p[~seen[p]]
        seen[p] = True
        found.append(np.unique(p))
    out = np.concatenate(found) if found else np.zeros(0, np.int64)
    seen[out] = False
    return out


def counts(rows: DataFrame) -> DataFrame:
    """(slice, toxic blob, other blob): in how many texts each place occurs, summed up over all tasks by slice."""
    width = BUCKETS // SLICES

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, sums = np.zeros(BUCKETS, bool), np.zeros((2, BUCKETS), np.int32)
        for b in batches:
            for text, label in zip(b.text, b.label):
                sums[label, present(text, seen)] += 1
        yield pd.DataFrame({"slice": range(SLICES), "other": [sums[0, i * width : (i + 1) * width].tobytes() for i in range(SLICES)], "toxic": [sums[1, i * width : (i + 1) * width].tobytes() for i in range(SLICES)]})
        del seen, sums
        trim()

    return rows.mapInPandas(local, "slice int, other binary, toxic binary")


def ratios(blobs: DataFrame, toxic: int, other: int, least_z: float = LEAST_Z) -> pd.DataFrame:
    """(place, ratio, texts) of the places whose log-count ratio is `least_z` standard errors or more from zero.

    There are at most BUCKETS of them, whatever the input.
    """
    width = BUCKETS // SLICES

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        neg, pos = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for b in parts:
            for n, p in zip(b.other, b.toxic):
                neg += np.frombuffer(n, np.int32)
                pos += np.frombuffer(p, np.int32)
        r = np.log((pos + 1) / (toxic + 2)) - np.log((neg + 1) / (other + 2))
        error = np.sqrt(1 / (pos + 1) - 1 / (toxic + 2) + 1 / (neg + 1) - 1 / (other + 2))
        ok = np.flatnonzero((neg + pos > 0) & (np.abs(r) >= least_z * error))
        yield pd.DataFrame({"place": ok + int(key[0]) * width, "ratio": r[ok], "texts": (neg + pos)[ok]})

    return blobs.groupBy("slice").applyInPandas(add, "place long, ratio double, texts long").toPandas().sort_values("place")


class Weights:
    def __init__(self, intercept: float, place: np.ndarray, weight: np.ndarray):
        self.intercept, self.place, self.weight = intercept, place, weight

    def scorer(self):
        dense, known = np.zeros(BUCKETS), np.zeros(BUCKETS, bool)
        dense[self.place], known[self.place] = self.weight, True

        def one(text: str | None) -> float:
            hits = [p[known[p]] for p in places(text)]
            at = np.unique(np.concatenate(hits)) if hits else []
            return 1 / (1 + np.exp(-(self.intercept + dense[at].sum() if len(at) else self.intercept)))

        return one


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MAX_TRAIN, least_z: float = LEAST_Z, regularisation: float = REGULARISATION) -> Weights:
    """Fit on at most `most` labelled documents outside the held-out fold."""
    sample = F.broadcast(labelled_sample(labels, label, FOLDS, most))
    rows = docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = stage(rows.repartition(8), "toxic-sample")
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, other = n.get(1, 0), n.get(0, 0)
    if not toxic or not other:
        rate = np.clip(toxic / (toxic + other), 1e-3, 1 - 1e-3) if toxic + other else 1e-3
        return Weights(float(np.log(rate / (1 - rate))), np.zeros(0, int), np.zeros(0))
    top = ratios(counts(rows), toxic, other, least_z)
    place, ratio = top.place.to_numpy(), top.ratio.to_numpy()
    if not len(place):
        return Weights(float(np.log(toxic / other)), np.zeros(0, int), np.zeros(0))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slot, seen = np.full(BUCKETS, -1, np.int32), np.zeros(BUCKETS, bool)
        slot[place] = np.arange(len(place))
        for b in batches:
            for i in range(0, len(b), AT_ONCE):
                part, x = b[i : i + AT_ONCE], []
                for text in part.text:
                    s = slot[present(text, seen)]
                    s = np.sort(s[s >= 0])
                    x.append({"type": 0, "size": len(place), "indices": s, "values": ratio[s]})
                yield pd.DataFrame({"label": part.label.astype(float).to_numpy(), "features": pd.Series(x)})
        trim()

    vectors = StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())])
    data = stage(rows.mapInPandas(features, f"label double, features {VECTOR}"), "toxic-features", vectors)
    model = LogisticRegression(maxIter=30, regParam=regularisation, standardization=False).fit(data)
    return Weights(float(model.intercept), place, model.coefficients.toArray() * ratio)


def score(docs: DataFrame, model: Weights, name: str = "score") -> DataFrame:
    """docs with the score of each whole text as one more column."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = model.scorer()
        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype=float)
        del one
        trim()

    return docs.withColumn(name, scored("text"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that are scored toxic; all columns stay."""
    (name,) = unused(docs, "toxicity")
    return score(docs, train(docs, labels), name).filter(F.col(name) < THRESHOLD).drop(name)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder("doc_id", FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
