"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Spark computes the statistics of every whole text in Arrow batches. The trees are fitted on a bounded sample of
labelled rows (MAX_TRAIN), then flattened into three arrays, and every batch is scored by walking those arrays with
numpy. Labels, lang, source and doc_id are no inputs of a score.

Null and empty texts have all-zero statistics and are scored like any other; repeated rows get equal scores; with no
labelled rows of both kinds every score is the base rate (0.5 if there are none at all).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm.common import labelled_sample, remainder, table, trim, unused

#: Most labelled rows that the trees are fitted on.
MAX_TRAIN = 20_000
FOLDS = 5
THRESHOLD = 0.3

NAMES = (
    "log_bytes", "upper", "digit", "space", "newline", "comma", "period", "exclaim", "pipe", "other_mark", "non_ascii",
    "log_words", "distinct_words", "repeated_neighbours", "top_word", "word_bytes", "longest_word", "one_byte_words",
    "log_lines", "distinct_lines", "words_per_line", "ended_lines", "marked_words", "pipe_words",
)
_MARKS = np.zeros(256, bool)
_MARKS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one whole text, in the order of NAMES."""
    out = np.zeros(len(NAMES))
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = count / n
    words = raw.split()
    k = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    out[:11] = (
        np.log1p(n), share[65:91].sum(), share[48:58].sum(), share[32], share[10], share[44], share[46], share[33], share[124],
        share[_MARKS].sum() - share[44] - share[46] - share[33] - share[124], share[128:].sum(),
    )
    if k:
        freq = Counter(words)
        same = sum(map(bytes.__eq__, words, words[1:]))
        out[11:18] = (np.log1p(k), len(freq) / k, same / k, max(freq.values()) / k, sum(map(len, words)) / k, np.log1p(max(map(len, freq))), sum(c for w, c in freq.items() if len(w) == 1) / k)
        out[22:24] = sum(c for w, c in freq.items() if w.endswith(b"!!")) / k, freq.get(b"|", 0) / k
    if lines:
        out[18:22] = np.log1p(len(lines)), len(set(lines)) / len(lines), np.log1p(k / len(lines)), sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / len(lines)
    return out


def matrix(texts: pd.Series) -> np.ndarray:
    return np.stack([statistics(t) for t in texts]) if len(texts) else np.zeros((0, len(NAMES)))


class Trees:
    """Complete binary trees of one depth, as arrays: feature and threshold by (tree, node), value by (tree, leaf)."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.threshold, self.value = base, feature, threshold, value

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(np.log2(self.value.shape[1])) if self.value.size else 0
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - len(f)]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, bins: int = 64, rate: float = 0.15, l2: float = 1.0, least: int = 10) -> Trees:
    """Boosted trees with a logistic loss; splits are searched on per-node histograms of gradients over binned values."""
    mean = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    base = np.log(mean / (1 - mean))
    if len(np.unique(y)) < 2:
        return Trees(base, np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 2)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)  # code > b  <=>  x > cuts[b]
    inner, leaves = 2**depth - 1, 2**depth
    out_f, out_t, out_v, total = [], [], [], np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        f, t, node = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = node - first
            best = np.zeros(width)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                key = at * (len(c) + 1) + code[:, j]
                hist = [np.bincount(key, w, width * (len(c) + 1)).reshape(width, -1) for w in (g, h, np.ones_like(g))]
                gl, hl, nl = (np.cumsum(a, 1)[:, :-1] for a in hist)
                ga, ha, na = (a.sum(1, keepdims=True) for a in hist)
                gain = gl**2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga**2 / (ha + l2)
                gain[(nl < least) | (na - nl < least)] = 0
                b = gain.argmax(1)
                better = gain[np.arange(width), b] > best + 1e-12
                best[better] = gain[np.arange(width), b][better]
                f[first : first + width][better], t[first : first + width][better] = j, c[b[better]]
            node = 2 * node + 1 + (x[np.arange(len(x)), f[node]] > t[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        total = total + value[leaf]
        out_f.append(f), out_t.append(t), out_v.append(value)
    return Trees(base, np.array(out_f), np.array(out_t), np.array(out_v))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_TRAIN) -> Trees:
    """Fit on at most `most` labelled documents outside the held-out fold. Only their statistics reach the driver.

    Of documents that repeat a labelled doc_id the one with the smallest statistics is learnt from.
    """
    sample = F.broadcast(labelled_sample(labels, label, FOLDS, most))
    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "label", "text")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id, "label": b.label, "x": list(matrix(b.text))})
        trim()

    got = rows.mapInPandas(features, "doc_id long, label int, x array<double>").groupBy("doc_id").agg(F.min(F.struct("x", "label")).alias("r")).select("doc_id", "r.*").limit(most).toPandas().sort_values("doc_id")
    return fit_trees(np.stack(got.x) if len(got) else np.zeros((0, len(NAMES))), got.label.to_numpy(float))


def score(docs: DataFrame, model: Trees, name: str = "score") -> DataFrame:
    """docs with the score of each whole text as one more column."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(matrix(texts)))

    return docs.withColumn(name, scored("text"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that are scored bad; all columns stay."""
    (name,) = unused(docs, "quality")
    return score(docs, train(docs, labels), name).filter(F.col(name) >= THRESHOLD).drop(name)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder("doc_id", FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
