"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are grown in numpy on a bounded sample of labelled documents and kept as flat arrays
(a full binary tree of fixed depth each), which the scoring tasks walk for all rows of a batch
at once. Statistics use the whole text and nothing else.

Defined results: a null or empty text has all statistics zero and gets the score of those; labels
that are null or contradict each other are not learned from; repeated rows are scored alike; an
empty table gives no rows; other columns are ignored. Without a label of both kinds the score is
the share of label 1 (one half without any).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackmill.llm.common import fit_in_task, table

#: Bound on the labelled rows that one task fits on.
MOST_LABELLED = 20_000
THRESHOLD = 0.3

STATISTICS = [
    "log_chars", "log_words", "word_length", "longest_word", "upper", "digit", "white", "other",
    "exclaim", "pipe", "beyond_ascii", "distinct_words", "top_word", "log_lines", "line_words",
    "repeated_lines", "repeated_line_chars", "repeated_triples", "capital_words", "sentence_ends",
    "link_signs", "brackets",
]
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"[0-9]")


def statistics(text: str | None) -> list[float]:
    if not text:
        return [0.0] * len(STATISTICS)
    n = len(text)
    words = text.split()
    if not words:
        return [np.log1p(n), *[0.0] * (len(STATISTICS) - 1)]
    w = len(words)
    lengths = list(map(len, words))
    letters = sum(lengths)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    line_counts = Counter(lines)
    repeated = sum(c - 1 for c in line_counts.values())
    triples = len(set(zip(words, words[1:], words[2:])))
    alnum = sum(map(str.isalpha, words))
    return [
        np.log1p(n),
        np.log1p(w),
        letters / w,
        np.log1p(max(lengths)),
        len(_UPPER.findall(text)) / n,
        len(_DIGIT.findall(text)) / n,
        (n - letters) / n,
        1 - alnum / w,
        text.count("!") / w,
        text.count("|") / w,
        (len(text.encode("utf-8", "surrogatepass")) - n) / n,
        len(counts) / w,
        counts.most_common(1)[0][1] / w,
        np.log1p(len(lines)),
        w / len(lines),
        repeated / len(lines),
        sum(len(x) * (c - 1) for x, c in line_counts.items()) / n,
        1 - triples / (w - 2) if w > 2 else 0.0,
        sum(map(str.istitle, words)) / w,
        (text.count(". ") + text.count(".\n") + text.endswith(".")) / w,
        (text.count("@") + text.count("://")) / w,
        sum(map(text.count, "{}[]<>")) / n,
    ]


@dataclass
class Forest:
    """Trees as flat arrays: node k has children 2k + 1 and 2k + 2; ``leaf`` is by path."""

    depth: int
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; a row goes right where its value is larger
    leaf: np.ndarray  # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-total))


def grow(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
    bins: int = 64, ridge: float = 1.0, least: float = 5.0,
) -> Forest:
    """Boost ``trees`` trees on the logistic loss, splitting on histograms of binned values."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    forest = Forest(
        depth, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)), base
    )
    if len(np.unique(y)) < 2:
        return forest
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    n, k = x.shape
    flat = binned + np.arange(k) * bins
    logit = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        gradient, curve = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (k * bins) + flat).ravel()
            size = width * k * bins
            g = np.bincount(cell, np.repeat(gradient, k), size).reshape(width, k, bins).cumsum(2)
            h = np.bincount(cell, np.repeat(curve, k), size).reshape(width, k, bins).cumsum(2)
            g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge)
            gain -= g_all**2 / (h_all + ridge)
            gain[(h < least) | (h_all - h < least)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for i, b in enumerate(best):
                f, edge = divmod(int(b), bins)
                if gain[i, f, edge] > 1e-9 and edge < len(edges[f]):
                    feature[first + i], threshold[first + i] = f, edges[f][edge]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        place = node - inner
        leaf = rate * np.bincount(place, gradient, inner + 1)
        leaf /= np.bincount(place, curve, inner + 1) + ridge
        logit += leaf[place]
        features.append(feature), thresholds.append(threshold), leaves.append(leaf)
    return Forest(depth, np.array(features), np.array(thresholds), np.array(leaves), base)


def held_out(modulus: int, remainder: int) -> Column:
    """Whether a document's label may not be learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def learnable(labels: DataFrame, label: str, held: Column, most: int) -> DataFrame:
    """At most ``most`` labelled ids in an order that has nothing to do with their content."""
    return (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held)
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .filter("label = other")
        .select("doc_id", F.col("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield pd.DataFrame(
            {"label": rows["label"], "x": [np.array(statistics(t)) for t in rows["text"]]}
        )


def _learn(rows: pd.DataFrame) -> Forest:
    rows = rows.sort_values("label", kind="stable")
    x = np.stack(rows["x"]) if len(rows) else np.zeros((0, len(STATISTICS)))
    order = np.lexsort(x.T)  # the same trees whatever order the rows came in
    return grow(x[order], rows["label"].to_numpy(dtype=float)[order])


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Forest:
    """Learn ``quality`` from the labelled rows that are not held out."""
    sample = learnable(labels, "quality", held_out(5, 0), most)
    rows = (
        docs.select("doc_id", "text")
        .join(sample, "doc_id")
        .dropDuplicates(["doc_id"])
        .select("label", "text")
        .mapInPandas(_features, "label int, x array<double>")
    )
    return fit_in_task(rows, _learn)


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            x = np.array([statistics(t) for t in rows["text"]]).reshape(-1, len(STATISTICS))
            yield pd.DataFrame(
                {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": forest.score(x)}
            )

    return (
        docs.select("doc_id", "text", held_out(5, 0).alias("held_out"))
        .mapInPandas(scored, "doc_id long, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def keep_accepted(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose text scores ``threshold`` or more."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            x = np.array([statistics(t) for t in rows["text"].to_pylist()]).reshape(-1, len(STATISTICS))
            yield rows.filter(pa.array(forest.score(x) >= threshold))

    return docs.mapInArrow(kept, docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
