"""Quality by a regularised quadratic discriminant over transformed document statistics.

One pass turns each text into a vector of smoothed, transformed statistics (shares of symbols,
capitals, repeats and so on, logarithms of lengths). Counts, sums and outer products per class come
from all labelled rows of the training folds, as small partial sums per task. Each class covariance
is shrunk twice: towards the pooled one, then towards a multiple of the identity; the Cholesky
factors are computed once and sent along. A score is the logistic function of the tempered
difference of the class log-densities (Mahalanobis distance and log-determinant) plus the prior.

Scale. Texts are read once and never shuffled; the table of statistics is joined to the labels.
Nothing is sampled. The driver gets a few numbers per class.

Cases. Null texts count as empty and get a score like any text. Repeated or contradicting label rows
all count; null labels are left out. With labels of one class or none the score is the share of
label 1 (0.5 without labels). Repeated documents get equal scores. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.common import bucket_of, map_batches, staged, table
from macrotide.llm.quality_rules import Facts

POOL, IDENTITY, TEMPERATURE = 0.3, 0.005, 4.0
NAMES = (
    "length", "word_length", "symbols", "bars", "bangs", "capitals", "digits", "stops", "duplicate_lines",
    "repeats", "echoes", "variety", "line_length", "short_words")


def statistics(text: str | None) -> list[float]:
    t = Facts(text)
    n, chars = t.n_words, t.word_chars
    count = t.text.count

    def share(part: float, whole: float) -> float:
        """Square root of a share, smoothed so that short texts are not extreme."""
        return float(np.sqrt((part + 0.1) / (whole + 5.0)))

    return [
        float(np.log1p(n)), float(np.log((chars + 20.0) / (n + 4.0))), share(t.n_symbols - count("|"), n), share(count("|"), n),
        share(count("!"), n), share(t.n_upper, chars), share(sum(map(count, "0123456789")), chars),
        share(count(".") + count(","), n), share(t.n_dup_lines, len(t.lines)), share(t.n_repeat_words, n),
        share(sum(map(bytes.__eq__, t.words, t.words[1:])), n), float(np.log((len(set(t.words)) + 5.0) / (n + 5.0))),
        float(np.log((n + 5.0) / (len(t.lines) + 1.0))), share(sum(len(w) < 4 for w in t.words), n)]


def measured(documents: DataFrame) -> DataFrame:
    """(doc_id, stats) per document."""
    def work(batches):
        for batch in batches:
            yield {"doc_id": batch.column(0), "stats": [statistics(t) for t in batch.column(1).to_pylist()]}

    return map_batches(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        "doc_id bigint, stats array<double>", work)


class Discriminant:
    """Two Gaussian classes with shrunk covariances."""

    def __init__(self, counts, sums, outers, pool=POOL, identity=IDENTITY, temperature=TEMPERATURE) -> None:
        self.share = counts[1] / max(1, sum(counts)) if sum(counts) else 0.5
        self.ready = min(counts) > 1
        self.temperature = temperature
        if not self.ready:
            return
        means = [s / c for s, c in zip(sums, counts, strict=True)]
        own = [o / c - np.outer(m, m) for o, c, m in zip(outers, counts, means, strict=True)]
        total = sum(o * c for o, c in zip(own, counts, strict=True)) / sum(counts)
        scale = np.sqrt(np.maximum(np.diag(total), 1e-8))  # statistics in units of their spread
        self.scale, self.factors = scale, []
        pooled = total / np.outer(scale, scale)
        for mean, cov, c in zip(means, own, counts, strict=True):
            cov = (1 - pool) * cov / np.outer(scale, scale) + pool * pooled
            cov = (1 - identity) * cov + identity * np.trace(cov) / len(cov) * np.eye(len(cov))
            lower = np.linalg.cholesky(cov)
            self.factors.append((mean / scale, np.linalg.inv(lower), np.log(np.diag(lower)).sum(), np.log(c / sum(counts))))

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not self.ready:
            return np.full(len(stats), self.share)
        logs = []
        for mean, inverse, half_log_det, prior in self.factors:
            z = (stats / self.scale - mean) @ inverse.T
            logs.append(prior - half_log_det - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1 / (1 + np.exp(-np.clip((logs[1] - logs[0]) / self.temperature, -500, 500)))


def fit(labelled: DataFrame) -> Discriminant:
    """labelled: (stats, label), every row used."""
    d = len(NAMES)

    def work(batches):
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            x = np.array(batch.column(0).to_pylist(), np.float64).reshape(-1, d)
            for k in (0, 1):
                rows = x[y == k]
                sums[k] += np.concatenate([[len(rows)], rows.sum(0), (rows.T @ rows).ravel()])
        yield {"label": [0, 1], "sums": list(sums)}

    parts = map_batches(labelled.select("stats", F.col("label").cast("int").alias("label")), "label int, sums array<double>", work)
    flat = parts.select("label", F.posexplode("sums").alias("at", "v")).groupBy("label", "at").agg(F.sum("v").alias("v")).collect()
    sums = np.zeros((2, 1 + d + d * d))
    for r in flat:
        sums[r["label"], r["at"]] = r["v"]
    return Discriminant([int(s[0]) for s in sums], [s[1:1 + d] for s in sums], [s[1 + d:].reshape(d, d) for s in sums])


def scored(stats: DataFrame, model: Discriminant, cut: float) -> DataFrame:
    d = len(NAMES)

    def work(batches):
        for batch in batches:
            score = model.score(np.array(batch.column(1).to_pylist(), np.float64).reshape(-1, d))
            yield {"doc_id": batch.column(0), "score": score, "predicted": (score >= cut).astype(np.int32)}

    return map_batches(stats, "doc_id bigint, score double, predicted int", work)


def classify(documents: DataFrame, labels: DataFrame, label: str = "quality", fold=None, cut: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) per document, learned from the labelled rows that `fold` (a column
    of the labels) admits."""
    stats = staged(measured(documents))
    known = labels.where(F.col(label).isin(0, 1))
    known = known.where(fold) if fold is not None else known
    training = stats.join(known.select("doc_id", F.col(label).alias("label")), "doc_id")
    return scored(stats, fit(training), cut)


def op5_quality_classifier(spark, folder: str) -> DataFrame:
    found = classify(table(spark, folder, "documents"), table(spark, folder, "labels"), fold=bucket_of("doc_id", 4) != 2)
    return found.select("doc_id", F.coalesce(bucket_of("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")
