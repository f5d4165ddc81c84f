"""Operator 2: a quality classifier by hierarchical empirical Bayes.

A logistic classifier over measures of a text gives each document a probability. One of its measures is the evidence of its
words: the mean of log-odds that each of 4096 slices of the word hashes is in a good text and not in a bad one, counted by
grouped aggregation on one half of the labelled sample while the curve over all measures is fitted on the other.

Documents of a path and paths of a host share a mean: a host's is shrunk to the mean of all documents, a path's to its
host's, each by as many pseudo-documents as the spread implies: the variance within the groups over the variance between
them, by the moments of a one-way analysis, among hosts for hosts and within hosts for paths. So sparse sites stay near
their priors. A document's posterior log-odds are its own plus the difference between its path's, without the document
itself, and the global ones.

The classifier sees at most ``rows_per_class`` labelled documents of each class, those with the smallest hash of doc_id;
sums are grouped aggregates over all documents, and no host's rows are collected. Each text is read once for its score.

Defined cases: null or empty text has no words; null host or path is a group of its own; a document alone on its path takes
the host's mean, alone on its host the global one; without labels of both classes every document has the share of good
labels (0.5 without any); repeated doc_ids are documents of their own with one label, null ones have none; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, Polynomial, checkpointed, chunks, table, word_bounds

ROWS_PER_CLASS = 4000
SLICES = 1 << 12
SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
DIGIT = np.isin(np.arange(256), list(b"0123456789"))
FEATURES = ("words", "bytes a word", "symbols a word", "digits a byte", "repeated lines", "repeated words", "few words", "evidence of words")


def of_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a web address: the host without www. and m., and the first part of the path; null if there is none."""
    host = F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^(www|m)\.", "")
    first = F.regexp_extract(F.try_parse_url(url, F.lit("PATH")), "^/([^/]*)/", 1)
    return host, F.nullif(first, F.lit(""))


def spread(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (a number a byte) over each text."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def different(text: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many different hashes each text has, and all of them as (text, hash)."""
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(text[new], minlength=n), text[new], hashes[new]


def measure(poly: Polynomial, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the measures but the evidence, a row a text; text and slice of each of its different words)."""
    n = len(offsets) - 1
    lower = LOWER[data]
    prefix = poly.prefix(lower)
    starts, ends, first = word_bounds(lower, offsets)
    words = np.diff(first)
    kinds, text, hashes = different(np.repeat(np.arange(n), words), poly.ranges(prefix, starts, ends) if len(starts) else np.empty(0, np.uint64), n)
    cut = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
    begin, end = cut[:-1], cut[1:]
    of = np.searchsorted(offsets, begin, side="right") - 1
    held = end - begin > 1
    lines, _, _ = different(of[held], poly.ranges(prefix, begin[held], end[held] - (data[end[held] - 1] == 10)), n)
    all_lines = np.bincount(of[held], minlength=n)
    at_least = np.maximum(words, 1)
    columns = (
        np.log1p(words),
        np.log1p(np.bincount(np.repeat(np.arange(n), words), weights=(ends - starts).astype(float), minlength=n) / at_least),
        np.log1p(spread(SYMBOL[data], offsets) / at_least),
        spread(DIGIT[data], offsets) / np.maximum(np.diff(offsets), 1),
        (all_lines - lines) / np.maximum(all_lines, 1),
        (words - kinds) / at_least,
        (words < 20).astype(float),
    )
    return np.stack(columns, axis=1), text, (hashes % np.uint64(SLICES)).astype(np.int64)


def slices(rows: DataFrame) -> DataFrame:
    """(label, slice, n): in how many of the rows (label, text) a word of the slice is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial()
        for batch in batches:
            for labels, data, offsets in chunks(batch.column(0), batch.column(1)):
                _, text, slot = measure(poly, data, offsets)
                key = np.unique(text * SLICES + slot)
                label = labels.to_numpy()[key // SLICES]
                key, n = np.unique(label * SLICES + key % SLICES, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key // SLICES), pa.array(key % SLICES), pa.array(n)], names=["label", "slice", "n"])

    return rows.mapInArrow(run, "label long, slice long, n long").groupBy("label", "slice").agg(F.sum("n").alias("n"))


def evidence(odds: np.ndarray, text: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, weights=odds[slot], minlength=n) / np.maximum(np.bincount(text, minlength=n), 1)


def fit(docs: DataFrame, labels: DataFrame, label_col: str, rows_per_class: int, ridge: float = 1.0, steps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """The slices' log-odds, and the weights of the measures and the intercept, on a bounded sample."""
    marked = labels.select(F.col("doc_id").cast("long"), F.col(label_col).cast("long").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    parts = [marked.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class) for c in (0, 1)]
    half = F.pmod(F.hash("doc_id"), F.lit(2)) == 0
    sample = checkpointed(docs.select("doc_id", "text").join(F.broadcast(parts[0].unionAll(parts[1])), "doc_id").select("label", "text", half.alias("half")))
    n = np.ones((2, SLICES))
    for r in slices(sample.filter("half").select("label", "text")).collect():  # at most two rows a slice
        n[r.label, r.slice] += r.n
    total = {(r.label, r.half): r.n for r in sample.groupBy("label", "half").agg(F.count("*").alias("n")).collect()}
    rates = [n[c] / (total.get((c, True), 0) + 2) for c in (0, 1)]
    odds = np.log(rates[1] / (1 - rates[1])) - np.log(rates[0] / (1 - rates[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial()
        for batch in batches:
            for labels, data, offsets in chunks(batch.column(0), batch.column(1)):
                x, text, slot = measure(poly, data, offsets)
                x = np.column_stack([x, evidence(odds, text, slot, len(x))])
                yield pa.RecordBatch.from_arrays([labels, pa.array(x.tolist(), pa.list_(pa.float64()))], names=["label", "x"])

    seen = sample.filter("NOT half").select("label", "text").mapInArrow(run, "label long, x array<double>").collect()
    y = np.array([float(r.label) for r in seen])
    if len(set(y)) < 2:
        good, bad = (sum(v for (label, _), v in total.items() if label == c) for c in (1, 0))
        share = (good + 1) / (good + bad + 2)
        return odds, np.array([0.0] * len(FEATURES) + [np.log(share / (1 - share)) if good + bad else 0.0])
    x = np.column_stack([np.array([r.x for r in seen]), np.ones(len(y))])
    mean, scale = x[:, :-1].mean(axis=0), x[:, :-1].std(axis=0) + 1e-9
    x[:, :-1] = (x[:, :-1] - mean) / scale
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
    return odds, np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def strength(groups: DataFrame) -> float:
    """Pseudo-documents of a level's prior, from (n, s, q, pn, ps): documents, sum and sum of squares of their
    probabilities, and the documents and sum of the group above.

    Variance within groups over variance between groups of one parent, both by their expected mean squares.
    """
    n, s, q, pn, ps = (F.col(c) for c in ("n", "s", "q", "pn", "ps"))
    r = groups.agg(
        F.sum(n).alias("n"), F.count("*").alias("k"), F.sum(n / pn).alias("parents"),
        F.sum(q - s * s / n).alias("within"), F.sum(n * (s / n - ps / pn) ** 2).alias("between"), F.sum(n * n / pn).alias("squares"),
    ).first()
    parents = r.parents or 0.0
    if not r.k or r.n <= r.k or r.k - parents < 0.5:
        return 10.0
    within = max(r.within / (r.n - r.k), 1e-9)
    each = (r.n - r.squares) / (r.k - parents)
    between = (r.between / (r.k - parents) - within) / max(each, 1e-9)
    return float(np.clip(within / max(between, 1e-9), 1.0, 1e6))


def posterior(scored: DataFrame) -> DataFrame:
    """(doc_id, host, path, doc_score, host_mean, path_mean, score, kept) of rows (doc_id, host, path, p)."""
    sums = (F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q"))
    paths = checkpointed(scored.groupBy("host", "path").agg(*sums))
    hosts = paths.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("n", "s", "q")))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    if not total.n:
        return scored.select("doc_id", "host", "path", F.col("p").alias("doc_score"), *(F.col("p").alias(c) for c in ("host_mean", "path_mean", "score")), (F.col("p") >= 0.5).alias("kept"))
    mean = total.s / total.n
    above = hosts.select(F.col("host").alias("hh"), F.col("n").alias("pn"), F.col("s").alias("ps"))
    host_k = strength(hosts.withColumns({"pn": F.lit(float(total.n)), "ps": F.lit(float(total.s))}))
    within = paths.join(above, F.col("host").eqNullSafe(F.col("hh")))
    path_k = strength(within)
    both = within.select(F.col("hh"), F.col("path").alias("pp"), F.col("pn").alias("hn"), F.col("ps").alias("hs"), F.col("n").alias("n"), F.col("s").alias("s"))
    out = scored.join(both, F.col("host").eqNullSafe(F.col("hh")) & F.col("path").eqNullSafe(F.col("pp")))
    host_mean = (F.col("hs") - F.col("p") + host_k * mean) / (F.col("hn") - 1 + host_k)
    path_mean = (F.col("s") - F.col("p") + path_k * host_mean) / (F.col("n") - 1 + path_k)
    score = 1 / (1 + F.exp(-(logit(F.col("p")) + logit(path_mean) - logit(F.lit(float(mean))))))
    out = out.select("doc_id", "host", "path", F.col("p").alias("doc_score"), host_mean.alias("host_mean"), path_mean.alias("path_mean"), score.alias("score"))
    return out.withColumn("kept", F.col("score") >= 0.5)


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, label_col: str = "quality", rows_per_class: int = ROWS_PER_CLASS, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, host, path, doc_score, host_mean, path_mean, score, kept) of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    odds, w = fit(rows, labels, label_col, rows_per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial()
        for batch in batches:
            at = 0
            for ids, data, offsets in chunks(batch.column(0), batch.column(3)):
                x, text, slot = measure(poly, data, offsets)
                z = np.column_stack([x, evidence(odds, text, slot, len(x))]) @ w[:-1] + w[-1]
                here = batch.slice(at, len(ids))
                at += len(ids)
                yield pa.RecordBatch.from_arrays([*here.columns[:3], pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=["doc_id", "host", "path", "p"])

    return posterior(checkpointed(rows.mapInArrow(run, "doc_id long, host string, path string, p double")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2_quality_classifier: every document, with its source as host and its language as path."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
