"""Operator 2: posteriors of hosts and paths."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetmill.llm import sites


def test_posteriors_equal_plain_loops(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice(["x", "y", None]), rng.random()) for i in range(200)] + [(900, "lone", "x", 0.9), (900, "lone2", "x", 0.2), (None, "b", "x", 0.4)]
    groups = {level: defaultdict(list) for level in (0, 1, 2)}
    for _, h, p, x in rows:
        for level, key in enumerate([(), (h,), (h, p)]):
            groups[level][key].append(x)

    def strength(level):
        own = groups[level]
        above = {k: groups[level - 1][k[:-1]] for k in own}
        n, k, parents = len(rows), len(own), len({key[:-1] for key in own})
        mean = lambda v: sum(v) / len(v)
        within = sum(sum((x - mean(v)) ** 2 for x in v) for v in own.values()) / (n - k)
        each = (n - sum(len(v) ** 2 / len(above[key]) for key, v in own.items())) / (k - parents)
        between = (sum(len(v) * (mean(v) - mean(above[key])) ** 2 for key, v in own.items()) / (k - parents) - within) / each
        return min(max(within / max(between, 1e-9), 1.0), 1e6)

    host_k, path_k, mean = strength(1), strength(2), sum(x for *_, x in rows) / len(rows)
    logit = lambda p: math.log(p / (1 - p))
    expected = []
    for i, h, p, x in rows:
        host = (sum(groups[1][h,]) - x + host_k * mean) / (len(groups[1][h,]) - 1 + host_k)
        path = (sum(groups[2][h, p]) - x + path_k * host) / (len(groups[2][h, p]) - 1 + path_k)
        expected.append((i or -1, x, host, path, 1 / (1 + math.exp(-(logit(x) + logit(path) - logit(mean))))))
    out = sites.posterior(spark.createDataFrame(rows, "doc_id long, host string, path string, p double")).collect()
    found = sorted((r.doc_id or -1, r.doc_score, r.host_mean, r.path_mean, r.score) for r in out)
    for a, b in zip(found, sorted((i or -1, *r) for i, *r in expected), strict=True):
        assert a == pytest.approx(b, abs=1e-9)


def test_hosts_and_paths_of_addresses(spark):
    urls = ["https://www.Example.org/en/8423?utm=x", "http://m.casino-win.example.com/en/4033.html", "https://a.example.com", "not an address", None, "http://h/a/b/c"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [tuple(r) for r in frame.select(*sites.of_url(F.col("url"))).collect()] == [("example.org", "en"), ("casino-win.example.com", "en"), ("a.example.com", None), (None, None), (None, None), ("h", "a")]
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    host, path = sites.of_url(F.col("url"))
    assert pages.select(host.alias("h"), path.alias("p")).filter("h IS NULL OR p IS NULL").count() == 0


def test_measures_of_a_text():
    texts = ["a b a\nline\nline\n", "", "#1 x22", "é\n\né"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    x, text, slot = sites.measure(sites.Polynomial(), data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    assert [round(v, 6) for v in x[0]] == [round(math.log1p(5), 6), round(math.log1p(11 / 5), 6), 0, 0, round(1 / 3, 6), 0.4, 1]
    assert x[1].tolist() == [0, 0, 0, 0, 0, 0, 1]
    assert x[2][2] == math.log1p(0.5) and x[2][3] == 3 / 6 and x[3][4] == 0.5
    assert np.bincount(text, minlength=4).tolist() == [3, 0, 2, 1] and slot.max() < sites.SLICES

GOOD, BAD = "plain words in a row that make an ordinary text of some length for the reader " * 3, "## $$ %% && ** ## $$ %% "


def test_sites_shrink_to_their_parents(spark):
    rows = [(i, GOOD if i % 2 else BAD, "a" if i < 60 else "b", f"p{i % 3}") for i in range(100)]
    rows += [(200 + i, GOOD, "good", "x") for i in range(40)] + [(300 + i, BAD, "bad", "x") for i in range(40)] + [(400, GOOD, "alone", "x"), (401, None, None, None), (402, "", "good", None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, host string, path string, n long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(5, None)], "doc_id long, quality int")
    found = sites.classify(docs, labels, F.col("host"), F.col("path"))
    out = {r.doc_id: r for r in found.collect()}
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in out.values())
    assert out[1].kept and not out[0].kept
    mean = sum(r.doc_score for r in out.values()) / len(out)
    assert out[300].host_mean < mean < out[200].host_mean
    assert abs(out[400].host_mean - mean) < 1e-9 and abs(out[400].path_mean - mean) < 1e-9  # alone: nothing but the prior
    assert out[200].score > out[1].score  # the same text on a better host
    none = sites.classify(docs, labels.limit(0), F.col("host"), F.col("path"))
    assert {round(r.doc_score, 6) for r in none.collect()} == {0.5}
    assert sites.classify(docs.limit(0), labels, F.col("host"), F.col("path")).count() == 0
