"""Verdicts of the link graph do not depend on its size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandtide.llm.url_filter import propagate, shares, url_filter


def test_small_seeds_keep_their_verdict(spark):
    page = '<a href="http://bad.net/x">x</a>'
    rows = [(0, "http://bad.net/es/1", "")] + [(k, f"http://s{k}.org/1", page) for k in range(1, 501)]
    few = spark.createDataFrame(rows, "page_id long, url string, html string")
    many = spark.range(1_000_000).select((F.col("id") + 1000).alias("page_id"), F.lit("http://big.net/es/").alias("url"), F.lit("").alias("html"))
    got = {r.page_id: r.verdict for r in url_filter(few.unionByName(many)).filter("page_id < 1000").collect()}
    assert got == {k: "block" for k in range(501)}


def test_shares_equal_pagerank_that_returns_to_the_seeds(spark):
    rng, n = np.random.default_rng(3), 14
    links = np.zeros((n, n))
    for a, b in rng.integers(0, n, (30, 2)):
        links[a, b] = a != b
    links[[4, 9]] = 0  # hosts without outgoing links
    seed = np.zeros(n)
    seed[[1, 5]] = 0.25, 0.75
    x = seed.copy()
    for _ in range(500):
        out = links.sum(axis=1)
        x = 0.15 * seed + 0.85 * ((x / np.maximum(out, 1)) @ links + x[out == 0].sum() * seed)
    frame = spark.createDataFrame([(str(a), str(b)) for a, b in zip(*np.nonzero(links))], "src string, dst string")
    got = shares(propagate(frame, spark.createDataFrame([("1", 0.25), ("5", 0.75)], "host string, weight double"), 0.85, every=8))
    got = {int(r.host): r.score for r in got.collect()}
    assert got == {k: pytest.approx(v, abs=2e-6) for k, v in enumerate(x) if v > 0}
