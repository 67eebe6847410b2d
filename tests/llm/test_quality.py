"""The quality classifier: its risk against plain sums, held-out accuracy, and awkward rows."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandtide.llm import quality as q

DOCS = "doc_id long, text string, lang string, id long, x string, positive int"
held = lambda key: F.crc32(key.cast("string")) % 4 == 2


def made(n=400, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(20, 200))]
        rows.append((k, " ".join(words) + "." if good else " ".join(w.upper() + rng.choice(["!!", "$$$"]) for w in words)))
        if k % 3 == 0:
            labels.append((k, int(good)))
    return rows, labels


def frames(spark, rows, labels, parts=3):
    docs = spark.createDataFrame([(k, t, "de", 7, "x", 1) for k, t in rows], DOCS).repartition(parts)
    return docs, spark.createDataFrame(labels or [(None, None)], "doc_id long, quality int")


def test_separates_what_it_never_saw_labelled(spark):
    rows, labels = made()
    extra = [(1000, None), (1001, ""), (1002, " \n"), (None, "some words"), (1004, "é" * 3_000_000), (0, rows[0][1]), (0, rows[0][1])]
    truth = {k: t.endswith(".") for k, t in rows}
    docs, known = frames(spark, rows + extra, labels + [(3, 0), (3, 1), (None, 1), (5000, 1)])
    got = q.quality_scores(docs, known, held).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
    judged = [(r.predicted == truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(judged) > 60 and np.mean(judged) >= 0.97
    assert len({r.score for r in got if r.doc_id == 0}) == 1 and len({r.score for r in got if r.doc_id in (1000, 1001)}) == 1


def test_labels_of_held_out_rows_and_negatives_teach_nothing(spark):
    rows, labels = made(200)
    out = []
    for change in (lambda k, y: (k, y), lambda k, y: (k, 1 - y) if is_held[k] else (k, y), lambda k, y: (k, y if y else None)):
        docs, known = frames(spark, rows, labels)
        is_held = {r.doc_id: r.h for r in docs.select("doc_id", held(F.col("doc_id")).alias("h")).collect()}
        docs, known = frames(spark, rows, [change(*x) for x in labels], 1 if out else 5)
        out.append({r.doc_id: r.score for r in q.quality_scores(docs, known, held).collect()})
    assert out[0] == pytest.approx(out[1], abs=1e-9) and out[0] == pytest.approx(out[2], abs=1e-9)


def test_risk_equals_plain_sums(spark):
    rows, labels = made(120)
    docs, known = frames(spark, rows, labels)
    stored = q.document_features(docs, known, held).filter("not held_out")
    settings, prior = q.Settings(), 0.6
    risk = q._Risk(stored, settings)
    found = stored.collect()
    x = np.array([np.frombuffer(r.x, np.uint8) for r in found], float)
    p = np.array([r.positive for r in found])
    c = x[:, -1:] / 255
    mean = (c * x[:, :-1]).sum(0) / c.sum()
    spread = np.sqrt((c * (x[:, :-1] - mean) ** 2).sum(0) / c.sum())
    z = c * (x[:, :-1] - mean) / np.where(spread > 1e-6, spread, np.inf)

    def plain(v):
        g = z @ v[:-1] + v[-1]
        rest = np.logaddexp(0, g).mean() - prior * np.logaddexp(0, g[p]).mean()
        return prior * np.logaddexp(0, -g[p]).mean() + max(0, rest), rest

    rng = np.random.default_rng(0)
    for size in (0.0, 0.01, 0.3):
        v = np.append(rng.normal(size=q.WIDTH) * size, 0.2)
        value, slope, raised = risk.non_negative(prior)(v)
        want, rest = plain(v)
        assert value == pytest.approx(want, abs=1e-4) and (raised is not None) == (rest < 0)
        if raised is None:
            way = rng.normal(size=len(v)) * 1e-4
            assert plain(v + way)[0] - plain(v - way)[0] == pytest.approx(2 * slope @ way, rel=0.02, abs=1e-6)


def test_prior_is_near_the_share_of_positives(spark):
    rows, labels = made(900, seed=8)
    docs, known = frames(spark, rows, labels)
    model = q.train(q.document_features(docs, known, held).filter("not held_out"))
    assert model.prior == pytest.approx(np.mean([t.endswith(".") for _, t in rows]), abs=0.08)


def test_without_positives_and_without_rows(spark):
    rows, labels = made(30)
    docs, none = frames(spark, rows, [])
    assert {(r.score, r.predicted) for r in q.quality_scores(docs, none, held).collect()} == {(0.0, 0)}
    docs, known = frames(spark, rows, labels)
    assert q.quality_scores(docs.limit(0), known, held).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the driver's tables")
def test_held_out_accuracy_on_the_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = q.quality_scores(docs.select("doc_id", "text"), labels.select("doc_id", "quality"), held).filter("held_out").join(labels, "doc_id")
    assert judged.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] >= 0.95
