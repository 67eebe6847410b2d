"""Vector codes against a plain version, and the trees against their points."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from demandtide.llm.vector_codes import descend, grow, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, id long, error string"


def plain(rows, parts, entries, rounds=2):
    rows = [(i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v], lab) for i, v, lab in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    width = len(rows[0][1]) // parts
    cut = np.array([v for _, v, _ in rows]).reshape(len(rows), parts, width)
    first = {}
    for i, v, _ in rows:
        if i is not None:
            first[i] = min(first.get(i, v), v)
    books = np.array([first[i] for i in sorted(first)[:entries]]).reshape(-1, parts, width).transpose(1, 0, 2).copy()

    def nearest():
        d = ((cut[:, :, None] - books[None]) ** 2).sum(-1)
        return d.argmin(-1), d.min(-1).sum(1)

    for _ in range(rounds):
        code, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                if (own := cut[code[:, p] == e, p]).size:
                    books[p, e] = [int(s) // len(own) for s in own.sum(0)]
    code, error = nearest()
    by = {}
    for (_, _, lab), x in zip(rows, error):
        by[lab] = by.get(lab, 0) + int(x)
    digest = hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in cs), int(x), by[lab], digest) for (i, _, lab), cs, x in zip(rows, code, error)), key=str)


def test_equal_to_the_plain_version(spark, rows):
    rng = np.random.default_rng(1)
    made = [(k, rng.normal(size=8).round(2).tolist(), int(k % 5) if k % 7 else None) for k in range(400)]
    made += [(k, [0.5] * 8, 1) for k in range(1000, 1300)]  # a large group of copies
    made += [(3, made[3][1], 2), (4, [9.0] * 8, 2), (None, [0.25] * 8, None), (-5, [-0.001] * 8, 3)]
    bad = [(9001, None, 1), (9002, [], 1), (9003, [None] + [1.0] * 7, 1), (9004, [float("nan")] * 8, 1), (9005, [float("inf")] + [0.0] * 7, None), (-9, [1.0] * 7, 1)]
    frame = spark.createDataFrame([(i, v, lab, "x", 7, "y") for i, v, lab in made + bad], SCHEMA).repartition(5)
    got = vector_codes(frame, parts=4, entries=16).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted(rows(got), key=str) == plain(made, 4, 16)


def test_few_rows_and_none(spark, rows):
    few = [(2, [0.1, -0.1], None), (1, [0.1, -0.1], None), (7, [3.0, 4.0], 1)]
    frame = spark.createDataFrame([(i, v, lab, "x", 7, "y") for i, v, lab in few], SCHEMA)
    got = vector_codes(frame, parts=2, entries=64).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted(rows(got), key=str) == plain(few, 2, 64)
    assert vector_codes(frame.limit(0)).count() == 0
    assert vector_codes(frame.filter("vec_id = 1").selectExpr("cast(null as long) vec_id", "embedding", "label"), parts=2).count() == 1


def test_values_too_large_to_square_raise(spark):
    with pytest.raises(Exception, match="or more"):
        vector_codes(spark.createDataFrame([(1, [1e30, 0.0], 1, "x", 7, "y")], SCHEMA), parts=2).count()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(1, 12), st.integers(0, 10**6), st.sampled_from([2, 30, 5000]))
def test_balls_hold_their_points_and_find_the_nearest_entry(n, k, seed, spread):
    rng = np.random.default_rng(seed)
    points, entries = rng.integers(-spread, spread, (n, 3)), rng.integers(-spread, spread, (k, 3))
    tree = grow(points)
    assert sorted(tree.order) == list(range(n))
    for b in range(len(tree.start)):
        own = points[tree.order[tree.start[b] : tree.stop[b]]]
        assert (tree.total[b] == own.sum(0)).all() and ((own - tree.centre[b]) ** 2).sum(1).max() == tree.reach[b]
        if tree.left[b] >= 0:
            assert tree.stop[tree.left[b]] - tree.start[tree.left[b]] + tree.stop[tree.right[b]] - tree.start[tree.right[b]] == len(own)
    found = np.full(n, -1)
    for kind, at, entry in descend(tree, points, entries):
        for a, e in zip(at, entry):
            rows = tree.order[tree.start[a] : tree.stop[a]] if kind == "owned" else [a]
            assert (found[rows] == -1).all()
            found[rows] = e
    assert (found == ((points[:, None] - entries[None]) ** 2).sum(-1).argmin(1)).all()
