"""The language model against plain dictionaries, and its layout at many sizes."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from demandtide.llm import pitman_yor as py

LAYOUTS = [{"frequent_share": 10**6}, {"frequent_share": 1}, {"frequent_share": 1, "bucket_bytes": 8}]


def frame(spark, rows):
    return spark.createDataFrame([(k, t.encode(), learn) for k, t, learn in rows], "id long, body binary, learn boolean")


def test_scores_equal_dictionaries_where_seating_is_certain(spark):
    """One training text of distinct words: every dish has one customer and one table, so nothing is left to chance."""
    rnd = random.Random(2)
    chain = [f"w{k}" for k in range(150)]
    rows = [(0, " ".join(chain), True), (1, "w3 w4 w5 w9 w8 new w10 w11", False), (2, "", False), (3, " ".join(rnd.choices(chain, k=90)), False), (4, "w149", False)]
    tokens = [*chain, None]
    pairs, contexts, n = set(zip([None, *tokens], tokens)), set(tokens), len(tokens)
    root = lambda w: ((0.25 if w in contexts else 0.0) + (1 + 0.75 * n) / (n + 1)) / (1 + n)

    def score(text):
        words = [*text.split(), None]
        p = 0.0
        for u, w in zip([None, *words], words):
            p += math.log10(((0.25 if (u, w) in pairs else 0.0) + 1.75 * root(w)) / 2 if u in contexts else root(w))
        return p

    for layout in LAYOUTS:
        got = {r.id: r for r in py.score_texts(frame(spark, rows), **layout).collect()}
        for k, text, _ in rows:
            assert got[k].score == pytest.approx(score(text), rel=1e-5)
            assert got[k].n_known == sum(w in contexts for w in [*text.split(), None])


def seated_one_by_one(training, sweeps, burn_in, rnd):
    """Plain Gibbs over customers: each gets up and sits down again, in both levels. Yields a predictive function a sweep."""
    vocabulary = len({w for text in training for w in text})
    tables, total, customers = defaultdict(list), Counter(), Counter()
    root, root_total = defaultdict(list), [0, 0]  # customers, tables

    def root_p(w):
        return (sum(root[w]) - 0.75 * len(root[w]) + (1 + 0.75 * root_total[1]) / (vocabulary + 1)) / (1 + root_total[0])

    def sit(seats, new):
        weights = [x - 0.75 for x in seats] + [new]
        k = rnd.choices(range(len(weights)), weights)[0]
        if k == len(seats):
            seats.append(0)
        seats[k] += 1
        return k == len(seats) - 1 and seats[k] == 1

    def rise(seats):
        k = rnd.choices(range(len(seats)), seats)[0]
        seats[k] -= 1
        if not seats[k]:
            seats.pop(k)
            return True
        return False

    def add(u, w):
        if sit(tables[u, w], (1 + 0.75 * total[u]) * root_p(w)):
            total[u] += 1
            if sit(root[w], (1 + 0.75 * root_total[1]) / (vocabulary + 1)):
                root_total[1] += 1
            root_total[0] += 1
        customers[u] += 1

    def remove(u, w):
        customers[u] -= 1
        if rise(tables[u, w]):
            total[u] -= 1
            root_total[0] -= 1
            if rise(root[w]):
                root_total[1] -= 1

    pairs = [p for text in training for p in zip([None, *text], text)]
    for u, w in pairs:
        add(u, w)
    for s in range(sweeps):
        for u, w in pairs:
            remove(u, w)
            add(u, w)
        if s >= burn_in:
            yield lambda u, w: (sum(tables[u, w]) - 0.75 * len(tables[u, w]) + (1 + 0.75 * total[u]) * root_p(w)) / (1 + customers[u])


def test_scores_agree_with_customers_seated_one_by_one(spark):
    rnd = random.Random(4)
    follow = {k: [rnd.randrange(60) for _ in range(4)] for k in range(60)}

    def text():
        at, out = rnd.randrange(60), []
        for _ in range(rnd.randrange(5, 40)):
            at = rnd.choice(follow[at]) if rnd.random() < 0.8 else int(60 * rnd.random() ** 2)
            out.append(f"w{at}")
        return out

    texts = [text() for _ in range(150)]
    rows = [(k, " ".join(t), k < 120) for k, t in enumerate(texts)]
    held = [(u, w) for t in texts[120:] for u, w in zip([None, *t], [*t, None])]
    mean = np.zeros(len(held))
    for p in seated_one_by_one([[*t, None] for t in texts[:120]], 16, 6, random.Random(1)):
        mean += [p(u, w) for u, w in held]
    want = np.log10(mean / 10).sum()
    for layout in ({"frequent_share": 1}, {"frequent_share": 30}):
        got = sum(r.score for r in py.score_texts(frame(spark, rows), **layout).filter("id >= 120").collect())
        assert got == pytest.approx(want, rel=0.01)


def test_parts_do_not_grow_with_the_number_of_buckets():
    """Bytes a token of a block of many texts, dealt to as many buckets as 0.5 GB and 30 GB of texts have."""
    rng = np.random.default_rng(3)
    vocabulary = np.unique(rng.integers(0, 1 << 53, 100_000, dtype=np.uint64))
    word = vocabulary[(len(vocabulary) * rng.random(500_000) ** 4).astype(np.int64)]
    doc = np.repeat(np.arange(2500), 200)
    ids, train, none = np.arange(2500, dtype=np.int64) * 7, np.ones(2500, bool), np.empty(0, np.uint64)
    few, many = (sum(len(x) for _, x in py.block_parts(py.contexts(word), word, doc, ids, train, none, n)) / len(word) for n in (86, 5000))
    assert few < 10 and many < 1.5 * few
