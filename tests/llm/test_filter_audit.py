"""The filter audit against direct application of the filters, and its matrix against the words."""

import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandtide.llm import filter_audit as fa

DOCS = "doc_id long, text string, source string, lang string, mask int, n string, part string"
LABELS = "doc_id long, quality int, toxic int, good string"


def made():
    rng = random.Random(5)
    plain = " ".join(f"w{k}" for k in range(210))
    texts = ["", " ", None, "\t\n \x0b\x0c\r", plain, plain, plain + " X" * 9, "same " * 250, "same " * 250 + "#", "A" * 3 + "b" * 147, "A" * 3 + "b" * 146, "é" * 150 + "AAA", "a\x00b a b", "x|y", "k" * 200_000]
    texts += [" ".join(f"v{rng.randrange(60)}" for _ in range(rng.randrange(150, 260))) + rng.choice(["", " SHOUT" * 9, " %", "*"]) for _ in range(60)]
    texts += [rng.choice(texts) for _ in range(60)] + [plain] * 80
    rows = [(k, t, rng.choice(["a", "b", None, ""])) for k, t in enumerate(texts)]
    rows += [(3, plain, "a"), (4, plain, "b"), (4, plain, "b"), (None, plain, "a"), (None, "", None), (-1, "only here", "solo")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 200, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return rows, labels


def failures(rows):
    first = {}
    for key, text, _ in rows:
        if key is not None:
            first[text or ""] = min(first.get(text or "", key), key)
    for key, text, source in rows:
        t = text or ""
        words = t.encode().split()
        out = {"A"} if len(words) < 200 else set()
        out |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        out |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t) else set()
        out |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        out |= {"E"} if key is not None and key > first[t] else set()
        yield key, source or "", out


def brute(rows, labels):
    good, toxic, out = defaultdict(int), defaultdict(int), {}
    for key, q, t in labels:
        if key is not None:
            good[key] |= q == 1
            toxic[key] |= t == 1
    docs = list(failures(rows))
    orders = ["".join(o) for o in permutations("ABCDE")]
    shapley = Counter()
    for part in {d[1] for d in docs}:
        for order in orders:
            left = [d for d in docs if d[1] == part]
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[2]]
                fails = [d for d in docs if d[1] == part and f in d[2]]
                left = [d for d in left if f not in d[2]]
                out[part, order, step] = [len(left), len(gone), len(fails) - len(gone), sum(d[2] == {f} for d in fails), sum(good[d[0]] for d in gone), sum(toxic[d[0]] for d in gone)]
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.fixture(scope="module")
def frames(spark):
    rows, labels = made()
    docs = spark.createDataFrame([(k, t, s, "de", 5, "n", "p") for k, t, s in rows], DOCS).repartition(4)
    return docs, spark.createDataFrame([(*r, "g") for r in labels], LABELS)


def test_every_order_equals_applying_the_filters(frames):
    want = brute(*made())
    got = fa.filter_audit(*frames).collect()
    assert len(got) == len(want) == 600 * 4
    for r in got:
        assert tuple(r)[3:] == want[r.part, r.filter_order, r.step], r


def test_empty_tables(frames):
    docs, labels = frames
    assert fa.filter_audit(docs.limit(0), labels).count() == 0
    none = fa.filter_audit(docs, labels.limit(0))
    assert none.count() == 2400 and none.agg(F.sum("good_lost")).first()[0] == 0


def test_shards_share_one_dictionary(spark, monkeypatch):
    monkeypatch.setattr(fa, "BLOCK_ROWS", 3)
    rng = random.Random(2)
    texts = {k: " ".join(f"t{rng.randrange(40)}" for _ in range(rng.randrange(30))) for k in range(50)} | {50: ""}
    frame = spark.createDataFrame([(k, "p", t.encode()) for k, t in texts.items()], "id long, part string, body binary").repartition(3)
    words, code = defaultdict(set), defaultdict(set)
    for s in fa.document_terms(frame).collect():
        for j, key in enumerate(s.ids):
            row = slice(s.indptr[j], s.indptr[j + 1])
            counts = Counter(texts[key].split())
            assert sorted(s.data[row]) == sorted(counts.values()) and len(set(s.indices[row])) == len(counts)
            for c, n in zip(s.indices[row], s.data[row]):
                code[c].add(frozenset(w for w in counts if counts[w] == n))
                words[key].add(c)
    assert len(code) == len({w for t in texts.values() for w in t.split()})
    assert all(frozenset.intersection(*sets) for sets in code.values())  # one word fits all that a code counts
