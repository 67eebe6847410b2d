"""Decontamination against all items x all documents, in plain Python."""

import random

import numpy as np

from demandtide.llm import decontaminate as dec

WORDS, NAMES, NUMBERS, UNITS = "red the of runs box far".split(), ["Anna", "Bert", "Carla"], ["3", "7", "12"], ["kg", "lb"]


def kinds(text, first_is_name=False):
    """(word, slot) of each word: the words of these texts have one reading each."""
    out, raw = [], text.split()
    for k, w in enumerate(raw):
        slot = "number" if w in NUMBERS else "unit" if w in UNITS and k and raw[k - 1] in NUMBERS else "name" if w in NAMES and (k or first_is_name) else None
        out.append((w.lower(), slot))
    return out


def windows(text, n, either_first=False):
    """(view, place, template, values) of every window; view 1 reads names as names, view 2 as words."""
    out = set()
    for first in (False, True) if either_first and text.split()[:1] and text.split()[0] in NAMES else (False,):
        words = kinds(text, first)
        for at in range(len(words) - n + 1) if not first else range(min(1, len(words) - n + 1)):
            named = any(s == "name" for _, s in words[at : at + n])
            for view in (1, 2):
                if first and view == 2:
                    continue
                part = [(w, None if view == 2 and s == "name" else s) for w, s in words[at : at + n]]
                exact = any(s for _, s in part) and sum(s is None for _, s in part) < min(2, n)
                template = tuple(w if exact or s is None else "<" + s + ">" for w, s in part) + (exact,)
                values = tuple(w for w, s in part if s or exact)
                out.add((view if named else 0, at, template, values))
    return out


def covered(doc, item, n=5):
    width = min(n, len(item.split()))
    if not width:
        return 0.0
    mine, theirs = windows(item, width, True), windows(doc, width)
    found = set()
    for view in (1, 2):
        runs = {}
        for rv, at, template, values in mine:
            for dv, place, other, seen in theirs:
                if template == other and rv in (0, view) and dv in (0, view):
                    if values:
                        ats, slots = runs.setdefault(place - at, (set(), set()))
                        ats.add(at)
                        slots.update(zip(values, seen))
                    else:
                        found.add(at)
        for ats, slots in runs.values():
            if len(slots) == len({i for i, _ in slots}):
                found |= ats
    return len(found) / len({at for _, at, _, _ in mine})


def test_all_pairs(spark):
    rnd = random.Random(5)
    word = lambda: rnd.choice(rnd.choice([WORDS, WORDS, WORDS, NAMES, NUMBERS, UNITS]))
    items = {k: " ".join(word() for _ in range(rnd.choice([0, 1, 3, 4, 6, 9, 14]))) for k in range(40)}
    docs = {}
    for k in range(120):
        body = items[rnd.randrange(40)].split()
        swap = {w: rnd.choice(pool) for pool in (NAMES, NUMBERS, UNITS) for w in pool if rnd.random() < 0.5}
        body = [swap.get(w, w) if rnd.random() < 0.95 else word() for w in body]
        if rnd.random() < 0.3:
            body = [w.lower() for w in body]
        docs[k] = " ".join([word() for _ in range(rnd.randrange(4))] + body + [word() for _ in range(rnd.randrange(4))])
    want = {(d, i): c for d, x in docs.items() for i, y in items.items() if (c := covered(x, y)) >= 0.8}
    d = spark.createDataFrame(list(docs.items()) + [(500, None), (501, "")], "doc_id long, text string")
    i = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.id, r.item_id): r.coverage for r in dec.contaminated(d, i).collect()}
    assert len(want) > 100 and got == want
    assert {(r.id, r.item_id): r.coverage for r in dec.contaminated(d, i, filter_bits=6).collect()} == want


def test_filter_keeps_every_hash(spark):
    own = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 3000)
    bits = dec.window_filter(spark.createDataFrame([(int(x),) for x in own], "h long"), 20)
    assert len(bits) == 1 << 17
    assert dec.may_hold(bits, 20, own.view(np.uint64)).tolist() == list(range(3000))
    others = np.random.default_rng(2).integers(0, 1 << 63, 100_000).view(np.uint64)
    assert len(dec.may_hold(bits, 20, others)) < 20
