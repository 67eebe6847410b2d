"""Repeated passages of lines against brute force over all pairs of lines."""

import random

from demandtide.llm.line_chunks import passage_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def some(rng, n):
    return " ".join(f"w{rng.randrange(400)}" for _ in range(n))


def brute(texts):
    seen, out = set(), {}
    for k, t in texts:
        lines, gone = t.split("\n"), set()
        for i, line in enumerate(lines):
            pair = tuple(lines[i : i + 2])
            gone |= {i, i + 1} if len(pair) == 2 and pair in seen else set()
            gone |= {i} if len(line.split()) >= 50 and (line,) in seen else set()
            seen |= ({pair} if len(pair) == 2 else set()) | ({(line,)} if len(line.split()) >= 50 else set())
        out[k] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def test_passages_equal_brute_force(spark):
    rng = random.Random(5)
    shared = [[some(rng, 8) for _ in range(rng.randrange(2, 9))] for _ in range(4)] + [[some(rng, 60)]]
    texts = []
    for k in range(50):
        lines = [some(rng, 5) for _ in range(rng.randrange(0, 4))] + rng.choice(shared) + [some(rng, 5) for _ in range(rng.randrange(0, 4))]
        texts.append((k, "\n".join(lines)))
    texts += [(60, ""), (61, "\n\n\n"), (62, "one line"), (63, "\n".join(["same"] * 3000)), (64, "é\ny"), (65, "x\né\ny\n")]
    frame = spark.createDataFrame([(k, t, None, None, 1) for k, t in texts] + [(99, None, None, None, 1)], DOCS)
    got = {r.doc_id: (r.text, r.n_lines, r.removed_lines) for r in passage_dedup(frame).collect()}
    assert got == brute(texts) | {99: (None, 0, 0)}
    assert sum(g[2] for g in got.values()) > 100
    lines = {x for _, t in texts for x in t.split("\n")}
    assert lines == {x for t, _, _ in got.values() if t is not None for x in t.split("\n")}
    twice = passage_dedup(spark.createDataFrame([(k, texts[0][1], None, None, 1) for k in (1, 1, None)], DOCS)).collect()
    assert sorted(r.removed_lines > 0 for r in twice) == [False, True, True]
    assert passage_dedup(frame.limit(0)).count() == 0


def test_the_pipeline_removes_whole_passages_between_foreign_lines(spark):
    from corpus_pipeline import lines

    rng = random.Random(6)
    passage = [some(rng, 8) for _ in range(7)]
    texts = [(k, [some(rng, 6)] + passage + [some(rng, 6)]) for k in range(20)]
    frame = spark.createDataFrame([(k, "\n".join(t), "aa", "s", 1) for k, t in texts], DOCS)
    got = {r.doc_id: r.text.split("\n") for r in lines(spark, frame, "").collect()}
    assert got == {k: t if k == 0 else [t[0], t[-1]] for k, t in texts}
