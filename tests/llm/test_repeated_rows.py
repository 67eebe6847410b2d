"""A repeated row must not cost its document a link."""

import random

from demandtide.llm import minhash_dedup as mh


def test_no_link_is_lost_to_repeated_rows_of_a_chain(spark):
    rng = random.Random(9)
    text, texts = [f"w{rng.randrange(5000)}" for _ in range(200)], []
    for k in range(25):
        texts.append((k, " ".join(text)))
        for j in range(6 * k, 6 * k + 6):
            text[j] = f"new{k}x{j}"
    alone = {r.doc_id: r.component_id for r in mh.minhash_dedup(spark.createDataFrame(texts, "doc_id long, text string"), n=2).collect()}
    repeated = spark.createDataFrame(texts + texts[1:20:2], "doc_id long, text string")
    rows = mh.minhash_dedup(repeated, n=2).collect()
    assert len(rows) == 35 and set(alone.values()) == {0}
    assert {r.doc_id: r.component_id for r in rows} == alone


def test_sets_of_the_prefix_join_are_one_row_an_id(spark, monkeypatch):
    seen, real = [], mh._prefix_pairs
    monkeypatch.setattr(mh, "_prefix_pairs", lambda sets, parts, percent: seen.append(sets.groupBy("id").count().filter("count > 1").count()) or real(sets, parts, percent))
    texts = [(k, " ".join(f"w{j}" for j in range(60))) for k in (1, 2, 2)] + [(3, " ".join(f"w{j}" for j in range(1, 61)))] * 2
    mh.minhash_dedup(spark.createDataFrame(texts, "doc_id long, text string"), n=2).collect()
    assert seen == [0]
