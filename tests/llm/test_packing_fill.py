"""Batches are full whatever the length of their sequences."""

import random
from collections import defaultdict

from demandtide.llm.packing import pack


def test_mean_fill_of_every_bucket(spark):
    rng = random.Random(3)
    frame = spark.createDataFrame([(k, rng.choice([rng.randrange(1, 9), rng.randrange(9, 130), rng.randrange(130, 3000)])) for k in range(120_000)], "doc_id long, n_tokens long")
    batches = defaultdict(int)
    for r in pack(frame).groupBy("bucket_len", "batch_id").count().collect():
        assert r["count"] * r.bucket_len <= 65536
        batches[r.bucket_len, r.batch_id] = r["count"]
    rows, held = defaultdict(int), defaultdict(int)
    for (length, _), n in batches.items():
        rows[length] += n
        held[length] += 65536 // length
    fill = {length: rows[length] / held[length] for length in rows if rows[length] >= 20 * (65536 // length)}
    assert len(fill) >= 8 and min(fill.values()) > 0.93, fill
    assert sum(rows.values()) / sum(held.values()) > 0.9
