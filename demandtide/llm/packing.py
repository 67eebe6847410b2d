"""Packing into optimal length buckets.

Lengths are summed to one global histogram (at most ``max_len`` rows, however many
documents there are). Dynamic programming over it chooses the bucket boundaries
with the least padding, exactly. Sequences of one bucket are dealt into slots of
bounded size and numbered there, so token-budget batches form without a global
order and without gathering a bucket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; null: 0."""
    spaced = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(F.size(F.filter(F.split(spaced, " "), lambda w: w != "")), F.lit(0)).cast("long")


def best_boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets that minimise the padding over the histogram (length -> count).

    cost(i, j) pads the lengths i+1..j to length j; best[k][j] = min over i of
    best[k-1][i] + cost(i, j). Ties take the smallest i. An optimal bound always is a
    length that occurs. Empty: no bounds.
    """
    lengths = np.array(sorted(k for k, v in histogram.items() if v > 0), np.float64)
    if not len(lengths):
        return []
    count = np.concatenate(([0.0], np.cumsum([histogram[int(k)] for k in lengths])))
    tokens = np.concatenate(([0.0], np.cumsum([histogram[int(k)] * k for k in lengths])))
    m = len(lengths)
    best, choice = np.full(m + 1, np.inf), []
    best[0] = 0
    for _ in range(min(buckets, m)):
        new, took = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        new[0] = 0
        for j in range(1, m + 1):
            cost = best[:j] + (count[j] - count[:j]) * lengths[j - 1] - (tokens[j] - tokens[:j])
            took[j] = int(np.argmin(cost))
            new[j] = cost[took[j]]
        best = new
        choice.append(took)
    bounds, j = [], m
    for took in reversed(choice):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(took[j])
    return bounds[::-1]


def sequences(df: DataFrame, key: str, length: str, max_len: int) -> DataFrame:
    """doc_id, part, length: a document as full sequences of ``max_len`` and the rest. Lengths of 0 or null give no sequence."""
    n = F.col(length)
    parts = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / max_len))
    return (
        df.filter(n > 0).select(F.col(key).cast("long").alias("doc_id"), n.cast("long").alias("whole"), F.explode(parts).alias("part"))
        .select("doc_id", "part", F.least(F.lit(max_len), F.col("whole") - F.col("part") * max_len).cast("long").alias("length"))
    )


def pack(
    df: DataFrame, key: str = "doc_id", length: str = "n_tokens", max_len: int = 2048, buckets: int = 16, token_budget: int = 65536, slot_batches: int = 32
) -> DataFrame:
    """doc_id, part, length, bucket_len, batch_id: every sequence, its bucket's padded length and its batch.

    A batch holds sequences of one bucket, at most ``token_budget`` padded tokens
    (max(1, budget // bucket_len) sequences). Batches are numbered within slots of
    about ``slot_batches`` full batches, chosen by a hash of document and part; a slot leaves
    at most one batch unfilled, so on average batches are full but for half a batch in
    ``slot_batches``, whatever the length. batch_id is ``bucket_len-slot-number``. A document
    longer than ``max_len`` fills several sequences; documents without tokens have none.
    Repeated rows are sequences of their own, a null key is kept; an empty table gives
    no rows. The driver sees the histogram only: at most ``max_len`` rows.
    """
    cut = sequences(df, key, length, max_len)
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bounds = best_boundaries(histogram, buckets)
    if not bounds:
        return cut.select("doc_id", "part", "length", F.col("length").alias("bucket_len"), F.lit("").alias("batch_id"))
    slots, low = {}, 0
    for high in bounds:
        full = max(1, token_budget // high)
        slots[high] = max(1, round(sum(n for k, n in histogram.items() if low < k <= high) / (full * slot_batches)))
        low = high
    bucket = F.element_at(F.filter(F.array(*map(F.lit, bounds)), lambda b: b >= F.col("length")), 1).cast("long")
    spread = F.pmod(F.xxhash64(F.lit("slot"), "doc_id", "part"), F.element_at(F.create_map(*(F.lit(int(x)) for pair in slots.items() for x in pair)), F.col("bucket_len").cast("int")))
    dealt = cut.withColumn("bucket_len", bucket).withColumn("slot", spread)
    place = F.row_number().over(Window.partitionBy("bucket_len", "slot").orderBy("doc_id", "part")) - 1
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("bucket_len")))
    number = F.floor(place / per_batch)
    return dealt.select("doc_id", "part", "length", "bucket_len", F.concat_ws("-", "bucket_len", "slot", number).alias("batch_id"))
