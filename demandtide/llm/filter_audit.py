"""Filter interaction audit: what each of five filters removes, in every order they can be applied in.

The documents become a sparse document-term matrix. A task reads blocks of whole
documents and writes a block's rows over the block's own word list, which is cut by a
hash of the words; the cuts of all blocks meet, every word gets one global code, and the
codes go back to their blocks, which become CSR shards over the global dictionary. Row sums (words) and
nonzero counts (distinct words) of the shards decide filters A and B. The other filters
are marks taken from the text on the way; identical texts meet by their SHA-256. The
counts of all 32 combinations of failures a part then give every order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from demandtide.llm.storage import held, removed, stored
from demandtide.llm.words import batch, lists

#: The filters of the audit, in the order of their bits.
FILTERS = "ABCDE"
_SYMBOLS = b"#$%&*|"
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOLLOWING = bytes(range(0x80, 0xC0))
C, D = 1 << FILTERS.index("C"), 1 << FILTERS.index("D")

BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 8192

#: Of every document: key, part, digest of the text and the marks of filters C and D.
_FACTS = [("ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.string())), ("digests", pa.list_(pa.binary())), ("marks", pa.list_(pa.int8()))]
#: A block: its facts, row ends and packed 32-bit terms and counts (cut null), or a cut of its word list, joined by spaces.
_BLOCK = pa.schema([("block", pa.int64()), *_FACTS, ("ends", pa.list_(pa.int64())), ("terms", pa.binary()), ("counts", pa.binary()), ("cut", pa.int32()), ("words", pa.binary())])
_SHARD = pa.schema([("block", pa.int64()), *_FACTS, ("indptr", pa.list_(pa.int64())), ("indices", pa.list_(pa.int64())), ("data", pa.list_(pa.int32()))])
_FACTS_DDL = "block long, ids array<long>, parts array<string>, digests array<binary>, marks array<tinyint>"


def marks(body: bytes) -> int:
    """Bits of the filters that a text fails by its characters alone: C, more than 2 % capitals; D, a symbol of ``#$%&*|``."""
    capitals = len(body) - len(body.translate(None, _CAPITALS))
    points = len(body.translate(None, _FOLLOWING))
    return (C if 100 * capitals > 2 * points else 0) | (D if len(body.translate(None, _SYMBOLS)) < len(body) else 0)


class _Codes(dict):
    """word -> place in the block's own list, in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _blocks(cuts: int):
    """Blocks of whole documents (id, part, body) as rows over their own word lists; a block ends at ``BLOCK_BYTES`` of text or ``BLOCK_ROWS`` rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        facts, terms, counts, words, size = [], [], [], _Codes(), 0

        def block() -> Iterator[pa.RecordBatch]:
            name, listed = task << 32 | made, list(words)
            cut = np.fromiter((xxhash.xxh3_64_intdigest(w) % cuts for w in listed), np.int32, len(listed))
            order = np.argsort(cut, kind="stable")
            place = np.empty(len(listed), np.int32)
            place[order] = np.arange(len(listed), dtype=np.int32)
            ends = np.concatenate(([0], np.cumsum([len(t) for t in terms])))
            yield batch(_BLOCK, [name], *([list(x)] for x in zip(*facts)), lists([ends], pa.int64()), [place[np.concatenate(terms)].tobytes()], [np.concatenate(counts).tobytes()], [None], [None])
            met, first = np.unique(cut[order], return_index=True)
            for c, own in zip(met.tolist(), np.split(order, first[1:])) if len(met) else ():
                yield batch(_BLOCK, [name], *([None] for _ in range(7)), [c], [b" ".join([listed[k] for k in own])])

        for b in batches:
            for key, part, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                body = body.as_py() or b""
                found = body.split()
                at, n = np.unique(np.fromiter(map(words.__getitem__, found), np.int32, len(found)), return_counts=True)
                facts.append((key, part, hashlib.sha256(body).digest(), marks(body)))
                terms.append(at)
                counts.append(n.astype(np.int32))
                size += len(body)
                if size >= BLOCK_BYTES or len(facts) >= BLOCK_ROWS:
                    yield from block()
                    made, facts, terms, counts, words, size = made + 1, [], [], [], _Codes(), 0
        if facts:
            yield from block()

    return read


def _number(key: tuple[pa.Scalar, ...], cuts: pa.Table) -> pa.Table:
    """Codes of all words of one cut (block, cut, words): the cut's number and the word's rank among the cut's distinct words, so a second run gives the same."""
    lists_ = [w.as_py().split(b" ") for w in cuts.column("words")]
    met = pa.array([w for x in lists_ for w in x], pa.binary()).dictionary_encode()
    rank = np.empty(len(met.dictionary), np.int64)
    rank[np.asarray(pc.sort_indices(met.dictionary))] = np.arange(len(rank))
    codes = rank[np.asarray(met.indices)] | (key[0].as_py() << 40)
    return pa.table({"block": cuts.column("block"), "cut": cuts.column("cut"), "codes": lists(np.split(codes, np.cumsum([len(x) for x in lists_])[:-1]), pa.int64())})


def _shards(block: pa.Table, codes: pa.Table) -> pa.Table:
    """One block's rows over the global codes: its places follow the cuts."""
    parts = [np.asarray(codes.column("codes")[int(k)].values) for k in np.argsort(np.asarray(codes.column("cut")))]
    code = np.concatenate([np.empty(0, np.int64), *parts])
    b = block.combine_chunks().to_batches()[0]
    cells = dict(zip(b.schema.names, b.columns))
    terms, counts = (np.frombuffer(cells[name][0].as_py(), np.int32) for name in ("terms", "counts"))
    return pa.Table.from_batches([batch(_SHARD, *(cells[f.name] for f in list(_SHARD)[:5]), cells["ends"], lists([code[terms]], pa.int64()), lists([counts], pa.int32()))])


def document_terms(df: DataFrame) -> DataFrame:
    """Stored CSR shards (block, ids, parts, digests, marks, indptr, indices, data) of ``df`` (id long, part string, body binary).

    ``indices`` are codes of one dictionary over all shards, ``data`` the counts; a null
    body is an empty row. There are as many cuts of the dictionary as shuffle partitions.
    A word stands once in a block's list however often its documents hold it, so the most
    frequent word is as many entries of its cut as there are blocks.
    """
    spark = df.sparkSession
    cuts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, folder = held(df.select("id", "part", "body").mapInArrow(_blocks(cuts), f"{_FACTS_DDL}, ends array<long>, terms binary, counts binary, cut int, words binary"), "term-blocks")
    codes = blocks.filter("cut is not null").select("block", "cut", "words").groupBy("cut").applyInArrow(_number, "block long, cut int, codes array<long>")
    local = blocks.filter("cut is null").drop("cut", "words")
    joined = local.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(_shards, f"{_FACTS_DDL}, indptr array<long>, indices array<long>, data array<int>")
    shards, _ = held(joined, "term-shards")
    removed(spark, folder)
    return shards


def _row_masks(fewest: int, share: int):
    """id, part, digest, mask of every row of the shards: row sums and nonzero counts give filters A and B."""
    schema = pa.schema([("id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("mask", pa.int32())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, parts, digests, flags, indptr, data in zip(*b.columns):
                indptr = np.asarray(indptr.values)
                sums = np.concatenate(([0], np.cumsum(np.asarray(data.values), dtype=np.int64)))[indptr]
                n, distinct = np.diff(sums), np.diff(indptr)
                mask = np.asarray(flags.values) | np.where(n < fewest, 1, 0) | np.where(100 * distinct < share * n, 2, 0)
                yield batch(schema, ids.values, parts.values, digests.values, mask.astype(np.int32))

    return read


def failure_counts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source", fewest: int = 200, share: int = 50) -> DataFrame:
    """part, mask, n, good, toxic: documents by the set of filters that they fail, as bits of ``FILTERS``.

    Columns read: key, text, part of ``docs``; doc_id, quality, toxic of ``labels``. Null
    texts are empty and a null part is the empty string. A document is a row; rows of one
    key are documents of their own, none smaller than the other. A null key is not
    smaller than any, has no smaller one and no label. Several labels of one key count
    as 1 where any of them is 1. Empty tables give no rows. Copies are summed by (text,
    part, failures, labels) before they meet, so a text that a third of all documents
    share is a few rows a part.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).cast("string").cast("binary").alias("body"))
    shards = document_terms(rows).select("ids", "parts", "digests", "marks", "indptr", "data")
    marked = stored(shards.mapInArrow(_row_masks(fewest, share), "id long, part string, digest binary, mask int"), "filter-masks")
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    none = F.lit(0)
    labelled = marked.filter("id is not null").join(known, "id", "left").withColumns({"good": F.coalesce("good", none), "toxic": F.coalesce("toxic", none)})
    group = ["digest", "part", "mask", "good", "toxic"]
    copies = labelled.groupBy(*group, "id").agg(F.count("*").alias("n")).groupBy(*group).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("least"))
    copies = stored(copies, "filter-copies")
    first = copies.groupBy(F.col("digest").alias("of")).agg(F.min("least.id").alias("first"))
    met = copies.join(first, F.col("digest") == F.col("of"))
    own = F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = F.explode(F.array(F.struct(F.col("mask").alias("mask"), own.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - own).alias("n"))))
    apart = marked.filter("id is null").groupBy("part", "mask").agg(F.count("*").alias("n")).select("part", "mask", "n", none.alias("good"), none.alias("toxic"))
    counted = met.select("part", "good", "toxic", split.alias("s")).select("part", "s.mask", "s.n", "good", "toxic").unionByName(apart)
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")).filter("n > 0")


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of the filters before it) of all orders."""
    return [("".join(order), k + 1, 1 << FILTERS.index(f), sum(1 << FILTERS.index(g) for g in order[:k])) for order in permutations(FILTERS) for k, f in enumerate(order)]


def _total(masks: Column, wanted, what) -> Column:
    return F.aggregate(F.filter(masks, wanted), F.lit(0).cast("long"), lambda s, m: s + what(m))


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, filter order and step from ``counts`` (part, mask, n, good, toxic): all orders of all parts, zeros included.

    At most 32 rows a part are gathered into one list; every step is a sum over that list.
    """
    lists = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    steps = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(bit).alias("bit"), F.lit(before).alias("before")) for o, k, bit, before in _steps()))
    rows = lists.select("part", "masks", F.explode(steps).alias("s")).select("part", "masks", "s.*")
    m, bit, before = F.col("masks"), F.col("bit"), F.col("before")
    fails = lambda x: x.mask.bitwiseAND(bit) != 0
    there = lambda x: x.mask.bitwiseAND(before) == 0
    removed = lambda x: fails(x) & there(x)
    return rows.select(
        "part", "filter_order", "step",
        _total(m, lambda x: ~fails(x) & there(x), lambda x: x.n).alias("kept"), _total(m, removed, lambda x: x.n).alias("removed"),
        _total(m, lambda x: fails(x) & ~there(x), lambda x: x.n).alias("redundant"), _total(m, lambda x: x.mask == bit, lambda x: x.n).alias("unique_fails"),
        _total(m, removed, lambda x: x.good).alias("good_lost"), _total(m, removed, lambda x: x.toxic).alias("toxic_lost"),
        # of the orders, one in as many as a document has failures takes it out by this filter
        _total(m, fails, lambda x: (x.n * 120 / F.bit_count(x.mask)).cast("long")).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``audit`` of ``failure_counts``; the rules for nulls, repeated rows and empty tables are stated there."""
    return audit(failure_counts(docs, labels, **options))
