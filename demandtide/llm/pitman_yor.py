"""Language-model scores from a hierarchical Pitman-Yor model sampled by Gibbs.

Restaurants: every word has a restaurant of its own for the words after it; all of them
have the same parent, the unigram restaurant, whose base is uniform over the vocabulary
and one unseen word. A customer of a context restaurant is a training token; every table
there sends one customer to the parent.

Layout: a restaurant is dealt to one bucket by its word's hash, so its tables are counted
where they are. Words with more tokens than a bucket holds have their cells (context,
word) dealt one by one; there are at most as many of them as buckets, and their table
totals are shipped. Documents travel once, as packed blocks of postings, each bucket's
part being one row that carries the documents which occur in it. Cells of two words that
hold ``1 / FREQUENT`` of the tokens or more have no postings: there are at most
``FREQUENT`` squared of them, and documents score them where they are.

Sampling: a sweep redraws the number of tables of every cell from its exact conditional,
S(c, t) * p^t * prod(theta + d * (T + i)) with generalised Stirling numbers S, given the
parent as of the sweep before; seats beyond the first 64 customers of a cell follow the
restaurant's arrival rule as a Poisson number. Each bucket then tells the words' owners
(slices by the word's hash) how many tables each word has there; they redraw the parent's
tables and answer. Predictive probabilities are averaged over the sweeps kept.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from demandtide.llm.storage import held, removed, shared_folder, stored
from demandtide.llm.words import WordHashes, batch, mix

FREQUENT = 1024
_BITS = np.uint64(11)  # a word's id is the other 53 of its hash
END = np.uint64(0x1D8AF066F5A3C1B7)  # hash of the end mark, which is no word
DISCOUNT, STRENGTH = 0.75, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.75, 1.0
SWEEPS, BURN_IN = 4, 1
_EXACT = 64
_BLOCK_TOKENS, _BLOCK_DOCS = 500_000, 60_000


def word_ids(hashes: WordHashes, body: bytes | None) -> np.ndarray:
    """53-bit ids of a text's words and of the end mark."""
    return np.append(hashes.of(body), END) >> _BITS


def contexts(words: np.ndarray) -> np.ndarray:
    """Restaurant of each token: the word before it; a text starts after an end mark."""
    return np.append(END >> _BITS, words[:-1])


def rank_in(words: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Places of ``words`` in the sorted ``some``, -1 for others."""
    if not len(some):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(some, words), len(some) - 1)
    return np.where(some[at] == words, at, -1)


def share_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((mix(hashes) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def bucket_of(context: np.ndarray, word: np.ndarray, split: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each cell: that of the context; split contexts are dealt by cell."""
    with np.errstate(over="ignore"):
        return share_of(np.where(rank_in(context, split) >= 0, mix(context) + word, context), buckets)


# ---- packed arrays -------------------------------------------------------------------

_KINDS = ("u1", "u2", "u4", "u8", "i8", "f4", "f8")


def packed(*arrays: np.ndarray) -> bytes:
    """Numeric arrays as one compressed cell, byte plane by byte plane."""
    head = np.array([len(arrays), *(v for x in arrays for v in (len(x), _KINDS.index(x.dtype.str[1:])))], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(_planes(x) for x in arrays))


def unpacked(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    count = int(np.frombuffer(data, np.int64, 1)[0])
    heads, at, out = np.frombuffer(data, np.int64, 2 * count, 8).reshape(-1, 2).tolist(), 8 + 16 * count, []
    for n, kind in heads:
        x, at = _unplanes(data, at, n, np.dtype(_KINDS[kind]))
        out.append(x)
    return out


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(data: bytes, at: int, n: int, kind) -> tuple[np.ndarray, int]:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
    return np.ascontiguousarray(raw.T).view(kind).reshape(n), at + n * size


def _small(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the runs of equal neighbours."""
    starts = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.empty(0, np.int64)
    return starts, np.diff(np.append(starts, len(x)))


def pack_part(context, word, doc, n, ids, train) -> bytes:
    """One bucket's postings of a block, sorted by context, with the ids and training flags of the documents in it alone.
    Without documents (``doc`` is empty) the counts are training counts of cells that need no postings."""
    own, doc = np.unique(doc, return_inverse=True)
    starts, lengths = _runs(context)
    words, at = np.unique(word, return_inverse=True)
    return packed(_steps(context[starts]), _small(lengths), _steps(words), _small(at), _small(n), _small(doc), _steps(ids[own]), train[own].astype(np.uint8))


def unpack_part(blob: bytes) -> tuple[np.ndarray, ...]:
    context, lengths, words, at, n, doc, ids, train = unpacked(blob)
    context, words = np.cumsum(context, dtype=np.uint64), np.cumsum(words, dtype=np.uint64)
    return np.repeat(context, lengths), words[at], doc.astype(np.int64), n.astype(np.int64), np.cumsum(ids, dtype=np.int64), train.astype(bool)


# ---- passes over documents -----------------------------------------------------------


def _merge(ids: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    allids, where = np.unique(np.concatenate(ids), return_inverse=True)
    return allids, np.bincount(where, np.concatenate(counts), len(allids)).astype(np.int64)


def word_counts(train: DataFrame) -> DataFrame:
    """(word, n) over all training texts (id, body); a task sums its own words first."""
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        ids, counts, held = [], [], 0
        for b in batches:
            for cell in b.column(1):
                u, n = np.unique(word_ids(hashes, cell.as_py()), return_counts=True)
                ids.append(u)
                counts.append(n)
                held += len(u)
                if held > 400_000:
                    u, n = _merge(ids, counts)
                    ids, counts, held = [u], [n], len(u)
                    if len(u) > 300_000:
                        yield batch(schema, u.view(np.int64), n)
                        ids, counts, held = [], [], 0
        if ids:
            u, n = _merge(ids, counts)
            yield batch(schema, u.view(np.int64), n)

    return train.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def block_parts(context, word, doc, ids: np.ndarray, train: np.ndarray, split: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, part) of one block of tokens; ``doc`` counts from 0 in the block."""
    us, u = np.unique(context, return_inverse=True)
    ws, w = np.unique(word, return_inverse=True)
    key = np.sort((u.astype(np.uint64) << np.uint64(40)) | (w.astype(np.uint64) << np.uint64(16)) | doc.astype(np.uint64))
    starts, n = _runs(key)
    key = key[starts]
    context, word, doc = us[key >> np.uint64(40)], ws[key >> np.uint64(16) & np.uint64((1 << 24) - 1)], (key & np.uint64(0xFFFF)).astype(np.int64)
    bucket = bucket_of(context, word, split, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        at = order[cuts[k] : cuts[k + 1]]
        yield k, pack_part(context[at], word[at], doc[at], n[at], ids, train)


def _postings(frequent: np.ndarray, split: np.ndarray, buckets: int):
    """Rows (bucket, part): packed postings, and training counts of the cells of two frequent words."""
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.binary())])
    block = min(4_000_000, max(_BLOCK_TOKENS, 100 * buckets))
    nobody = np.empty(0, np.int64)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        table = np.zeros((len(frequent), len(frequent)), np.int64)
        cells: list[tuple] = []
        ids: list[int] = []
        flags: list[bool] = []
        held = 0

        def flush():
            parts = list(block_parts(*map(np.concatenate, zip(*cells)), np.array(ids, np.int64), np.array(flags, bool), split, buckets))
            for at in range(0, len(parts), 64):
                yield batch(schema, *map(list, zip(*parts[at : at + 64])))

        for b in batches:
            for doc, learn, cell in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(1)):
                words = word_ids(hashes, cell.as_py())
                context, rank = contexts(words), rank_in(words, frequent)
                before = np.append(rank[-1:], rank[:-1])  # the last token is the end mark, which also stands before the first
                both = (rank >= 0) & (before >= 0)
                if learn:
                    np.add.at(table, (before[both], rank[both]), 1)
                rest = ~both
                if rest.any():
                    cells.append((context[rest], words[rest], np.full(int(rest.sum()), len(ids), np.int64)))
                    ids.append(doc)
                    flags.append(learn)
                    held += len(cells[-1][0])
                if held >= block or len(ids) >= _BLOCK_DOCS:
                    yield from flush()
                    cells, ids, flags, held = [], [], [], 0
        if ids:
            yield from flush()
        u, w = np.nonzero(table)
        if len(u):
            bucket = bucket_of(frequent[u], frequent[w], split, buckets)
            some = np.unique(bucket).tolist()
            yield batch(schema, some, [pack_part(frequent[u[bucket == k]], frequent[w[bucket == k]], nobody, table[u, w][bucket == k], nobody, nobody) for k in some])

    return make


def merged_parts(blobs: list[bytes]) -> tuple[bytes, bytes]:
    """(cells, postings) of a bucket: cells are contexts, words and training counts, sorted; postings follow their order."""
    parts = [unpack_part(x) for x in blobs]
    offsets = np.cumsum([0, *(len(p[4]) for p in parts)])
    n = np.concatenate([p[3] for p in parts])
    learnt = np.concatenate([p[3] * p[5][p[2]] if len(p[4]) else p[3] for p in parts])
    posted = np.concatenate([np.full(len(p[3]), len(p[4]) > 0) for p in parts])
    doc = np.concatenate([p[2] + o if len(p[4]) else np.zeros(len(p[3]), np.int64) for p, o in zip(parts, offsets)])
    us, u = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    ws, w = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
    key = u * len(ws) + w
    order = np.argsort(key, kind="stable")
    starts, _ = _runs(key[order])
    c, m = np.add.reduceat(learnt[order], starts), np.add.reduceat(posted[order].astype(np.int64), starts)
    key, order = key[order][starts], order[posted[order]]
    cells = packed(_steps(us), _small(np.bincount(key // len(ws), minlength=len(us))), _steps(ws), _small(key % len(ws)), _small(c))
    return cells, packed(_small(m), _small(doc[order]), _small(n[order]), _steps(np.concatenate([p[4] for p in parts])))


def _merge_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bucket", pa.int32()), ("cells", pa.binary()), ("postings", pa.binary())])
    at, parts = None, []
    for b in batches:
        for k, part in zip(b.column(0).to_pylist(), b.column(1)):
            if k != at and parts:
                yield batch(schema, [at], *([x] for x in merged_parts(parts)))
                parts = []
            at = k
            parts.append(part.as_py())
    if parts:
        yield batch(schema, [at], *([x] for x in merged_parts(parts)))


# ---- seating -------------------------------------------------------------------------


@lru_cache(maxsize=4)
def _stirling(discount: float) -> np.ndarray:
    """log S(c, t), c and t up to 64: S(c+1, t) = S(c, t-1) + (c - discount * t) * S(c, t)."""
    s = np.full((_EXACT + 1, _EXACT + 1), -np.inf)
    s[0, 0] = 0
    t = np.arange(_EXACT + 1)
    for c in range(_EXACT):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = s[c] + np.log(np.maximum(c - discount * t, 0))
        s[c + 1, 1:] = np.logaddexp(stay[1:], s[c, :-1])
    return s


def sample_tables(c: np.ndarray, p: np.ndarray, total: np.ndarray, discount: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with ``c`` customers, parent probability ``p``, in restaurants with ``total`` other tables."""
    t = np.minimum(c, 1).astype(np.int64)
    logs, first = _stirling(discount), np.minimum(c, _EXACT)
    for n in np.unique(first[first > 1]).tolist():
        rows = np.flatnonzero(first == n)
        for s in range(0, len(rows), 1 + 2_000_000 // n):
            at = rows[s : s + 1 + 2_000_000 // n]
            ladder = np.log(p[at])[:, None] + np.log(strength + discount * (total[at][:, None] + np.arange(n)))
            weight = np.cumsum(ladder, axis=1) + logs[n, 1 : n + 1]
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            t[at] = 1 + (weight < (rng.random(len(at)) * weight[:, -1])[:, None]).sum(axis=1)
    more = np.flatnonzero(c > _EXACT)
    if len(more):
        pull = (strength + discount * (total[more] + t[more])) * p[more]
        seated = np.maximum(_EXACT - discount * t[more], 0.5)
        t[more] = np.minimum(c[more], t[more] + rng.poisson(pull * np.log((c[more] - discount * t[more]) / seated)))
    return t


class Cells:
    """The cells of a bucket, sorted by context and word, with what the whole model says of their contexts and words."""

    def __init__(self, blob: bytes):
        us, lengths, ws, self.word, c = unpacked(blob)
        self.contexts, self.words = np.cumsum(us, dtype=np.uint64), np.cumsum(ws, dtype=np.uint64)
        self.of, self.c = np.repeat(np.arange(len(us)), lengths), c.astype(np.int64)

    def by_word(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, x, len(self.words)).astype(np.int64)

    def by_context(self, x: np.ndarray, split: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Sums of ``x`` over each cell's restaurant; those of split contexts are given."""
        rank = rank_in(self.contexts, split)
        own = np.bincount(self.of, x, len(self.contexts))
        own[rank >= 0] = whole[rank[rank >= 0]]
        return own[self.of]

    def told(self, replies: dict[int, list[np.ndarray]], slices: int, column: int = 0) -> np.ndarray:
        """What the owners of the words answered, in the order of the words."""
        out = np.zeros(len(self.words))
        out[np.argsort(share_of(self.words, slices), kind="stable")] = np.concatenate([replies[k][column] for k in sorted(replies)])
        return out


def root_probability(open_, total, vocabulary: int):
    """``open_``: customers less discounted tables of a word in the parent; ``total``: the parent's customers and tables."""
    return (open_ + (ROOT_STRENGTH + ROOT_DISCOUNT * total[1]) / (vocabulary + 1)) / (ROOT_STRENGTH + total[0])


def predictive(c, t, parent, tables, in_context):
    return (c - DISCOUNT * t + (STRENGTH + DISCOUNT * tables) * parent) / (STRENGTH + in_context)


_MADE = "bucket int, slice int, body binary, at array<long>, n array<double>"
_MADE_ROWS = pa.schema([("bucket", pa.int32()), ("slice", pa.int32()), ("body", pa.binary()), ("at", pa.list_(pa.int64())), ("n", pa.list_(pa.float64()))])


def _news(rows) -> tuple[dict, dict]:
    """(tables, replies) by sweep out of a bucket's (sweep, slice, body) rows; slice -1 holds tables."""
    tables, replies = {}, {}
    for r in rows:
        if r["slice"] < 0:
            tables[r["sweep"]] = unpacked(r["body"])[0].astype(np.int64)
        else:
            replies.setdefault(r["sweep"], {})[r["slice"]] = unpacked(r["body"])
    return tables, replies


def _seat(sweep: int, slices: int, vocabulary: int, shipped):
    """A sweep over the restaurants. Rows: (bucket, -1, tables), (bucket, slice, message), sums of split contexts and frequent cells."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, split, whole, total = shipped.value
        sums: dict[int, float] = {}
        for b in batches:
            for row in b.to_pylist():
                cells = Cells(row["cells"])
                if sweep:
                    tables, replies = _news(row["news"])
                    t = tables[sweep - 1]
                    p = root_probability(cells.told(replies[sweep - 1], slices), total, vocabulary)
                    others = np.maximum(cells.by_context(t, split, whole) - t, 0)
                    t = sample_tables(cells.c, p[cells.word], others, DISCOUNT, STRENGTH, np.random.default_rng([sweep, row["bucket"]]))
                else:
                    t = np.minimum(cells.c, 1)
                of_words = [cells.by_word(t)] + ([] if sweep else [cells.by_word(cells.c)])
                owner = share_of(cells.words, slices)
                order = np.argsort(owner, kind="stable")
                starts, lengths = _runs(owner[order])
                groups = [order[s : s + m] for s, m in zip(starts.tolist(), lengths.tolist())]
                bodies = [packed(_small(t)), *(packed(_steps(cells.words[g]), *(_small(x[g]) for x in of_words)) for g in groups)]
                some = [-1, *(int(owner[g[0]]) for g in groups)]
                yield batch(_MADE_ROWS, [row["bucket"]] * len(some), some, bodies, [None] * len(some), [None] * len(some))
                rank = rank_in(cells.contexts, split)[cells.of]
                at = np.flatnonzero(rank >= 0)
                for k, x in enumerate(np.bincount(rank[at], t[at], len(split)).tolist()):
                    if x:
                        sums[k] = sums.get(k, 0) + x
                u, w = rank_in(cells.contexts, frequent)[cells.of], rank_in(cells.words, frequent)[cells.word]
                at = np.flatnonzero((u >= 0) & (w >= 0))
                for k, x in zip((len(split) + u[at] * len(frequent) + w[at]).tolist(), (t if sweep else cells.c)[at].tolist()):
                    sums[k] = x  # a cell is in one bucket
        if sums:
            yield batch(_MADE_ROWS, [None], [None], [None], [list(sums)], [list(map(float, sums.values()))])

    return make


def _answer(sweep: int, vocabulary: int, shipped):
    """The parent's tables of the words of a slice. Rows: (bucket, slice, reply), sums of customers and tables, frequent words."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, tables = shipped.value
        at, told = None, []

        def answer():
            words = [np.cumsum(x[0], dtype=np.uint64) for _, x in told]
            cuts = np.cumsum([0, *map(len, words)])
            ws, of = np.unique(np.concatenate(words), return_inverse=True)
            c1, *counts = (np.bincount(of, np.concatenate([x[k] for _, x in told]), len(ws)).astype(np.int64) for k in range(1, len(told[0][1])))
            t1 = np.minimum(c1, 1)
            if sweep:
                others = np.full(len(ws), max(tables - 1, 0))
                t1 = sample_tables(c1, np.full(len(ws), 1 / (vocabulary + 1)), others, ROOT_DISCOUNT, ROOT_STRENGTH, np.random.default_rng([sweep, at, 1]))
            open_ = c1 - ROOT_DISCOUNT * t1
            replies = [packed(open_[of[a:z]].astype(np.float32), *(_small(x[of[a:z]]) for x in counts)) for a, z in zip(cuts[:-1], cuts[1:])]
            rank = rank_in(ws, frequent)
            some = np.flatnonzero(rank >= 0)
            yield batch(_MADE_ROWS, [k for k, _ in told], [at] * len(told), replies, [None] * len(told), [None] * len(told))
            yield batch(_MADE_ROWS, [None], [None], [None], [[0, 1, *(2 + rank[some]).tolist()]], [[float(c1.sum()), float(t1.sum()), *open_[some].tolist()]])

        for b in batches:
            for bucket, k, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if k != at and told:
                    yield from answer()
                    told = []
                at = k
                told.append((bucket, unpacked(body.as_py())))
        if told:
            yield from answer()

    return make


def _score(groups: int, slices: int, vocabulary: int, tokens: int, shipped):
    """Rows (doc_group, first, part): the packed sums of a group of documents over the buckets of a task, ``first`` being one of them."""
    schema = pa.schema([("doc_group", pa.int32()), ("first", pa.int32()), ("part", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, split_counts, whole, totals = shipped.value
        held: list[tuple] = []
        bucket = None

        for b in batches:
            for row in b.to_pylist():
                cells, bucket = Cells(row["cells"]), row["bucket"]
                m, doc, n, ids = unpacked(row["postings"])
                ids, doc = np.cumsum(ids, dtype=np.int64), doc.astype(np.int64)
                tables, replies = _news(row["news"])
                in_context, mean = cells.by_context(cells.c, split, split_counts), np.zeros(len(cells.c))
                for s in range(BURN_IN + 1, SWEEPS + 1):
                    parent = root_probability(cells.told(replies[s], slices), totals[s], vocabulary)[cells.word]
                    mean += predictive(cells.c, tables[s], parent, cells.by_context(tables[s], split, whole[s]), in_context)
                score = np.log10(mean / (SWEEPS - BURN_IN))
                count = cells.told(replies[0], slices, 1)[cells.word]
                base = np.log10((count + 0.5) / (tokens + 0.5 * (vocabulary + 1)))
                each = np.repeat(np.arange(len(m)), m)
                if len(ids):
                    held.append((ids, *(np.bincount(doc, n * x[each], len(ids)) for x in ((count > 0).astype(np.int64), base, score))))
                if sum(len(h[0]) for h in held) > 1_000_000:  # documents of several buckets meet here before they travel
                    held = [merged_sums(held)]
                    if len(held[0][0]) > 700_000:
                        yield from pack_sums(schema, held[0], groups, bucket)
                        held = []
        if held:
            yield from pack_sums(schema, merged_sums(held), groups, bucket)

    return make


def merged_sums(held: list[tuple]) -> tuple:
    """(ids, known, base, score) with one entry per id."""
    ids, where = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    return (ids, *(np.bincount(where, np.concatenate([h[k] for h in held]), len(ids)) for k in (1, 2, 3)))


def pack_sums(schema: pa.Schema, sums: tuple, groups: int, first: int) -> Iterator[pa.RecordBatch]:
    group = (mix(sums[0].view(np.uint64)) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[order], np.arange(groups + 1))
    met = np.flatnonzero(np.diff(cuts)).tolist()
    parts = [zstandard.ZstdCompressor(level=1).compress(b"".join(_planes(x[order[cuts[g] : cuts[g + 1]]]) for x in sums)) for g in met]
    yield batch(schema, met, [first] * len(met), parts)


def _sum_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document out of the packed sums of its group; a task holds one group at a time."""
    schema = pa.schema([("id", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
    at, held = None, []

    def rows():
        ids, known, base, score = merged_sums(held)
        yield batch(schema, ids, known.astype(np.int64), base, score)

    for b in batches:
        for group, cell in zip(b.column(0).to_pylist(), b.column(2)):
            if group != at and held:
                yield from rows()
                held = []
            data = zstandard.ZstdDecompressor().decompress(cell.as_py())
            n, place, columns = len(data) // 32, 0, []
            for kind in (np.int64, np.float64, np.float64, np.float64):
                x, place = _unplanes(data, place, n, kind)
                columns.append(x)
            at = group
            held.append(tuple(columns))
            if sum(len(h[0]) for h in held) > 400_000:
                held = [merged_sums(held)]
    if held:
        yield from rows()


def _score_frequent(shipped):
    """What documents can score where they are: their token number and the cells of two frequent words."""
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, base, score = shipped.value
        hashes = WordHashes()
        for b in batches:
            rows = []
            for cell in b.column(1):
                words = word_ids(hashes, cell.as_py())
                rank = rank_in(words, frequent)
                before = np.append(rank[-1:], rank[:-1])
                both = (rank >= 0) & (before >= 0)
                rows.append((len(words), int(both.sum()), float(base[rank[both]].sum()), float(score[before[both], rank[both]].sum(dtype=np.float64))))
            yield batch(schema, b.column(0), *map(list, zip(*rows)))

    return make


def _summed(made: DataFrame, size: int) -> np.ndarray:
    """The sums that tasks gave beside their rows; their number is bounded by the split and frequent words."""
    rows = made.filter("at is not null").select(F.explode(F.arrays_zip("at", "n")).alias("x")).groupBy("x.at").agg(F.sum("x.n").alias("n")).toPandas()
    out = np.zeros(size)
    out[rows["at"].to_numpy(np.int64)] = rows["n"]
    return out


def score_texts(docs: DataFrame, bucket_bytes: int = 6 << 20, frequent_share: int = FREQUENT) -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (id long, body binary, learn boolean).

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one end mark. ``learn``
    marks the training texts; null counts as false. base_score sums
    log10((c + 0.5) / (N + 0.5 * (V + 1))) over the tokens, score the log10 of the averaged
    predictive probabilities. Null and empty texts are the end mark alone. Rows that repeat an
    id each count for training and share one sum: the sum is divided by their number, so equal
    rows have their own score. A null id is an id like others. Without training texts every
    probability is that of one unseen word. An empty table gives no rows. A bucket holds about
    ``bucket_bytes`` of text; one task works on one bucket at a time. Words with 1 / ``frequent_share``
    of the tokens count as frequent, which says where cells are scored and not how.
    """
    spark = docs.sparkSession
    ship = spark.sparkContext.broadcast
    low = -(1 << 63)
    docs = docs.select(F.coalesce("id", F.lit(low)).alias("id"), "body", F.coalesce("learn", F.lit(False)).alias("learn"))
    counts = stored(word_counts(docs.filter("learn").select("id", "body")), "word-counts")
    size = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    vocabulary, tokens = int(size.v), int(size.n)
    text_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("b")).first().b
    buckets = max(32, math.ceil(text_bytes / bucket_bytes))
    groups, slices = max(8, buckets // 3), max(8, buckets // 32)
    top = counts.filter(F.col("n") * max(frequent_share, buckets) >= tokens).toPandas()  # shares add up to 1, so at most that many rows
    top["word"] = top["word"].to_numpy(np.int64).view(np.uint64)
    top = top.sort_values("word")
    split, split_counts = top["word"].to_numpy(np.uint64), top["n"].to_numpy(np.int64)
    common = split_counts * frequent_share >= tokens
    frequent, frequent_counts = split[common], split_counts[common]
    k = len(frequent)

    name, folder = f"pitman_yor_{uuid.uuid4().hex}", shared_folder(spark, "buckets")
    parts = docs.mapInArrow(_postings(frequent, split, buckets), "bucket int, part binary").repartition(groups, "bucket").sortWithinPartitions("bucket")
    made = parts.mapInArrow(_merge_buckets, "bucket int, cells binary, postings binary")
    made.write.bucketBy(groups, "bucket").option("path", folder).saveAsTable(name)  # what sweeps bring is shuffled to the buckets, which stay
    whole, totals, cells, opened, news, folders = {0: None}, {0: (0.0, 0.0)}, {}, {}, {}, [folder]

    def with_news(columns: list[str], sweeps: list[int]) -> DataFrame:
        rows = None
        for s in sweeps:
            rows = news[s] if rows is None else rows.unionByName(news[s])
        rows = rows.repartition(groups, "bucket").groupBy("bucket").agg(F.collect_list(F.struct("sweep", "slice", "body")).alias("news"))
        return spark.table(name).select("bucket", *columns).join(rows.hint("merge"), "bucket")

    for s in range(SWEEPS + 1):
        rows = with_news(["cells"], [s - 1]) if s else spark.table(name).select("bucket", "cells")
        shipped = ship((frequent, split, whole.get(s - 1), totals.get(s - 1)))
        seated, at = held(rows.mapInArrow(_seat(s, slices, vocabulary, shipped), _MADE), "seats")
        told = seated.filter("slice >= 0").select("bucket", "slice", "body").repartition(min(slices, groups), "slice").sortWithinPartitions("slice", "bucket")
        answered, at_root = held(told.mapInArrow(_answer(s, vocabulary, ship((frequent, totals[max(s - 1, 0)][1]))), _MADE), "parents")
        folders += [at, at_root]
        sums, root = _summed(seated, len(split) + k * k), _summed(answered, 2 + k)
        whole[s], cells[s], totals[s], opened[s] = sums[: len(split)], sums[len(split) :].reshape(k, k), (root[0], root[1]), root[2:]
        both = seated.filter("slice < 0").unionByName(answered.filter("slice >= 0"))
        news[s] = both.select(F.lit(s).alias("sweep"), "bucket", "slice", "body")

    own, mean = np.flatnonzero(common), np.zeros((k, k))
    for s in range(BURN_IN + 1, SWEEPS + 1):
        parent = root_probability(opened[s], totals[s], vocabulary)
        mean += predictive(cells[0], cells[s], parent[None, :], whole[s][own][:, None], frequent_counts[:, None])
    with np.errstate(divide="ignore"):
        log_frequent = np.log10(mean / (SWEEPS - BURN_IN)).astype(np.float32)
    log_base = np.log10((frequent_counts + 0.5) / (tokens + 0.5 * (vocabulary + 1)))

    # the first answers carry the words' counts, the later ones the parents of the sweeps kept
    kept = list(range(BURN_IN + 1, SWEEPS + 1))
    news[0] = news[0].filter("slice >= 0")
    scored = with_news(["cells", "postings"], [0, *kept]).mapInArrow(_score(groups, slices, vocabulary, tokens, ship((split, split_counts, whole, totals))), "doc_group int, first int, part binary")
    rare = stored(scored.repartition(groups, "doc_group").sortWithinPartitions("doc_group", "first").mapInArrow(_sum_groups, "id long, known long, base double, score double"), "rare-scores")
    spark.sql(f"DROP TABLE {name}")
    for at in folders:
        removed(spark, at)
    local = docs.select("id", "body").mapInArrow(_score_frequent(ship((frequent, log_base, log_frequent))), "id long, n_tokens long, known long, base double, score double")
    both = rare.select("id", F.lit(0).cast("long").alias("n_tokens"), "known", "base", "score", F.lit(0).alias("rows")).unionByName(local.withColumn("rows", F.lit(1)))
    summed = both.groupBy("id").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "known", "base", "score", "rows")))
    one = summed.select(
        F.nullif(F.col("id"), F.lit(low)).alias("id"), *((F.col(c) / F.col("rows")).cast(kind).alias(n) for c, n, kind in (("n_tokens", "n_tokens", "long"), ("known", "n_known", "long"))),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") / F.col("rows")).alias("base_score"), (F.col("score") / F.col("rows")).alias("score"), "rows",
    )
    return one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).drop("copy", "rows")


def perplexity(score, n_tokens):
    """Of texts with a log10 probability: 10 ** (-score / tokens)."""
    return F.pow(F.lit(10.0), -F.sum(score) / F.sum(n_tokens))
