"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets and star-shaped candidates.

One pass over the texts makes each document's set of word shingles, a digest of the
set and the band keys of its signature. Documents with equal sets are one class,
stood for by its smallest id. Inside a bucket every member is paired with one centre
only, so pairs are bounded by bands times documents; pairs are confirmed on full sets.
Two members can be alike without being like their centre: what stands in buckets that
still hold several components then is joined across components by an exact prefix
join, so that no link is lost to the stars.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from demandtide.llm.components import components
from demandtide.llm.storage import stored
from demandtide.llm.words import WordHashes, batch, lists, mix, narrow, shingles

BINS, ROWS = 128, 4
_EDGES = (np.arange(BINS, dtype=np.uint64) << np.uint64(57))


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words; with fewer words the whole sequence is one."""
    return np.unique(shingles(words, n))


def signature(members: np.ndarray) -> np.ndarray:
    """One-permutation MinHash: the smallest hash in each of 128 ranges. An empty range takes the value of the range that
    its own probe sequence (the same for all documents) meets first, which keeps every position an unbiased minimum."""
    at = np.searchsorted(members, _EDGES)
    end = np.append(at[1:], len(members))
    out, empty = members[np.minimum(at, len(members) - 1)], at == end
    if empty.any():
        filled = np.flatnonzero(~empty)
        if len(filled) == 1:
            return np.full(BINS, members[at[filled[0]]])
        open_, tried = np.flatnonzero(empty), 0
        while len(open_):
            tried += 1
            with np.errstate(over="ignore"):
                probe = (mix(open_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tried)) >> np.uint64(57)).astype(np.int64)
            hit = ~empty[probe]
            out[open_[hit]] = members[at[probe[hit]]]
            open_ = open_[~hit]
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        rows = sig.reshape(-1, ROWS)
        h = mix(np.arange(len(rows), dtype=np.uint64) + np.uint64(1))
        for k in range(ROWS):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return h.astype(np.int64)


def sketch(sig: np.ndarray) -> np.ndarray:
    """One bit of every position, as two longs."""
    return np.packbits((sig & np.uint64(1)).astype(np.uint8)).view(np.int64)


def _digest(members: np.ndarray) -> bytes | None:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest() if len(members) else None


def _signed(n: int):
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("keys", pa.list_(pa.int64())), ("s0", pa.int64()), ("s1", pa.int64())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, none = WordHashes(), np.empty(0, np.int64)
        for b in batches:
            sizes, digests, keys, bits = [], [], [], np.zeros((len(b), 2), np.int64)
            for k, body in enumerate(b.column(1)):
                members = shingle_set(hashes.of(body.as_py()), n)
                sizes.append(len(members))
                digests.append(_digest(members))
                keys.append(none)
                if len(members):
                    sig = signature(members)
                    keys[-1], bits[k] = band_keys(sig), sketch(sig)
            yield batch(schema, b.column(0), sizes, digests, lists(keys, pa.int64()), bits[:, 0].copy(), bits[:, 1].copy())

    return sign


def _sets(n: int):
    """(id, members) of the texts (id, body, want) whose set has the digest ``want``."""
    schema = pa.schema([("id", pa.int64()), ("members", pa.list_(pa.int64()))])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for start in range(0, len(b), 256):  # long texts: a bounded part at a time
                part = b.slice(start, 256)
                found = [shingle_set(hashes.of(t.as_py()), n) for t in part.column(1)]
                at = [k for k, (m, want) in enumerate(zip(found, part.column(2))) if _digest(m) == want.as_py()]
                yield batch(schema, part.column(0).take(pa.array(at, pa.int64())), lists([found[k].view(np.int64) for k in at], pa.int64()))

    return make


def _plausible(percent: int) -> Column:
    """Whether a_n, b_n, a_s0 ... allow ``percent``: sizes within the bound, and no more unequal sketch bits than six standard
    deviations above the mean at that similarity, for as many independent positions as the smaller set can fill."""
    p = (1 - percent / 100) / 2
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    unequal = F.bit_count(F.col("a_s0").bitwiseXOR(F.col("b_s0"))) + F.bit_count(F.col("a_s1").bitwiseXOR(F.col("b_s1")))
    return (100 * small >= percent * large) & (unequal <= BINS * (p + 6 * F.sqrt(p * (1 - p) / F.least(F.lit(BINS), small))))


def _side(reps: DataFrame, side: str) -> DataFrame:
    return reps.select(F.col("id").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("n", "s0", "s1")))


def _confirmed(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on their full sets. Sets grow with the corpus, so they are joined by the same shuffle at every size."""
    pairs = stored(pairs.distinct().join(_side(reps, "a"), "a").join(_side(reps, "b"), "b").filter(_plausible(percent)).select("a", "b"), f"{name}-pairs")
    centres = stored(sets.join(pairs.select(F.col("a").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("a"), F.col("members").alias("a_set")), f"{name}-sets")
    met = pairs.hint("merge").join(sets.select(F.col("id").alias("b"), F.col("members").alias("b_set")), "b").join(centres.hint("merge"), "a")
    both = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - both
    return stored(met.filter(100 * both >= percent * union).select("a", "b").distinct(), f"{name}-links")


def _prefix_pairs(sets: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """All (a, b) of ``parts`` (id, part) in different parts that can reach ``percent``: an exact prefix join.

    Shingles are ordered from rare to frequent. Two sets of that similarity share a
    shingle among the first n - ceil(percent / 100 * n) + 1 of each, and what follows the
    first shared place must be enough for the overlap they need; a copy with too many
    shingles of its own has none but those in front and meets nobody.
    """
    held = stored(sets.join(parts, "id"), "split-sets")
    tokens = held.select("id", F.explode("members").alias("token"))
    often = stored(tokens.groupBy("token").agg(F.count("*").alias("often")), "shingle-counts")
    ordered = tokens.join(often, "token").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("tokens"))
    n = F.size("tokens")
    prefix = ordered.select("id", n.alias("n"), F.posexplode(F.slice("tokens", 1, n - F.ceil(n * percent / 100).cast("int") + 1)).alias("at", "x")).filter("x.often > 1")
    prefix = stored(prefix.join(parts, "id").select("id", "part", "n", "at", F.col("x.token").alias("token")), "prefixes")
    a, b = (prefix.select("token", *(F.col(c).alias(f"{side}_{c}") for c in ("id", "part", "n", "at"))) for side in "ab")
    overlap = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    enough = (100 + percent) * overlap >= percent * (F.col("a_n") + F.col("b_n"))
    met = a.join(b, "token").filter((F.col("a_id") < F.col("b_id")) & (F.col("a_part") != F.col("b_part")) & enough)
    return met.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()


def minhash_dedup(df: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a set holds the distinct
    ``n``-word shingles, with fewer words the whole sequence as one. Linked are documents
    with 100 * intersection >= ``percent`` * union. Null and wordless texts have an empty
    set and link with nothing; rows with a null key link with nothing, have a null
    component and are kept. Rows that repeat a key are one document: of different texts
    the one whose set has the smallest digest speaks for it, in any order of the rows. An
    empty table gives no rows.
    """
    texts = narrow(df, key, text)
    signed = stored(texts.mapInArrow(_signed(n), "id long, n_shingles long, digest binary, keys array<long>, s0 long, s1 long"), "signatures")
    sound = signed.filter("id is not null and digest is not null")
    classes = stored(sound.groupBy("digest").agg(F.min("id").alias("rep")), "digests")  # stored: the join can then split a frequent digest
    is_rep = F.col("id") == F.col("rep")
    members = stored(sound.join(classes, "digest").select("id", "rep", "digest", F.col("n_shingles").alias("n"), F.when(is_rep, F.col("keys")).alias("keys"), "s0", "s1"), "classes")
    reps = members.filter("keys is not null").groupBy("id").agg(F.min_by(F.struct("n", "keys", "s0", "s1"), "digest").alias("r")).select("id", "r.*")
    rows = reps.select("id", F.explode("keys").alias("bucket"))
    centres = rows.groupBy("bucket").agg(F.min("id").alias("centre"), F.max("id").alias("last")).filter("centre < last").drop("last")
    crowded = stored(rows.join(centres, "bucket"), "buckets")
    reps = reps.select("id", "n", "s0", "s1")
    # the texts of crowded buckets are read once more, for their full sets; the same join at every size, as both sides grow with the corpus
    chosen = members.filter("keys is not null").groupBy("id").agg(F.min("digest").alias("want"))
    wanted = chosen.join(crowded.select("id").distinct(), "id", "left_semi")
    made = texts.join(wanted.hint("merge"), "id").mapInArrow(_sets(n), "id long, members array<long>")
    sets = stored(made.dropDuplicates(["id"]), "shingle-sets")  # one row per id: a repeated row must not count its shingles twice

    # stars: one centre for all buckets of a group, so that the pairs of different buckets are the same pairs
    links = _confirmed(crowded.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")), reps, sets, percent, "star")
    # members of buckets that hold several components even then: an exact join between components
    placed = crowded.join(components(links), "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("part"))
    several = placed.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("bucket")
    parts = stored(placed.join(several, "bucket", "left_semi").select("id", "part").distinct(), "split")
    links = links.unionByName(_confirmed(_prefix_pairs(sets, parts, percent), reps, sets, percent, "across"))

    final = components(links).withColumnRenamed("id", "rep")
    placed = members.select("id", "rep").distinct().join(final, "rep", "left").select("id", F.coalesce("component", "rep").alias("component"))
    placed = placed.groupBy("id").agg(F.min("component").alias("component"))
    out = signed.select("id", "n_shingles").join(placed, "id", "left")
    return out.select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "id").alias("component_id"), F.coalesce(F.col("component").isNull() | (F.col("id") == F.col("component")), F.lit(True)).alias("kept")
    )
