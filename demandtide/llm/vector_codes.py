"""Vector code compression: codebooks per part, fitted and applied through metric trees.

Components become integers, a vector is cut into equal parts, and each part position
has a codebook. Rows are held in chunks; for every part position of a chunk there is
one metric tree over that part of its rows, built once by the anchors hierarchy: about
sqrt(n) anchors steal points from each other, the anchors' balls are merged upwards in
pairs (middle-out), and large anchors are split again in the same way downwards. A ball
caches count, sum, centre and radius. To assign a part, a ball inherits the list of
entries that may still own points from the ball above it, strikes out those that the
centre's nearest entry beats everywhere in the ball, and passes the rest on; a ball with
one entry left is wholly owned and adds its cached sum and count. Only points in leaves
with several entries left are compared one by one. All comparisons that decide are in
integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from demandtide.llm.storage import stored
from demandtide.llm.words import lists

CHUNK = 2048
LEAF = 32
#: Integer components stay below this, so that squared distances of 4096 of them fit into 64 bits.
LARGEST = 1 << 24


@dataclass(frozen=True)
class Tree:
    """``order``: the rows, so that every ball is a range of it; per ball its range, children (-1: leaf), centre, sum and squared radius."""

    order: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    left: np.ndarray
    right: np.ndarray
    centre: np.ndarray
    total: np.ndarray
    reach: np.ndarray


def _square(a: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=-1)


def _anchors(points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """Rows by owner of up to ``wanted`` anchors; each new anchor is the point furthest from its own and takes what is nearer to it."""
    owner, far = np.zeros(len(points), np.int64), _square(points - points[0])
    at, count = [0], 1
    while count < wanted:
        new = int(np.argmax(far))
        if not far[new]:
            break
        between = _square(points[at] - points[new])
        seek = np.flatnonzero(4 * far > between[owner])  # others are within half the distance of their anchor and cannot be nearer to the new one
        near = _square(points[seek] - points[new])
        taken = near < far[seek]
        owner[seek[taken]], far[seek[taken]] = count, near[taken]
        at.append(new)
        count += 1
    rows = np.argsort(owner, kind="stable")
    return np.split(rows, np.cumsum(np.bincount(owner, minlength=count))[:-1])


def grow(points: np.ndarray) -> Tree:
    """Metric tree over the rows of ``points`` (64-bit integers, one row at least)."""
    children: list[tuple[int, int]] = []
    leaves: dict[int, np.ndarray] = {}

    def node(left: int, right: int) -> int:
        children.append((left, right))
        return len(children) - 1

    def build(rows: np.ndarray) -> int:
        if len(rows) <= LEAF or len(groups := _anchors(points[rows], int(np.ceil(np.sqrt(len(rows)))))) == 1:
            leaves[at := node(-1, -1)] = rows
            return at
        # middle-out: the anchors' balls are merged in the order of the ball that holds both
        balls = [build(rows[g]) for g in groups]
        centre = np.array([points[rows[g]].mean(axis=0) for g in groups])
        size = np.array([len(g) for g in groups], np.float64)
        reach = np.array([np.sqrt(_square(points[rows[g]] - c).max()) for g, c in zip(groups, centre)])
        wide = _wider(centre[:, None], reach[:, None], centre[None], reach[None])
        np.fill_diagonal(wide, np.inf)
        for _ in range(len(balls) - 1):
            a, b = divmod(int(np.argmin(wide)), len(balls))
            balls[a] = node(balls[a], balls[b])
            reach[a] = wide[a, b]
            centre[a] = (size[a] * centre[a] + size[b] * centre[b]) / (size[a] + size[b])
            size[a] += size[b]
            wide[b], wide[:, b] = np.inf, np.inf
            near = _wider(centre[a], reach[a], centre, reach)
            near[np.isinf(wide[a])] = np.inf
            near[a] = np.inf
            wide[a], wide[:, a] = near, near
        return balls[a]

    root = build(np.arange(len(points)))
    n, width = len(children), points.shape[1]
    start, stop, order, filled = np.zeros(n, np.int64), np.zeros(n, np.int64), [], 0
    pending = [(root, False)]
    while pending:
        at, done = pending.pop()
        if done:
            stop[at] = filled
            continue
        start[at] = filled
        pending.append((at, True))
        if at in leaves:
            order.append(leaves[at])
            filled += len(leaves[at])
        else:
            pending += [(children[at][1], False), (children[at][0], False)]
    order = np.concatenate(order)
    sums = np.concatenate((np.zeros((1, width), np.int64), np.cumsum(points[order], axis=0)))
    total = sums[stop] - sums[start]
    centre = total // (stop - start)[:, None]
    of = np.repeat(np.arange(n), stop - start)
    first = np.cumsum(stop - start) - (stop - start)
    inside = points[order[np.arange(len(of)) - first[of] + start[of]]]
    reach = np.maximum.reduceat(_square(inside - centre[of]), first)
    links = np.array(children, np.int64)
    down = np.lexsort((-stop, start))  # parents before their children; a ball and its first child differ in their end
    rank = np.empty(n, np.int64)
    rank[down] = np.arange(n)
    left, right = (np.where(links[down, k] < 0, -1, rank[links[down, k]]) for k in (0, 1))
    return Tree(order, start[down], stop[down], left, right, centre[down], total[down], reach[down])


def _wider(c1, r1, c2, r2):
    """Radius of the smallest ball around two balls."""
    return np.maximum(np.maximum(r1, r2), (np.sqrt(_square(c1 - c2)) + r1 + r2) / 2)


def descend(tree: Tree, points: np.ndarray, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(balls, their owners) as ("owned") and (rows, their entries) as ("seen"), covering every row once; nearest entry, ties to the lower index."""
    apart = np.sqrt(_square(entries[:, None] - entries[None]).astype(np.float64)) * (2 * (1 + 1e-9))
    first = np.array([not any((entries[k] == entries[j]).all() for j in range(k)) for k in range(len(entries))])  # an equal entry of higher index owns nothing
    balls, alive = np.zeros(1, np.int64), first[None].copy()
    never = np.iinfo(np.int64).max
    while len(balls):
        away = np.where(alive, _square(tree.centre[balls][:, None] - entries[None]), never)
        best = away.argmin(axis=1)
        # entry c loses to the best one at every x with |x - centre| <= r if d2(centre, c) - d2(centre, best) > 2 r |c - best|
        lead = np.where(alive, away, 0) - away[np.arange(len(balls)), best][:, None]
        alive &= ~(lead > np.sqrt(tree.reach[balls].astype(np.float64))[:, None] * apart[best] + 1e-6)
        whole = alive.sum(axis=1) == 1
        if whole.any():
            yield "owned", balls[whole], best[whole]
        leaf = ~whole & (tree.left[balls] < 0)
        if leaf.any():
            at = balls[leaf]
            sizes = tree.stop[at] - tree.start[at]
            of = np.repeat(np.arange(len(at)), sizes)
            rows = tree.order[np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + tree.start[at][of]]
            point, entry = np.nonzero(alive[leaf][of])
            d = _square(points[rows[point]] - entries[entry])
            starts = np.flatnonzero(np.r_[True, point[1:] != point[:-1]])
            least = np.repeat(np.minimum.reduceat(d, starts), np.diff(np.r_[starts, len(point)]))
            yield "seen", rows, np.minimum.reduceat(np.where(d == least, entry, len(entries)), starts)
        down = ~whole & ~leaf
        at = balls[down]
        balls, alive = np.r_[tree.left[at], tree.right[at]], np.r_[alive[down], alive[down]]


# ---- the chunks as a stored table

_SHAPES = (("order", np.int32, "int"), ("start", np.int32, "int"), ("stop", np.int32, "int"), ("left", np.int32, "int"), ("right", np.int32, "int"), ("centre", np.int64, "long"), ("total", np.int64, "long"), ("reach", np.int64, "long"))


def _chunks(parts: int, scale: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                rows = b.slice(at, CHUNK)
                n = rows.num_rows
                flat = np.floor(np.asarray(rows.column(2).flatten(), np.float64) * scale)
                if np.abs(flat).max(initial=0) >= LARGEST:
                    raise ValueError(f"a component times {scale} is {LARGEST} or more")
                ints = flat.astype(np.int64).reshape(n, parts, -1)
                trees = [grow(np.ascontiguousarray(ints[:, p])) for p in range(parts)]
                whole = pa.array([0, n], pa.int32())
                columns = [pa.ListArray.from_arrays(whole, rows.column(k)) for k in (0, 1)]
                columns += [lists([ints.astype(np.int32).ravel()], pa.int32()), lists([np.array([len(t.start) for t in trees], np.int32)], pa.int32())]
                columns += [lists([np.concatenate([getattr(t, f).ravel() for t in trees]).astype(kind)], pa.from_numpy_dtype(kind)) for f, kind, _ in _SHAPES]
                yield pa.RecordBatch.from_arrays(columns, names=["ids", "labels", "ints", "balls", *(f for f, *_ in _SHAPES)])

    return make


def _read(b: pa.RecordBatch, k: int, parts: int) -> tuple[np.ndarray, list[Tree]]:
    """Rows (row, part, component) and trees of the chunk in line ``k``."""
    cell = {name: b.column(j)[k].values for j, name in enumerate(b.schema.names) if name not in ("ids", "labels")}
    ints = np.asarray(cell["ints"], np.int64).reshape(len(b.column(b.schema.get_field_index("ids"))[k].values), parts, -1)
    balls, trees, width = np.asarray(cell["balls"]), [], ints.shape[2]
    arrays = {f: np.asarray(cell[f], np.int64) for f, *_ in _SHAPES}
    ends = np.concatenate(([0], np.cumsum(balls)))
    for p in range(parts):
        lo, hi = ends[p], ends[p + 1]
        trees.append(Tree(
            arrays["order"][p * len(ints) : (p + 1) * len(ints)], *(arrays[f][lo:hi] for f in ("start", "stop", "left", "right")),
            *(arrays[f][lo * width : hi * width].reshape(-1, width) for f in ("centre", "total")), arrays["reach"][lo:hi],
        ))
    return ints, trees


def _smallest(limit: int):
    """The rows of the ``limit`` smallest ids that a task meets; of rows with one id the one of the smallest components."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[int]] = {}
        for b in batches:
            for ids, ints in zip(b.column(0), b.column(1)):
                keys, values = ids.values, np.asarray(ints.values)
                keys, known = np.asarray(keys.fill_null(0), np.int64), np.asarray(keys.is_valid())
                values = values.reshape(len(keys), -1)
                edge = np.sort(np.unique(keys[known]))[:limit]
                for k in np.flatnonzero(known & (keys <= (edge[-1] if len(edge) else 0))):
                    row, key = values[k].tolist(), int(keys[k])
                    if key not in best or row < best[key]:
                        best[key] = row
                for key in sorted(best)[limit:]:
                    del best[key]
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int64()), pa.array(list(best.values()), pa.list_(pa.int32()))], names=["id", "ints"])

    return pick


def _tally(books: np.ndarray):
    """A task's sums and counts by part and entry."""
    parts, entries, width = books.shape

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for b in batches:
            for k in range(b.num_rows):
                ints, trees = _read(b, k, parts)
                for p, tree in enumerate(trees):
                    points = np.ascontiguousarray(ints[:, p])
                    for kind, at, entry in descend(tree, points, books[p]):
                        np.add.at(n[p], entry, tree.stop[at] - tree.start[at] if kind == "owned" else 1)
                        np.add.at(sums[p], entry, tree.total[at] if kind == "owned" else points[at])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]), lists(list(sums[part, entry]), pa.int64())],
            names=["part", "entry", "n", "sums"],
        )

    return tally


def _encode(books: np.ndarray):
    """vec_id, label, code, error of every row."""
    parts = len(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                ints, trees = _read(b, k, parts)
                code = np.zeros((len(ints), parts), np.uint8)
                for p, tree in enumerate(trees):
                    for kind, at, entry in descend(tree, np.ascontiguousarray(ints[:, p]), books[p]):
                        if kind == "owned":
                            for ball, e in zip(at, entry):
                                code[tree.order[tree.start[ball] : tree.stop[ball]], p] = e
                        else:
                            code[at, p] = entry
                error = _square(ints - books[np.arange(parts)[None], code]).sum(axis=1)
                text = code.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[k].values, b.column(1)[k].values, pa.array([text[j : j + 2 * parts] for j in range(0, len(text), 2 * parts)], pa.string()), pa.array(error)],
                    names=["vec_id", "label", "code", "error"],
                )

    return encode


def _sound(vec: Column) -> Column:
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def vector_codes(df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every vector that has a code.

    Dropped are rows whose vector is null, empty or holds null or non-finite
    components, whose length ``parts`` does not divide, or whose length is not that of
    the smallest remaining key (they have no parts to compare). A component times
    ``scale`` must stay below 2**24, else the task raises. Codebooks start at the vectors
    of the ``entries`` (256 at most) smallest distinct keys, fewer if there are fewer; of
    rows with one key the smallest vector. Null keys start no entry and are coded like
    others; repeated rows stay. Ties go to the lower index. Null labels are one group
    of their own in label_error. An empty table gives no rows.

    The driver holds the codebooks only (parts x entries x width integers). Tasks send
    one sum a part and entry. Labels with a 1024th of the rows, 1024 at most, meet
    their error by a broadcast, all others by a join.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits a part")
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vec"))
    rows = rows.filter(_sound(F.col("vec")) & (F.size("vec") > 0) & (F.size("vec") % parts == 0))
    size = rows.agg(F.min(F.struct(F.col("id").isNull(), "id", F.size("vec"))).alias("m")).select("m.*").first()[2]
    if size is None:
        empty = df.sparkSession.createDataFrame([], T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", df.schema[label].dataType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]))
        return empty.select("*", F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    kind = rows.schema["label"].dataType.simpleString()
    shape = f"ids array<long>, labels array<{kind}>, ints array<int>, balls array<int>, " + ", ".join(f"{f} array<{t}>" for f, _, t in _SHAPES)
    chunks = stored(rows.filter(F.size("vec") == size).mapInArrow(_chunks(parts, scale), shape), "vector-chunks")
    seeds = chunks.select("ids", "ints").mapInArrow(_smallest(entries), "id long, ints array<int>")
    seeds = seeds.groupBy("id").agg(F.min("ints").alias("ints")).orderBy("id").limit(entries).collect()
    width = size // parts
    books = np.array([r.ints for r in seeds], np.int64).reshape(-1, parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(seeds) else 0):
        sums = chunks.mapInArrow(_tally(books), "part int, entry int, n long, sums array<long>").groupBy("part", "entry").agg(F.sum("n"), *(F.sum(F.col("sums")[k]) for k in range(width)))
        for part, entry, n, *total in sums.collect():
            books[part, entry] = [t // n for t in total]
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = stored(chunks.mapInArrow(_encode(books), f"vec_id long, label {kind}, code string, error long"), "vector-codes") if len(seeds) else rows.select(F.col("id").alias("vec_id"), "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    return with_label_error(coded).withColumn("codebooks_sha256", F.lit(digest))


def with_label_error(coded: DataFrame, share: int = 1024) -> DataFrame:
    """label_error: ``error`` summed over equal labels, nulls together. Only labels with less than one row in ``share`` are shuffled."""
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows")), "label-errors")
    bound = (sums.agg(F.sum("rows")).first()[0] or 0) / share
    common = F.broadcast(sums.filter(F.col("rows") > bound).select(F.col("label").alias("of"), F.col("label_error").alias("common_error"), F.lit(True).alias("common")))  # at most ``share`` rows
    met = coded.join(common, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    rare = sums.filter(F.col("rows") <= bound).select(F.col("label").alias("of"), F.col("label_error"))
    columns = ["vec_id", "label", "code", "error"]
    own = met.filter("common is null").drop("common", "common_error").join(rare, F.col("label").eqNullSafe(F.col("of"))).select(*columns, "label_error")
    return met.filter("common").select(*columns, F.col("common_error").alias("label_error")).unionByName(own)
