"""Near-duplicate vectors by a subspace pigeonhole join.

For unit vectors, cosine >= t means squared distance <= 2 - 2t. A rotation keeps
distances and spreads them evenly over the coordinates; the rotated vector is cut
into low-dimensional blocks. If every block were further apart than its share of
the squared distance (in proportion to its dimensions), the whole would be too, so
a linked pair is within budget in one block at least. Each block is range-joined on
a grid over its first coordinates; the union of the candidates is verified exactly
on the original vectors in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from demandtide.llm.components import components
from demandtide.llm.storage import stored

WIDTH = 8


def rotation(dim: int) -> np.ndarray:
    """Fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(20_000 + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, dim, block, x0..x7) of every vector's rotated unit vector; the last block may be padded with zeros."""
    turned: dict[int, np.ndarray] = {}
    for b in batches:
        ids, groups, vectors = (b.column(k) for k in range(3))
        sizes = np.array([len(v) for v in vectors])
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            v = np.array([vectors[int(k)].as_py() for k in at], np.float64)
            v /= np.abs(v).max(axis=1, keepdims=True)
            v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
            dim = int(dim)
            if dim not in turned:
                turned[dim] = rotation(dim)
            n = -(-dim // WIDTH)
            x = np.zeros((len(at), n * WIDTH))
            x[:, :dim] = v @ turned[dim]
            x = x.reshape(len(at) * n, WIDTH)
            take = pa.array(np.repeat(at, n))
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), groups.take(take), pa.array(np.tile(np.arange(n, dtype=np.int32), len(at))), pa.array(np.full(len(x), dim, np.int32)), *(pa.array(x[:, k].copy()) for k in range(WIDTH))],
                names=["id", "grp", "block", "dim", *(f"x{k}" for k in range(WIDTH))],
            )


def candidate_pairs(vectors: DataFrame, least: float, rows: int) -> DataFrame:
    """Distinct (a, b), a < b, of ``vectors`` (id, grp, vec) within the budget of a block at least.

    The grid has about log4(rows) - 3 coordinates, so that the rows of a cell stay few as
    the table grows; which pairs come out does not depend on it. A vector is at home
    in one cell of a block and looks into every cell that its ball touches.
    """
    total = 2 - 2 * least
    axes = max(2, min(WIDTH, int(math.log(max(rows, 2), 4)) - 3))
    blocks = vectors.mapInArrow(_blocks, "id long, grp long, block int, dim int, " + ", ".join(f"x{k} double" for k in range(WIDTH)))
    share = F.least(F.lit(WIDTH), F.col("dim") - F.col("block") * WIDTH) / F.col("dim")
    blocks = stored(blocks.withColumn("budget", total * share + 1e-9), "vector-blocks")
    radius = F.sqrt("budget")
    step = 3 * radius
    keys = ["grp", "block", *(f"c{k}" for k in range(axes))]
    home = blocks.select("*", *(F.floor(F.col(f"x{k}") / step).alias(f"c{k}") for k in range(axes)))
    looks = blocks
    for k in range(axes):
        x = F.col(f"x{k}")
        looks = looks.withColumn(f"c{k}", F.explode(F.sequence(F.floor((x - radius) / step), F.floor((x + radius) / step))))
    a, b = home.alias("a"), looks.drop("budget", "dim").alias("b")
    distance = sum((F.col(f"a.x{k}") - F.col(f"b.x{k}")) * (F.col(f"a.x{k}") - F.col(f"b.x{k}")) for k in range(WIDTH))
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    on = same[0]
    for extra in [*same[1:], F.col("a.id") < F.col("b.id"), distance <= F.col("a.budget")]:
        on = on & extra
    return a.join(b, on).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def near_vectors(df: DataFrame, least: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row: linked are rows of equal label with cosine >= ``least``.

    Null or zero vectors, vectors with null or non-finite components, null labels and
    null keys link with nothing (n_links 0, component_id the row's own key, kept).
    Vectors of different length never link. Identical vectors of a label are compared
    once, as one class with its size, and count each other as links; a repeated row is a
    vector of its own. An empty table gives no rows.
    """
    doubles = F.col("vec").cast("array<double>")
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vec"))
    valid = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)))
    classes = stored(valid.groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "vector-classes")
    reps = classes.select(F.col("rep").alias("id"), F.xxhash64("label", F.size("vec")).alias("grp"), doubles.alias("vec"))
    pairs = candidate_pairs(reps, least, classes.count())
    norm = F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda s, x: s + x * x))
    sized = classes.select("rep", "label", "vec", "n", norm.alias("norm"))
    a, b = (sized.select(*(F.col(c).alias(f"{s}_{c}") for c in sized.columns)) for s in "ab")
    dot = F.aggregate(F.zip_with(F.col("a_vec").cast("array<double>"), F.col("b_vec").cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    links = pairs.join(a, F.col("a") == F.col("a_rep")).join(b, F.col("b") == F.col("b_rep"))
    links = links.filter((F.col("a_label") == F.col("b_label")) & (dot / (F.col("a_norm") * F.col("b_norm")) >= least)).select("a", "b", "a_n", "b_n")
    links = stored(links, "vector-links")
    reached = links.select(F.col("a").alias("rep"), F.col("b_n").alias("m")).unionByName(links.select(F.col("b").alias("rep"), F.col("a_n").alias("m")))
    counts = reached.groupBy("rep").agg(F.sum("m").alias("others"))
    found = classes.join(counts, "rep", "left").join(components(links.select("a", "b")).withColumnRenamed("id", "rep"), "rep", "left")
    found = found.select(
        "label", "vec", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    linked = valid.join(found, ["label", "vec"], "left").select("id", "n_links", "component_id")
    apart = rows.filter(~(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(apart).select(F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
