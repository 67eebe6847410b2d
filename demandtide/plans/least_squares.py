"""Linear forecasts of all horizons and origins from one scan.

A least-squares fit needs nothing of its rows but the sums of products of their
columns. They are summed once by group, horizon and step of the origins; a fit is then
a small system that an executor solves from a difference of running sums. Hundreds of
fits cost one pass over the table and one over the rows that are forecast, whatever
the number of origins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from demandtide.functions.periods import ym_to_idx
from demandtide.session import written

#: Up to so many products a row they are summed as columns; wider matrices are multiplied in batches.
WIDEST = 64
#: Groups that a task sums up before it passes them on.
HELD = 4096


def _pairs(width: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(width) for j in range(i, width)]


def _array_sums(df: DataFrame, by: Sequence[str], x: Column, width: int) -> DataFrame:
    """``by`` and ``sums`` as ``product_sums`` gives them, of the ``width`` entries of an array; batches are multiplied, their sums add up."""
    keys = df.select(*by).schema
    rows = df.select(F.struct(*by).alias("key") if by else F.struct(F.lit(0).alias("_")).alias("key"), x.alias("x"))
    upper = np.triu_indices(width)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        kind = None

        def out() -> pa.RecordBatch:
            sums = pa.array([m[upper] for m in held.values()], pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([pa.array([dict(k) for k in held], kind), sums], names=["key", "sums"])

        for b in batches:
            kind = b.column(0).type
            x = np.asarray(b.column(1).flatten()).reshape(b.num_rows, -1)
            place: dict[tuple, int] = {}
            of = np.fromiter((place.setdefault(tuple(k.items()), len(place)) for k in b.column(0).to_pylist()), np.int64, b.num_rows)
            order = np.argsort(of, kind="stable")
            for key, rows_ in zip(place, np.split(order, np.cumsum(np.bincount(of, minlength=len(place)))[:-1])):
                own = x[rows_].T @ x[rows_]
                held[key] = held[key] + own if key in held else own
            if len(held) > HELD:
                yield out()
                held = {}
        if held:
            yield out()

    parts = rows.mapInArrow(multiply, f"key {rows.schema['key'].dataType.simpleString()}, sums array<double>")
    summed = parts.select("key", F.posexplode("sums").alias("at", "v")).groupBy("key", "at").agg(F.sum("v").alias("v"))
    packed = summed.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("s"))
    return packed.select(*[F.col("key")[c].alias(c) for c in keys.names], F.transform("s", lambda e: e["v"]).alias("sums"))


def product_sums(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``by`` and ``sums``: over a group's rows, the sums of all products of two of 1 and ``columns`` (null: 0), upper triangle by rows.

    Sums are partial before their shuffle, so a group with a third of the rows is spread out.
    """
    values = [F.lit(1.0), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]]
    pairs = _pairs(len(values))
    if len(pairs) <= WIDEST:
        return df.groupBy(*by).agg(F.array(*[F.sum(values[i] * values[j]) for i, j in pairs]).alias("sums"))
    return _array_sums(df, by, F.array(*values), len(values))


def _system(sums: np.ndarray, width: int, ridge: float) -> tuple[float, list[float]]:
    """Intercept and weights from the sums of products of 1, ``width`` features and the target; of many solutions the shortest."""
    m = np.zeros((width + 2, width + 2))
    m[np.triu_indices(width + 2)] = sums
    m = m + np.triu(m, 1).T
    n, mean = m[0, 0], m[0, 1:] / m[0, 0]
    centred = m[1:, 1:] - n * np.outer(mean, mean)
    own, cross = centred[:-1, :-1] + ridge * np.eye(width), centred[:-1, -1]
    scale = np.sqrt(np.maximum(np.diag(own), 0))
    scale[scale < 1e-7 * np.sqrt(np.maximum(np.diag(m)[1:-1], 1e-300))] = np.inf  # a constant feature has no weight
    w = np.linalg.lstsq(own / np.outer(scale, scale), cross / scale, rcond=1e-10)[0] / scale
    return float(mean[-1] - w @ mean[:-1]), w.tolist()


def origin_fits(
    table: DataFrame, by: Sequence[str], features: Sequence[str], target: str, origins: Sequence[int], ridge: float = 0.0, months: int | None = None
) -> DataFrame:
    """``by``, horizon, date_when_predicting, n_rows, intercept, weights: one fit per group, horizon and origin (yyyymm).

    A fit learns from rows whose target month is known at its origin and, with
    ``months``, not older than so many months. Rows without a target are left out, null
    features are zero. ``ridge`` penalises the weights and not the intercept. Fits without a row are
    left out. The steps between origins are summed in one pass; fits are differences of
    their running sums.
    """
    at = {o: o // 100 * 12 + o % 100 for o in sorted(set(origins))}
    edges = sorted({*at.values(), *([m - months for m in at.values()] if months else [])})
    target_month = ym_to_idx("date_to_predict")
    step = F.array_min(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e >= target_month))
    known = table.filter(F.col(target).isNotNull()).withColumn("_step", step).filter(F.col("_step").isNotNull())
    keys = [*by, "horizon"]
    sums = product_sums(known, [*keys, "_step"], [*features, target])
    # one row a group and horizon, as many entries as there are steps
    steps = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_step", "sums"))).alias("steps"))
    schema = steps.select(*keys).schema
    width = len(features)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, dates, counts, bases, weights = [], [], [], [], []
            for k in range(b.num_rows):
                cell = b.column(len(keys))[k].as_py()
                running = dict.fromkeys(edges)
                total = np.zeros(len(_pairs(width + 2)))
                own = {s["_step"]: np.array(s["sums"]) for s in cell}
                for e in edges:
                    total = running[e] = total + own.get(e, 0.0)
                for date, m in at.items():
                    use = running[m] - (running[m - months] if months else 0.0)
                    if use[0] < 0.5:
                        continue
                    base, w = _system(use, width, ridge)
                    rows.append(k)
                    dates.append(date)
                    counts.append(round(use[0]))
                    bases.append(base)
                    weights.append(w)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(j).take(take) for j in range(len(keys))), pa.array(dates, pa.int32()), pa.array(counts, pa.int64()), pa.array(bases, pa.float64()), pa.array(weights, pa.list_(pa.float64()))],
                names=[*keys, "date_when_predicting", "n_rows", "intercept", "weights"],
            )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return steps.mapInArrow(solve, f"{ddl}, date_when_predicting int, n_rows long, intercept double, weights array<double>")


def linear_prediction(features: Sequence[str]) -> Column:
    """Value of a fit's ``intercept`` and ``weights`` on a row, not below zero."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    value = F.aggregate(F.zip_with("weights", x, lambda w, v: w * v), F.col("intercept"), lambda s, v: s + v)
    return F.greatest(value, F.lit(0.0))


def linear_backtest(
    table: DataFrame, keys: Sequence[str], features: Sequence[str], origins: Sequence[int], horizons: Sequence[int], by: Sequence[str] = (),
    ridge: float = 0.0, months: int | None = None, target: str = "target",
) -> DataFrame:
    """Direct forecasts of all origins and horizons, each from what was known at its origin.

    One fit per group of ``by``, horizon and origin. The fits are stored, a few rows a
    group, so that the planner chooses their join by their size. Rows whose group has no
    fit have no forecast.
    """
    rows = table.filter(F.col("horizon").isin(list(horizons)))
    fits = written(origin_fits(rows, by, features, target, origins, ridge, months), "fits")
    at = rows.filter(F.col("date_when_predicting").isin(list(origins)))
    on = [*by, "horizon", "date_when_predicting"]
    scored = at.join(fits, on).withColumn("prediction", linear_prediction(features))
    return scored.select(*keys, "date_when_predicting", "date_to_predict", "horizon", target, "prediction", "n_rows")


def linear_forecast(
    table: DataFrame, keys: Sequence[str], features: Sequence[str], cutoff: int, horizons: Sequence[int], by: Sequence[str] = (), ridge: float = 0.0, target: str = "target"
) -> DataFrame:
    """``linear_backtest`` of one origin."""
    return linear_backtest(table, keys, features, [cutoff], horizons, by, ridge, None, target)


def train_test_rmse(table: DataFrame, features: Sequence[str], cutoff: int, horizons: Sequence[int], by: Sequence[str] = (), ridge: float = 0.0, target: str = "target") -> DataFrame:
    """``by``, horizon, n_train, rmse_train, n_test, rmse_test: fits on target months up to the cutoff, errors on both sides of it.

    All horizons are fitted from one scan and scored in another; predictions are not clipped here.
    """
    known = table.filter(F.col("horizon").isin(list(horizons)) & F.col(target).isNotNull())
    fits = written(origin_fits(known, by, features, target, [cutoff], ridge).drop("date_when_predicting", "n_rows"), "fits")
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    made = F.aggregate(F.zip_with("weights", x, lambda w, v: w * v), F.col("intercept"), lambda s, v: s + v)
    scored = known.join(fits, [*by, "horizon"]).select(*by, "horizon", (F.col("date_to_predict") <= cutoff).alias("_train"), F.pow(made - F.col(target), 2).alias("_e"))
    sides = [(F.col("_train"), "train"), (~F.col("_train"), "test")]
    return scored.groupBy(*by, "horizon").agg(*[c for side, name in sides for c in (F.count_if(side).alias(f"n_{name}"), F.sqrt(F.avg(F.when(side, F.col("_e")))).alias(f"rmse_{name}"))])


def month_arrays(facts: DataFrame, axis: Sequence[int], keys: Sequence[str], month: str, value: str) -> DataFrame:
    """``keys`` and ``value`` as ``dense_series`` gives them over ``axis``, filled in batches: a row a series, null and missing months zero."""
    monthly = facts.dropna(subset=[*keys, month]).groupBy(*keys, month).agg(F.sum(value).alias("v"))
    packed = monthly.groupBy(*keys).agg(F.collect_list(F.struct(F.col(month).cast("int").alias("m"), F.coalesce(F.col("v").cast("double"), F.lit(0.0)).alias("v"))).alias("e"))
    months = np.array(axis)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            entries = b.column(len(keys))
            flat, n = entries.flatten(), len(months)
            row = np.repeat(np.arange(b.num_rows), np.diff(entries.offsets.to_numpy()))
            cells = np.zeros(b.num_rows * n)
            cells[row * n + np.searchsorted(months, flat.field(0).to_numpy())] = flat.field(1).to_numpy()
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * n, pa.int32()), pa.array(cells))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(keys))), arrays], names=[*keys, value])

    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in packed.select(*keys).schema)
    return packed.mapInArrow(fill, f"{ddl}`{value}` array<double>")


def series_backtest(
    facts: DataFrame, axis: Sequence[int], keys: Sequence[str], month: str, value: str, lags: Sequence[int], origins: Sequence[int], horizons: Sequence[int],
    by: Sequence[str] = (), ridge: float = 0.0, months: int | None = None,
) -> DataFrame:
    """``linear_backtest`` where the features are the ``lags`` of the series itself, without a row per origin and horizon to learn from.

    ``facts`` hold ``keys``, ``month`` and ``value``; ``axis`` all their months (indices, ascending).
    Lag 1 is the origin month, lags before the axis are zero. What a fit sums
    are products of two months of one series, so a group's sums of products of all
    months, once, hold the sums of every fit: their size is the square of the calendar. Only the rows that are
    forecast are made, a row a series, origin and horizon. Series are stored.
    """
    place = {m: k for k, m in enumerate(axis)}
    at = {o: o // 100 * 12 + o % 100 for o in sorted(set(origins))}
    held = written(month_arrays(facts, axis, keys, month, value), "series")
    sums = _array_sums(held, by, F.concat(F.array(F.lit(1.0)), value), len(axis) + 1)
    width, zero = len(lags), len(axis) + 1
    spans = {h: np.array([(p, place[m + h]) for m, p in place.items() if m + h in place], np.int64).reshape(-1, 2) for h in horizons}
    named = len(by)
    schema = sums.select(*by).schema

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.triu_indices(width + 2)
        for b in batches:
            made = []
            for k in range(b.num_rows):
                m = np.zeros((zero + 1, zero + 1))  # the last row and column stand for months before the axis
                m[:zero, :zero][np.triu_indices(zero)] = b.column(named)[k].values.to_numpy()
                m = m + np.triu(m, 1).T
                for h, span in spans.items():
                    target = np.array([axis[q] for q in span[:, 1]], np.int64)
                    for date, o in at.items():
                        p, q = span[(target <= o) & (target > (o - months if months else -1))].T
                        of = [np.zeros_like(p), *[np.where(p - lag + 1 >= 0, p - lag + 2, zero) for lag in lags], q + 1]
                        use = np.array([m[of[i], of[j]].sum() for i, j in zip(*upper)])
                        if use[0] >= 0.5:
                            made.append((k, h, date, round(use[0]), *_system(use, width, ridge)))
            take, h, date, n, base, w = zip(*made) if made else ((),) * 6
            types = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(j).take(pa.array(take, pa.int64())) for j in range(named)), *(pa.array(c, t) for c, t in zip((h, date, n, base, w), types))],
                names=[*by, "horizon", "date_when_predicting", "n_rows", "intercept", "weights"],
            )

    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in schema)
    fits = written(sums.mapInArrow(solve, f"{ddl}horizon int, date_when_predicting int, n_rows long, intercept double, weights array<double>"), "fits")
    ym = lambda m: (m - 1) // 12 * 100 + (m - 1) % 12 + 1
    # a position outside the axis has no entry
    wanted = [
        F.struct(
            F.lit(date).alias("date_when_predicting"), F.lit(ym(o + h)).alias("date_to_predict"), F.lit(h).alias("horizon"), F.lit(place.get(o + h, -1)).alias("_target"),
            F.array(*[F.lit(place[o] - lag + 1) for lag in lags]).alias("_lags"),
        )
        for date, o in at.items() if o in place for h in horizons
    ]
    if not wanted:
        raise ValueError(f"no origin of {list(origins)} is a month of the data")
    rows = held.select(*keys, value, F.explode(F.array(*wanted)).alias("_w")).select(
        *keys, "_w.date_when_predicting", "_w.date_to_predict", "_w.horizon", F.get(value, F.col("_w._target")).alias("target"),
        *[F.get(value, F.col("_w._lags")[k]).alias(f"_x{k}") for k in range(width)],
    )
    scored = rows.join(fits, [*by, "horizon", "date_when_predicting"]).withColumn("prediction", linear_prediction([f"_x{k}" for k in range(width)]))
    return scored.select(*keys, "date_when_predicting", "date_to_predict", "horizon", "target", "prediction", "n_rows")
