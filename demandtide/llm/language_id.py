"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character n-grams. Document frequencies are
counted over all training rows in Spark; the weights are fitted on a bounded,
documented sample by follow-the-regularised-leader with elastic-net penalties
(its L1 part keeps the weights sparse), and one temperature is fitted on held-back
rows of that sample. Prediction streams over all rows with the model broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from demandtide.llm.storage import stored
from demandtide.llm.words import batch

UNKNOWN = "und"
BROADCAST_LANGUAGES = 10_000


@dataclass(frozen=True)
class Settings:
    """``sample`` is the bound on fitting rows of each language; everything else sees all rows."""

    features: int = 1 << 15
    longest: int = 3
    sample: int = 600
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-4
    calibration: float = 0.2


@dataclass(frozen=True)
class Model:
    """Bounded by features x languages."""

    settings: Settings
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray = field(repr=False)
    bias: np.ndarray = field(repr=False)
    temperature: float = 1.0


_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def gram_counts(text: str, settings: Settings) -> np.ndarray:
    """Counts of the hashed 1..longest-grams of the lower-cased text, runs of other characters than letters as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letter_table()[points], points, np.uint32(32))
    space = points == 32
    points = points[~(space & np.concatenate(([True], space[:-1])))] if len(points) else points
    h, out = np.zeros(len(points), np.uint32), np.zeros(settings.features, np.int64)
    shift = np.uint32(32 - settings.features.bit_length() + 1)
    with np.errstate(over="ignore"):
        for n in range(1, settings.longest + 1):
            if len(points) < n:
                break
            h = h[: len(points) - n + 1] * np.uint32(0x01000193) ^ points[n - 1 :]
            out += np.bincount((h * np.uint32(0x9E3779B1)) >> shift, minlength=settings.features)
    return out


def _vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt(values @ values)
    return at, values / norm if norm else values


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _document_frequency(train: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """Over all training rows; a task sends one row per feature that it met."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(settings.features, np.int64), 0
        for b in batches:
            for text in b.column(0):
                seen += gram_counts(text.as_py(), settings) > 0
                rows += 1
        at = np.flatnonzero(seen)
        yield batch(pa.schema([("feature", pa.int64()), ("n", pa.int64())]), np.concatenate(([-1], at)), np.concatenate(([rows], seen[at])))

    counted = train.select("text").mapInArrow(partial, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    found = dict(zip(counted.feature, counted.n))
    rows, df = int(found.pop(-1, 0)), np.zeros(settings.features)
    df[list(map(int, found))] = list(found.values())
    return df, rows


def _sample(train: DataFrame, key: str, settings: Settings) -> DataFrame:
    """About ``sample`` rows of each language, chosen by a hash of the key; no ordering and no group is gathered."""
    counts = stored(train.groupBy("lang").agg(F.count("*").alias("of")), "language-counts")
    if counts.count() <= BROADCAST_LANGUAGES:  # a join on the language itself would put a common one into one task
        counts = F.broadcast(counts)
    mark = F.pmod(F.xxhash64(F.lit("language sample"), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return train.withColumn("mark", mark).join(counts, "lang").filter(F.col("mark") < settings.sample / F.col("of")).select("mark", "lang", "text")


def _fit(idf: np.ndarray, settings: Settings):
    """One task fits the bounded sample; rows: a feature's weights for all languages, -1 the bias, -2 the temperature."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted({(m, lang, text) for b in batches for m, lang, text in zip(*(c.to_pylist() for c in b.columns))})
        if not rows:
            return
        languages = sorted({lang for _, lang, _ in rows})
        code = {lang: k for k, lang in enumerate(languages)}
        data = [(*_vector(gram_counts(text, settings), idf), code[lang]) for _, lang, text in rows]
        order = np.random.default_rng(7).permutation(len(data))
        held = int(settings.calibration * len(data))
        calibrate, learn = [data[k] for k in order[:held]], [data[k] for k in order[held:]]
        width = len(languages)
        z, n = np.zeros((settings.features + 1, width)), np.zeros((settings.features + 1, width))

        def leader(at: np.ndarray) -> np.ndarray:
            zz, l1 = z[at], np.where(at == settings.features, 0, settings.l1)[:, None]
            return -np.sign(zz) * np.maximum(np.abs(zz) - l1, 0) / ((settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2)

        shuffle = np.random.default_rng(11)
        for _ in range(settings.epochs):
            for k in shuffle.permutation(len(learn)):
                at, x, y = learn[k]
                at, x = np.append(at, settings.features), np.append(x, 1.0)
                w = leader(at)
                slope = _softmax(x @ w)
                slope[y] -= 1
                g = x[:, None] * slope
                z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / settings.alpha * w
                n[at] += g * g
        w = leader(np.arange(settings.features + 1))
        temperature = 1.0
        if calibrate and width > 1:
            logits = np.stack([x @ w[at] + w[-1] for at, x, _ in calibrate])
            truth = np.array([y for *_, y in calibrate])
            grid = np.exp(np.linspace(np.log(0.01), np.log(1000), 300))
            target = np.full((len(truth), width), 1 / (len(truth) + 2) / (width - 1))  # as Platt: never quite certain, so T stays finite
            target[np.arange(len(truth)), truth] = 1 - 1 / (len(truth) + 2)
            losses = [-np.mean(np.sum(target * np.log(_softmax(logits / t) + 1e-12), axis=1)) for t in grid]
            temperature = float(grid[int(np.argmin(losses))])
        kept = np.flatnonzero(np.any(w[:-1] != 0, axis=1))
        out = [(int(k), w[k].tolist(), None) for k in kept] + [(-1, w[-1].tolist(), languages), (-2, [temperature], None)]
        yield batch(pa.schema([("feature", pa.int64()), ("weights", pa.list_(pa.float64())), ("languages", pa.list_(pa.string()))]), *map(list, zip(*out)))

    return fit


def train_model(train: DataFrame, key: str = "doc_id", settings: Settings = Settings()) -> Model:
    """Model from ``train`` (key, text, lang); rows without letters or language are left out. Without any row it knows no language."""
    rows = train.select(key, "text", "lang").filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    df, total = _document_frequency(rows, settings)
    idf = np.log((1 + total) / (1 + df)) + 1
    fitted = _sample(rows, key, settings).repartition(1).mapInArrow(_fit(idf, settings), "feature long, weights array<double>, languages array<string>").collect()
    if not fitted:
        return Model(settings, [], idf, np.zeros((settings.features, 0)), np.zeros(0))
    by = {r.feature: r for r in fitted}
    languages, weights = list(by[-1].languages), np.zeros((settings.features, len(by[-1].languages)))
    for feature, row in by.items():
        if feature >= 0:
            weights[feature] = row.weights
    return Model(settings, languages, idf, weights, np.array(by[-1].weights), by[-2].weights[0])


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and score (probability of lang_pred), from the text alone.

    A null text, a text without a letter and a model without languages give ``und``
    with score 0. Ties go to the first language in order. All other columns and
    repeated rows stay; columns that already have the new names are replaced.
    """
    base = df.drop("lang_pred", "score")
    schema = base.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    shipped = df.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b in batches:
            names, scores = [], []
            for cell in b.column(b.schema.get_field_index(text)):
                counts = None
                if m.languages and (body := cell.as_py()) and any(map(str.isalpha, body)):
                    counts = gram_counts(body, m.settings)
                if counts is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at, x = _vector(counts, m.idf)
                p = _softmax((x @ m.weights[at] + m.bias) / m.temperature)
                best = int(np.argmax(p))
                names.append(m.languages[best])
                scores.append(float(min(1.0, p[best])))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*b.schema.names, "lang_pred", "score"])

    return base.mapInArrow(label, schema)


def accepted(df: DataFrame, model: Model, min_score: float = 0.3, text: str = "text") -> DataFrame:
    """Rows of ``df``, columns unchanged, whose text is in a known language with a calibrated probability of ``min_score`` or more."""
    marked = predict(df.select(F.struct("*").alias("row"), F.col(text).alias("body")), model, "body")
    return marked.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")
