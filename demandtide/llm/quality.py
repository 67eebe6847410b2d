"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text, no negatives: the classifier minimises the
non-negative unbiased risk

    prior * E_positive[l(g)] + max(0, E_unlabelled[l(-g)] - prior * E_positive[l(-g)])

with the logistic loss l and a linear g over character statistics. The class prior is
estimated first: a classifier of positives against unlabelled text ranks a fold that
it did not see, and the share of unlabelled rows above a cut, divided by the share of
positives above it, bounds the prior; the cut with the smallest bound is taken. All
training rows take part in every sum: features are stored once as 512 bytes a document,
and each step of the optimiser is one pass over them whose sums alone reach the driver.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from demandtide.llm.storage import stored
from demandtide.llm.words import batch

ASCII, GRAMS, SHAPES = 128, 352, 31
WIDTH = ASCII + GRAMS + SHAPES
#: A text of so many bytes counts half; what few characters show is little evidence.
HALF = 100
_PIECE = 1 << 20
#: Slopes are whole multiples of this, so that sums over rows do not depend on how the rows are dealt.
_GRID = float(1 << 20)


@dataclass(frozen=True)
class Settings:
    """``fold``: one in so many training rows is kept from the first classifier, for the prior."""

    penalty: float = 0.05
    steps: int = 25
    prior_steps: int = 12
    fold: int = 5
    bins: int = 1000
    risk: float = 0.1
    correction: float = 0.1


@dataclass(frozen=True)
class Model:
    prior: float
    weights: np.ndarray = field(repr=False)
    bias: float = 0.0


def features(body: bytes) -> np.ndarray:
    """512 bytes: square roots of the shares of ASCII bytes and hashed byte 3-grams, and of some counts of words and lines; last, the weight
    of the text, n / (n + ``HALF``) for n bytes."""
    ascii_, grams = np.zeros(256, np.int64), np.zeros(GRAMS, np.int64)
    whole = np.frombuffer(body, np.uint8)
    for at in range(0, len(whole), _PIECE):
        piece = whole[at : at + _PIECE + 2].astype(np.uint32)
        ascii_ += np.bincount(piece[:_PIECE], minlength=256)
        if len(piece) > 2:
            h = (piece[:-2] << np.uint32(16) | piece[1:-1] << np.uint32(8) | piece[2:]) * np.uint32(0x9E3779B1)
            grams += np.bincount((h >> np.uint32(16)) * np.uint32(GRAMS) >> np.uint32(16), minlength=GRAMS)
    n, words, lines = max(len(body), 1), body.split(), body.split(b"\n")
    letters = ascii_[65:91].sum() + ascii_[97:123].sum() + ascii_[128:].sum()
    repeats = sum(map(operator.eq, words, words[1:]))
    shapes = [
        ascii_[128:].sum() / n, ascii_[65:91].sum() / max(letters, 1), letters / n, (ascii_[33:48].sum() + ascii_[58:65].sum() + ascii_[91:97].sum() + ascii_[123:127].sum()) / n,
        repeats / max(len(words), 1), 1 - len(set(words)) / max(len(words), 1), 1 - len(set(lines)) / len(lines), min(1, n / max(len(words), 1) / 40), min(1, np.log10(n) / 8), float(len(words) > 0),
        *(float(len(words) < limit) for limit in (5, 20, 50, 200)),
    ]
    out = np.zeros(WIDTH)
    out[:ASCII] = ascii_[:ASCII] / n
    out[ASCII : ASCII + GRAMS] = grams / max(grams.sum(), 1)
    out[ASCII + GRAMS : ASCII + GRAMS + len(shapes)] = shapes
    return np.append(np.rint(255 * np.sqrt(out)), np.rint(255 * len(body) / (len(body) + HALF))).astype(np.uint8)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("x", pa.binary())])
    for b in batches:
        yield batch(schema, b.column(0), [features(body.as_py() or b"").tobytes() for body in b.column(1)])


def document_features(docs: DataFrame, labels: DataFrame, held_out, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Stored rows (id, x, held_out, positive, fold) of all documents. ``positive``: the key's labels all have quality 1; never set on held-out rows."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").cast("binary").alias("body")).mapInArrow(_featured, "id long, x binary")
    trusted = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg((F.min("quality") == 1).alias("trusted")).filter("trusted")
    held = F.coalesce(held_out(F.col("id")), F.lit(False))
    fold = F.pmod(F.xxhash64(F.lit("prior fold"), "id"), F.lit(settings.fold)) == 0
    met = rows.join(trusted, "id", "left").select("id", "x", held.alias("held_out"), (~held & F.coalesce("trusted", F.lit(False))).alias("positive"), fold.alias("fold"))
    return stored(met, "quality-features")


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    """Features and weight of every row, as whole numbers."""
    return np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(-1, WIDTH + 1).astype(np.float64)


def _weighted(x: np.ndarray) -> np.ndarray:
    """Features times the weight, and the weight."""
    return np.concatenate((x[:, :-1] * x[:, -1:], x[:, -1:]), axis=1)


def _summed(rows: DataFrame, sums) -> np.ndarray:
    """Sums over all rows (x, positive), all rows and positives apart: ``sums`` gives a matrix's one-dimensional sums as whole numbers."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x, positive = _matrix(b), np.asarray(b.column(1).to_numpy(zero_copy_only=False), bool)
                own = np.concatenate((sums(x), sums(x[positive]))).astype(np.int64)
                total = own if total is None else total + own
        if total is not None:
            yield batch(pa.schema([("at", pa.int32()), ("n", pa.int64())]), np.arange(len(total), dtype=np.int32), total)

    found = rows.select("x", "positive").mapInArrow(task, "at int, n long").groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)"))).collect()
    out = np.zeros(len(sums(np.zeros((0, WIDTH + 1)))) * 2)
    for at, n in found:
        out[at] = float(n)
    return out.reshape(2, -1)


def _moments(x: np.ndarray) -> np.ndarray:
    y = _weighted(x)
    return np.concatenate(([len(x)], y.sum(axis=0), (y[:, :-1] * x[:, :-1]).sum(axis=0)))


def _soft(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, g)


def _slopes(weights: np.ndarray, bias: float):
    """Counts, losses l(g) and l(-g), and the sums of sigma(g) and sigma(g) times the weighted features."""

    def sums(x: np.ndarray) -> np.ndarray:
        y = _weighted(x)
        g = y @ weights + bias
        s = np.rint(_GRID / (1 + np.exp(-np.clip(g, -500, 500))))
        return np.concatenate(([len(x), np.rint(_GRID * _soft(-g)).sum(), np.rint(_GRID * _soft(g)).sum(), s.sum()], s @ y))

    return sums


class _Risk:
    """Value and gradient, over all rows, of a risk in the weights of the standardised features (the bias last)."""

    def __init__(self, rows: DataFrame, settings: Settings):
        self.rows, self.settings = rows, settings
        everything, positive = _summed(rows, _moments)
        self.n, self.n_positive = everything[0], positive[0]
        weight = everything[WIDTH + 1]
        if self.n_positive and weight:
            self.mean = everything[1 : WIDTH + 1] / weight
            spread = np.sqrt(np.maximum(everything[WIDTH + 2 :] / weight - self.mean**2, 0))
            self.scale = np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 0) / 255
        else:
            self.mean, self.scale = np.zeros(WIDTH), np.zeros(WIDTH)
        if self.n_positive:
            self.positive_mean = self._standard(positive[1 : WIDTH + 2], positive[0]) / self.n_positive

    def _standard(self, sums: np.ndarray, count: float) -> np.ndarray:
        return np.append((sums[:-1] - sums[-1] * self.mean) * self.scale, count)

    def plain(self, v: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights of the weighted features and the weight, and the bias."""
        w = v[:-1] * self.scale
        return np.append(w, -w @ self.mean), float(v[-1])

    def parts(self, v: np.ndarray):
        """Over all rows: mean of l(-g) and its gradient. Over positives: mean of l(g), of l(-g) and their gradients."""
        sums = _summed(self.rows, _slopes(*self.plain(v)))
        out = [(s[1] / (_GRID * n), s[2] / (_GRID * n), self._standard(s[4:], s[3]) / (_GRID * n)) for s, n in zip(sums, (self.n, self.n_positive))]
        (_, all_minus, all_slope), (plus, minus, slope) = out
        return all_minus, all_slope, plus, slope - self.positive_mean, minus, slope

    def ranking(self, v: np.ndarray):
        """Positives against all rows, each side with half of the weight."""
        all_minus, all_slope, plus, plus_slope, _, _ = self.parts(v)
        return plus + all_minus, plus_slope + all_slope, None

    def non_negative(self, prior: float):
        """The risk; where its second part is negative, the gradient that raises it is returned beside it."""

        def value(v: np.ndarray):
            all_minus, all_slope, plus, plus_slope, minus, minus_slope = self.parts(v)
            rest, rest_slope = all_minus - prior * minus, all_slope - prior * minus_slope
            return prior * plus + max(0.0, rest), prior * plus_slope + rest_slope, rest_slope if rest < 0 else None

        return value


def _descend(risk, start: np.ndarray, steps: int, settings: Settings) -> np.ndarray:
    """Limited-memory quasi-Newton steps; one pass over the rows an evaluation. A step that makes the risk's second part negative is
    followed by a plain step that raises that part, after which the memory starts anew."""

    def evaluate(v):
        f, g, raise_ = risk(v)
        ridge = np.append(v[:-1], 0)
        return f + settings.penalty / 2 * ridge @ ridge, g + settings.penalty * ridge, raise_

    v, memory, step = start, [], 1.0
    f, g, raise_ = evaluate(v)
    for _ in range(steps):
        if raise_ is not None:
            v, memory = v + settings.correction * raise_, []
            f, g, raise_ = evaluate(v)
            continue
        q, stack = g.copy(), []
        for s, y in reversed(memory):
            a = s @ q / (s @ y)
            q -= a * y
            stack.append(a)
        if memory:
            s, y = memory[-1]
            q *= s @ y / (y @ y)
        else:
            q *= min(1.0, 1 / max(np.linalg.norm(q), 1e-12))
        for (s, y), a in zip(memory, reversed(stack)):
            q += s * (a - y @ q / (s @ y))
        if g @ q < 1e-9:
            break
        step = 1.0
        while step > 1e-3:
            f2, g2, raise2 = evaluate(v - step * q)
            if f2 <= f - 1e-4 * step * (g @ q):
                break
            step /= 3
        else:
            break
        s, y = -step * q, g2 - g
        memory = [*memory, (s, y)][-8:] if s @ y > 1e-12 else memory
        v, f, g, raise_ = v + s, f2, g2, raise2
    return v


def estimate_prior(rows: DataFrame, weights: np.ndarray, bias: float, settings: Settings = Settings()) -> float:
    """Share of positives among ``rows`` (x, positive) by the best cut of a ranking that was not fitted on them."""

    def sums(x: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(_weighted(x) @ weights + bias, -500, 500)))
        return np.bincount(np.minimum((p * settings.bins).astype(int), settings.bins - 1), minlength=settings.bins)

    everything, positive = (np.cumsum(c[::-1])[::-1] for c in _summed(rows, sums))
    if not positive[0]:
        return 0.5
    slack = sum(np.sqrt(np.log(4 / settings.risk) / (2 * c[0])) for c in (everything, positive))
    above, of_positive = everything / everything[0], positive / positive[0]
    bound = (above + slack) / np.maximum(of_positive, 1e-9)
    best = int(np.argmin(np.where(positive > 0, bound, np.inf)))
    return float(np.clip(above[best] / of_positive[best], 0.01, 0.99))


def train(rows: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Model from stored feature rows (x, positive, fold): all of them are the unlabelled text, those marked the positives. None without positives."""
    risk = _Risk(rows, settings)
    if not risk.n_positive:
        return None
    first = _Risk(rows.filter("not fold"), settings)
    start, prior = np.zeros(WIDTH + 1), 0.5
    if first.n_positive:
        ranked = _descend(first.ranking, start, settings.prior_steps, settings)
        prior = estimate_prior(rows.filter("fold"), *first.plain(ranked), settings)
    start[-1] = np.log(prior / (1 - prior))  # what a text without evidence gets
    weights, bias = risk.plain(_descend(risk.non_negative(prior), start, settings.steps, settings))
    return Model(prior, weights, bias)


def score(rows: DataFrame, model: Model | None, least: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of feature rows (id, x, held_out)."""
    if model is None:
        scored = rows.select("id", "held_out", F.lit(0.0).alias("score"))
    else:

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                g = _weighted(_matrix(b)) @ model.weights + model.bias
                yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(1 / (1 + np.exp(-np.clip(g, -500, 500))))], names=["id", "held_out", "score"])

        scored = rows.select("x", "id", "held_out").mapInArrow(mark, "id long, held_out boolean, score double")
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out, least: float = 0.7, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= ``least``) of every row of ``docs`` (doc_id, text).

    ``held_out`` is a condition on the key; such rows are scored and never learned from.
    Of ``labels`` (doc_id, quality) only a key whose rows all say 1 counts, as a trusted
    positive; other labels are ignored, and their documents are unlabelled text like the
    rest. Null texts are empty texts and get a score too. A null key is not held out and
    not a positive. Repeated rows stay and count as often; ties cannot arise. Without any
    positive every score is 0; an empty table gives no rows. Other columns are not read.
    """
    rows = document_features(docs, labels, held_out, settings=settings)
    return score(rows, train(rows.filter("not held_out"), settings), least)
