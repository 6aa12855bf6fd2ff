"""Quality classifier: Naive Bayes support vectors over hashed n-gram indicators."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import whole, without

#: Labelled rows of either class that the model is fitted on, at most.
ROWS_PER_CLASS = 3000
#: Parts of those rows that are scored by a model of the others, for calibration.
FOLDS = 3
#: Documents whose score reaches this count as good.
THRESHOLD = 0.7

# Feature space: blocks of indicators, one after another.
_BYTES_2, _BYTES_3, _SHAPES = 1 << 16, 1 << 18, 1 << 18
DIMENSIONS = _BYTES_2 + _BYTES_3 + _SHAPES

_UPPER, _LOWER, _DIGIT, _MARK, _SYMBOL, _WIDE = 1, 2, 4, 8, 16, 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for code in range(33, 127):
        letter = chr(code)
        if letter.isupper():
            table[code] = _UPPER
        elif letter.islower():
            table[code] = _LOWER
        elif letter.isdigit():
            table[code] = _DIGIT
        else:
            table[code] = _MARK if letter in ".,;:'\"!?()-" else _SYMBOL
    table[128:] = _WIDE
    return table


_CLASS = _classes()
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _hashed(values: np.ndarray, size: int) -> np.ndarray:
    return ((values * _MIX) >> np.uint64(40)).astype(np.int64) % size


class _Indicators:
    """Distinct n-gram indicators of one text after another."""

    def __init__(self) -> None:
        self.seen = np.zeros(DIMENSIONS, bool)

    def of(self, text: str) -> np.ndarray:
        """Sorted indices of byte 2- and 3-grams and of word-shape 1- to 3-grams.

        A word's shape is the kinds of its characters, its last byte and whether it
        repeats the word before. Byte grams say what is written, shapes how.
        """
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        parts = []
        if len(raw) >= 2:
            wide = raw.astype(np.uint64)
            pairs = (wide[:-1] << np.uint64(8)) | wide[1:]
            parts.append(pairs.astype(np.int64))
            triples = (pairs[:-1] << np.uint64(8)) | wide[2:]
            parts.append(_BYTES_2 + _hashed(triples, _BYTES_3))
        shapes = self._shapes(raw)
        if len(shapes):
            base = _BYTES_2 + _BYTES_3
            key = shapes
            parts.append(base + _hashed(key + np.uint64(1), _SHAPES))
            for order in (2, 3):
                if len(shapes) < order:
                    break
                key = key[:-1] * np.uint64(1 << 16) + shapes[order - 1 :]
                parts.append(base + _hashed(key * np.uint64(4) + np.uint64(order), _SHAPES))
        if not parts:
            return np.zeros(0, np.int64)
        for part in parts:
            self.seen[part] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found

    @staticmethod
    def _shapes(raw: np.ndarray) -> np.ndarray:
        inside = np.concatenate(([False], ~_SPACE[raw], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return np.zeros(0, np.uint64)
        kinds = np.bitwise_or.reduceat(_CLASS[raw], starts).astype(np.uint64)
        begins = np.zeros(len(raw), np.int64)
        begins[starts] = 1
        place = np.arange(len(raw)) - starts[np.maximum(np.cumsum(begins) - 1, 0)]
        letters = np.where(_SPACE[raw], 0, raw.astype(np.uint64) + np.uint64(1))
        spread = letters * ((place.astype(np.uint64) * _MIX) | np.uint64(1))
        words = np.add.reduceat(spread, starts)
        repeats = np.concatenate(([False], words[1:] == words[:-1])).astype(np.uint64)
        last = raw[ends - 1].astype(np.uint64)
        return (kinds << np.uint64(9)) | (repeats << np.uint64(8)) | last


@dataclass
class Model:
    """Log-count ratios and weights of the indicators, bias, and the logistic calibration.

    A model without ratios (``weights`` of one dimension) scores every text alike.
    """

    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of how often each indicator occurs in either class."""
    counts = np.ones((2, DIMENSIONS))
    for found, label in zip(rows, good, strict=True):
        counts[int(label), found] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, cost: np.ndarray,
    epochs: int, seed: int = 7,
) -> np.ndarray:
    """Weights and, last, the bias of a linear hinge-loss model (Hsieh et al., 2008).

    One dual variable per row between 0 and its cost; each step solves one of them
    exactly and moves the weights along that row.
    """
    weights, alphas = np.zeros(DIMENSIONS + 1), np.zeros(len(rows))
    squares = np.array([float(values @ values) + 1.0 for _, values in rows])
    order, dice = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        dice.shuffle(order)
        moved = 0.0
        for k in order:
            at, values = rows[k]
            slack = signs[k] * (weights[at] @ values + weights[-1]) - 1.0
            new = min(max(alphas[k] - slack / squares[k], 0.0), cost[k])
            step = new - alphas[k]
            if step:
                alphas[k] = new
                weights[at] += step * signs[k] * values
                weights[-1] += step * signs[k]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights


def _calibrate(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins (Platt, 1999)."""
    n_good, n_bad = good.sum(), (~good).sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    weight = np.full(len(good), 1 / len(good))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        error, curve = weight * (p - target), weight * p * (1 - p)
        gradient = np.array([error @ margins, error.sum()])
        hessian = np.array(
            [[curve @ margins**2, curve @ margins], [curve @ margins, curve.sum()]]
        ) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(slope), 1e-3), float(offset)


def fit(texts: list[str], good: np.ndarray, cost: float = 1.0, epochs: int = 30) -> Model:
    """Fit on the given rows; with one class or none the score is constant."""
    if not len(good) or good.all() or not good.any():
        share = 0.5 if not len(good) else float(good[0])
        return Model(np.zeros(DIMENSIONS), 0.0, 0.0, float(np.clip(share * 8 - 4, -4, 4)))
    maker = _Indicators()
    found = [maker.of(t) for t in texts]
    ratios = log_count_ratios(found, good)
    rows = []
    for at in found:
        values = ratios[at]
        rows.append((at, values / (np.sqrt(values @ values) or 1.0)))
    signs = np.where(good, 1.0, -1.0)
    costs = np.where(good, cost / good.mean(), cost / (1 - good.mean())) / 2
    # Calibrated on margins from models that did not see the row.
    margins, fold = np.zeros(len(rows)), np.arange(len(rows)) % FOLDS
    for k in range(FOLDS):
        seen = [r for r, f in zip(rows, fold, strict=True) if f != k]
        part = dual_coordinate_descent(seen, signs[fold != k], costs[fold != k], epochs)
        for i in np.flatnonzero(fold == k):
            at, values = rows[i]
            margins[i] = part[at] @ values + part[-1]
    slope, offset = _calibrate(margins, good)
    weights = dual_coordinate_descent(rows, signs, costs, epochs)
    return Model(np.stack([ratios, weights[:-1]]).astype(np.float32), weights[-1], slope, offset)


def _score(model: Model, maker: _Indicators, text: str) -> float:
    margin = model.bias
    if model.weights.ndim == 2:
        found = maker.of(text)
        if len(found):
            ratios = model.weights[0, found].astype(np.float64)
            norm = np.sqrt(ratios @ ratios) or 1.0
            margin += float(ratios @ model.weights[1, found]) / norm
    return 1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -30, 30)))


def held_out(doc_id: str | Column) -> Column:
    """True for the rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled documents of either class, outside the held-out part.

    Those with the smallest hashes are taken, so the choice is the same on every run.
    """
    open_rows = labels.where(~held_out("doc_id") & F.col("doc_id").isNotNull())
    known = open_rows.groupBy("doc_id").agg(
        F.min("quality").alias("low"), F.max("quality").alias("high")
    ).where("low = high")
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    spread = F.xxhash64("doc_id")
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("low") == value).orderBy(spread, "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    # 2 * per_class rows of two numbers at most: a broadcast of bounded size.
    return (
        docs.select("doc_id", whole("text").alias("text"))
        .join(F.broadcast(chosen.select("doc_id", F.col("low").alias("good"))), "doc_id")
        .dropDuplicates(["doc_id"])
    )


def train(docs: DataFrame, labels: DataFrame, per_class: int = ROWS_PER_CLASS) -> Model:
    """Fit the model on a bounded sample, in one task; the model comes to the driver.

    The sample is ``2 * per_class`` rows and the model ``2 * DIMENSIONS`` floats, however
    large the tables are.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([f for f in frames if len(f)] or [pd.DataFrame(columns=["good"])])
        if len(rows):
            rows = rows.sort_values("doc_id")
            model = fit(rows["text"].tolist(), rows["good"].to_numpy() == 1)
        else:
            model = fit([], np.zeros(0, bool))
        yield pd.DataFrame(
            {
                "weights": [model.weights.astype(np.float32).tobytes()],
                "width": [model.weights.ndim],
                "bias": [float(model.bias)],
                "slope": [model.slope],
                "offset": [model.offset],
            }
        )

    row = (
        training_rows(docs, labels, per_class)
        .repartition(1)
        .mapInPandas(run, "weights binary, width int, bias double, slope double, offset double")
        .first()
    )
    if row is None:
        return fit([], np.zeros(0, bool))
    weights = np.frombuffer(row.weights, np.float32)
    shaped = weights.reshape(2, -1) if row.width == 2 else weights
    return Model(shaped, row.bias, row.slope, row.offset)


def score(model: Model, text: str | Column) -> Column:
    """Probability, 0 to 1, that a whole text is of good quality; NULL counts as empty."""

    @F.pandas_udf("double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        maker = _Indicators()
        for texts in parts:
            yield pd.Series([_score(model, maker, t) for t in texts], dtype="float64")

    return scores(whole(text))


def score_documents(
    docs: DataFrame, labels: DataFrame, per_class: int = ROWS_PER_CLASS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every row with ``held_out``, ``score`` and ``predicted``.

    Labels, source, language and doc_id never enter a score; labels of held-out rows are
    never read. A doc_id with contradicting labels is not learnt from. Without labelled
    rows of both classes the score is constant. NULL and empty texts get the bias's
    score. Columns of the input that have a result's name are replaced.
    """
    model = train(docs, labels, per_class)
    clear = without(docs, "held_out", "score", "predicted")
    return (
        clear.withColumn("held_out", held_out("doc_id"))
        .withColumn("score", score(model, "text"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, per_class: int = ROWS_PER_CLASS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows that the classifier accepts, with the columns of the input."""
    model = train(docs, labels, per_class)
    return docs.where(score(model, "text") >= threshold)
