"""Quality by ordinal regression: cumulative links over hashed words.

Grades are ordered. One weight for each hashed feature is shared by all grades; a grade's threshold
says from which score on a text is more likely above it than not. From the chances of lying above each
threshold come the expected grade and the chance of a grade of at least some level, by which texts are selected.

Words over a whole text cannot tell a good text from one that is good but for a toxic passage, so the score of a
toxicity classifier, learnt on the same fold, may be one feature more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from . import toxicity
from .features import CharGrams, WordCounts, chosen, remainder, sigmoid
from .texts import keep_texts, map_texts

HELD_OUT = 1
#: Labelled texts of each grade that the weights are fit on.
SAMPLE = 3000
BITS = 18
#: What a toxicity of 1 counts as, so that one feature is learnt as fast as the many words of a text together.
TOXIC = 4.0
#: A text is selected if its chance of the highest grade is at least this.
SELECT = 0.5


def grade() -> Column:
    """A grade from the labels: 0 for low quality, 1 for good but toxic texts, 2 for good ones; null
    without a judgement of quality."""
    return F.when(F.col("quality") <= 0, 0).when((F.col("quality") > 0) & (F.coalesce("toxic", F.lit(0)) > 0), 1).when(F.col("quality") > 0, 2)


class Features:
    """Hashed words of a text, and its toxicity where there is a model of it: places and values."""

    SIZE = WordCounts(BITS).size + 1

    def __init__(self, toxic: toxicity.Model | None):
        self.counts, self.toxic = WordCounts(BITS), toxic
        self.grams = CharGrams(toxicity.ORDERS, toxicity.BITS) if toxic else None

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        places, values = self.counts(text)
        if self.toxic is None:
            return places, values
        return np.append(places, self.SIZE - 1), np.append(values, TOXIC * self.toxic.score(self.grams.places(text)))


@dataclass(frozen=True)
class Model:
    grades: tuple[int, ...]  # ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one between each grade and the next
    toxic: toxicity.Model | None = None

    def above(self, features: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """The chance of a grade above each threshold."""
        places, values = features
        return sigmoid((self.weights[places] * values).sum() - self.thresholds)

    def expected(self, above: np.ndarray) -> float:
        return float(self.grades[0] + (np.diff(self.grades) * above).sum())


def fit(docs: DataFrame, labels: DataFrame, label: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        held_out: int = HELD_OUT, most: int = SAMPLE, rounds: int = 200, ridge: float = 1e-6,
        toxic: toxicity.Model | None = None) -> Model:
    """The regression of a grade (from the labels' columns) on texts outside the held-out fold, at most
    ``most`` of each grade. Without labels there is the grade 0 only. ``toxic`` must not know the held-out fold either.

    Tasks make the features, so no text goes to the driver. Null texts count as empty."""
    rows, y, shared = [], [], docs.sparkSession.sparkContext.broadcast(toxic)  # 2**toxicity.BITS weights

    def make():
        features = Features(shared.value)
        return lambda text: tuple(part.tolist() for part in features(text))

    for texts, level in chosen(docs, labels, grade() if label is None else label, id_col, text_col, held_out, most):
        for row in map_texts(texts, make, "places array<int>, counts array<double>").orderBy("doc_id").toLocalIterator():
            rows.append((np.array(row["places"], dtype=np.int64), np.array(row["counts"])))
            y.append(level)
    grades = tuple(sorted(set(y))) or (0,)
    if len(grades) == 1:
        return Model(grades, np.zeros(Features.SIZE), np.zeros(0), toxic)
    weights, thresholds = _ordinal(rows, np.searchsorted(grades, y), grades, Features.SIZE, rounds, ridge)
    return Model(grades, weights, thresholds, toxic)


def _ordinal(rows: list, y: np.ndarray, grades: tuple[int, ...], size: int, rounds: int, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Full-gradient Adam on the log-likelihood. The first threshold is free, the others are kept in
    order by the logarithms of their steps."""
    places, flat = np.unique(np.concatenate([p for p, _ in rows]), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    x = np.concatenate([v for _, v in rows])
    levels = len(grades) - 1
    shares = np.cumsum(np.bincount(y, minlength=levels + 1))[:-1] / len(y)
    start = np.log(shares / (1 - shares))
    w = np.zeros(len(places))
    t = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    state = [np.zeros(len(w) + levels) for _ in range(2)]
    for turn in range(1, rounds + 1):
        cuts = np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))
        z = np.bincount(owner, x * w[flat], len(rows))
        below = np.concatenate([np.zeros((len(y), 1)), sigmoid(cuts[None, :] - z[:, None]), np.ones((len(y), 1))], axis=1)
        row = np.arange(len(y))
        high, low = below[row, y + 1], below[row, y]
        chance = np.maximum(high - low, 1e-9)
        slope_high, slope_low = high * (1 - high), low * (1 - low)
        dz = (slope_high - slope_low) / chance / len(y)  # of the negative log-likelihood
        dcut = np.zeros(levels + 2)
        np.add.at(dcut, y + 1, -slope_high / chance / len(y))
        np.add.at(dcut, y, slope_low / chance / len(y))
        dcut = dcut[1:-1]
        later = np.cumsum(dcut[::-1])[::-1]  # a step moves all thresholds after it
        dt = np.concatenate([later[:1], later[1:] * np.exp(t[1:])])
        slope = np.concatenate([np.bincount(flat, x * dz[owner], len(places)) + ridge * w, dt])
        state[0] = 0.9 * state[0] + 0.1 * slope
        state[1] = 0.99 * state[1] + 0.01 * slope * slope
        move = 0.1 * (state[0] / (1 - 0.9 ** turn)) / (np.sqrt(state[1] / (1 - 0.99 ** turn)) + 1e-8)
        w, t = w - move[:len(w)], t - move[len(w):]
    weights = np.zeros(size)
    weights[places] = w
    return weights, np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))


def graded(docs: DataFrame, model: Model, level: int | None = None, select: float = SELECT,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``expected_grade``, ``tail`` (the chance of a grade of at least ``level``, the highest
    one if not given) and ``selected`` (1 if the tail is at least ``select``) of every whole text.

    Null and empty texts are graded as a text without words. Every row is graded, repeated ones alike;
    only the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, level))  # 2**BITS weights, and toxicity's

    def make():
        told, least = shared.value
        features = Features(told.toxic)

        def step(text):
            above = told.above(features(text))
            tail = _tail(told, above, least)
            return told.expected(above), tail, int(tail >= select)
        return step

    return map_texts(docs, make, "expected_grade double, tail double, selected int", id_col, text_col)


def _tail(model: Model, above: np.ndarray, level: int | None) -> float:
    at = len(model.grades) - 1 if level is None else int(np.searchsorted(model.grades, level))
    if at == 0:
        return 1.0
    return float(above[at - 1]) if at <= len(above) else 0.0


def selected(docs: DataFrame, model: Model, level: int | None = None, select: float = SELECT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are selected, with their columns; no shuffle.

    Null and empty texts are graded like others; repeated rows are judged alike; no rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast((model, level))

    def make():
        told, least = shared.value
        features = Features(told.toxic)
        return lambda text: _tail(told, told.above(features(text)), least) >= select

    return keep_texts(docs, make, text_col)


def with_fold(scored: DataFrame, held_out: int = HELD_OUT) -> DataFrame:
    return scored.withColumn("held_out", remainder("doc_id") == held_out)
