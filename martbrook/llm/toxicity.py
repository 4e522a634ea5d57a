"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Over all labelled texts of the training folds it is counted in how many texts of each label an
n-gram occurs. The log of the ratio of the two shares is the n-gram's value wherever it occurs,
and a logistic regression on these values is the classifier. It judges windows of a fixed width, and a text by
its worst window, so that a passage counts alike in short and in long texts. It is fit on the window
of greatest total ratio of each text of a bounded sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .features import CharGrams, chosen, labelled, remainder, sigmoid
from .texts import keep_texts, map_texts, ship_package

HELD_OUT = 1
#: Labelled texts of each label that the regression is fit on; the counts take all.
SAMPLE = 2000
#: The score from which a text is called toxic.
THRESHOLD = 0.7
#: Texts' worth of prior belief that an n-gram says nothing; ratios nearer to 0 than LEAST are left out.
PRIOR, LEAST = 10.0, 0.4
ORDERS, BITS = (3, 4, 5), 20
#: Bytes in which the n-grams of a window begin.
WINDOW = 150


def worst(places: list[np.ndarray], weights: np.ndarray, width: int = WINDOW) -> tuple[int, float]:
    """Where the window of greatest weight begins (the first of equal ones), and that weight. A text that is no longer than a window is one."""
    starts = max((len(p) for p in places), default=0)
    each = np.zeros(starts)
    for p in places:
        each[:len(p)] += weights[p]
    until = np.concatenate([[0.0], np.cumsum(each)])
    if starts <= width:
        return 0, float(until[-1])
    sums = until[width:] - until[:-width]
    at = int(sums.argmax())
    return at, float(sums[at])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of each hashed n-gram, ratio included
    bias: float

    def score(self, places: list[np.ndarray]) -> float:
        """Of a text by the places of its n-grams, order by order."""
        return float(sigmoid(worst(places, self.weights)[1] + self.bias))


def gram_counts(texts: DataFrame) -> DataFrame:
    """In how many texts (text, y) of each label each hashed n-gram occurs: gram, clean, toxic. A task
    keeps two counters for each of the 2**BITS places and sends on those it has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = CharGrams(ORDERS, BITS), np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                counts[int(y > 0), grams(text.as_py())] += 1
        met = np.flatnonzero(counts.sum(axis=0))
        for at in range(0, len(met), 100_000):
            some = met[at:at + 100_000]
            yield pa.RecordBatch.from_pydict({"gram": some, "clean": counts[0, some], "toxic": counts[1, some]})

    ship_package(texts.sparkSession)
    parts = texts.select("text", "y").mapInArrow(run, "gram bigint, clean bigint, toxic bigint")
    return parts.groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def ratios(texts: DataFrame) -> tuple[np.ndarray, float]:
    """Log-count ratios of all n-grams, 0 for those that no text has, and the share of toxic texts. At
    most 2**BITS rows are read."""
    sizes = {bool(r["y"]): r["n"] for r in texts.groupBy((F.col("y") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    out, share = np.zeros(1 << BITS), toxic / max(1, toxic + clean)
    if toxic and clean:
        found = {name: column.to_numpy() for name, column in zip(("gram", "clean", "toxic"), gram_counts(texts).toArrow().columns)}
        values = (np.log((found["toxic"] + PRIOR * share) / (toxic + PRIOR))
                  - np.log((found["clean"] + PRIOR * (1 - share)) / (clean + PRIOR)))
        out[found["gram"]] = np.where(np.abs(values) >= LEAST, values, 0.0)
    return out, share


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        held_out: int = HELD_OUT, most: int = SAMPLE, rounds: int = 150, ridge: float = 1e-3) -> Model:
    """The classifier of ``labels.toxic``, from documents outside the held-out fold. Without texts of
    both labels it says 0.5, or the only label there is, of every text."""
    toxic = F.col("toxic") > 0
    values, share = ratios(labelled(docs, labels, toxic, id_col, text_col, held_out))
    rows, y = [], []
    for texts, label in chosen(docs, labels, toxic, id_col, text_col, held_out, most):
        for row in worst_windows(texts, values).orderBy("doc_id").toLocalIterator():  # at most ``most``, of a window each
            rows.append(np.array(row["grams"], dtype=np.int64))
            y.append(label)
    if len(set(y)) < 2:
        return Model(np.zeros(1 << BITS), 0.0 if not y else 35.0 if y[0] else -35.0)
    weights, bias = _logistic(rows, np.array(y, dtype=float), values, share, rounds, ridge)
    return Model(weights, bias)


def worst_windows(texts: DataFrame, values: np.ndarray) -> DataFrame:
    """``doc_id`` and ``grams``, the n-grams of each text's window of greatest total ratio that have a ratio, with repeats."""
    shared = texts.sparkSession.sparkContext.broadcast(values)  # 2**BITS ratios

    def make():
        grams, ratio = CharGrams(ORDERS, BITS), shared.value

        def step(text):
            places = grams.places(text)
            at, _ = worst(places, ratio)
            found = np.concatenate([np.zeros(0, dtype=np.int64), *(p[at:at + WINDOW] for p in places)])
            return (found[ratio[found] != 0].tolist(),)
        return step

    return map_texts(texts, make, "grams array<int>")


def _logistic(rows: list[np.ndarray], y: np.ndarray, values: np.ndarray, share: float, rounds: int, ridge: float) -> tuple[np.ndarray, float]:
    """Full-gradient Adam over the sample, in which the labels weigh ``share`` and 1 - ``share``."""
    places, flat = np.unique(np.concatenate(rows), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    x = values[places][flat]
    each = np.where(y > 0, share / y.sum(), (1 - share) / (len(y) - y.sum()))
    w, first, second, step = np.zeros(len(places) + 1), 0.0, 0.0, 0.05
    for t in range(1, rounds + 1):
        z = np.bincount(owner, x * w[:-1][flat], len(rows)) + w[-1]
        off = each * (sigmoid(z) - y)
        slope = np.append(np.bincount(flat, x * off[owner], len(places)), off.sum())
        slope[:-1] += ridge * w[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        w = w - step * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    weights = np.zeros(len(values))
    weights[places] = w[:-1] * values[places]
    return weights, float(w[-1])


def _scorer(shared) -> Callable[[str], float]:
    grams, told = CharGrams(ORDERS, BITS), shared.value
    return lambda text: told.score(grams.places(text))


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from the threshold on) of every whole text.

    Null and empty texts get the score of no n-gram. Every row is scored, repeated ones alike; only
    the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights

    def make():
        score = _scorer(shared)

        def step(text):
            value = score(text)
            return value, int(value >= threshold)
        return step

    return map_texts(docs, make, "score double, predicted int", id_col, text_col)


def with_fold(scored: DataFrame, held_out: int = HELD_OUT) -> DataFrame:
    return scored.withColumn("held_out", remainder("doc_id") == held_out)


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns; no shuffle.

    A null or empty text has the score of no n-gram. Repeated rows are judged alike; no rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score = _scorer(shared)
        return lambda text: score(text) < threshold

    return keep_texts(docs, make, text_col)
