"""Hashed text features and labelled rows, for the classifiers."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .id_filter import may_contain
from .texts import named, whole_text

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(257)


class CharGrams:
    """Which hashed n-grams of bytes a text has. Lower case; the ends of a text count as spaces."""

    def __init__(self, orders: tuple[int, ...] = (3, 4, 5), bits: int = 20):
        self.orders, self.bits = orders, bits
        self._last = np.zeros(1 << bits, dtype=np.int64)

    def places(self, text: str) -> list[np.ndarray]:
        """For each order the places of the n-grams that begin at each byte, as far as the text goes."""
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint64)
        parts, rolled = [], codes
        for n in range(2, max(self.orders) + 1):
            if len(codes) < n:
                break
            rolled = rolled[:-1] * _BASE + codes[n - 1:]
            if n in self.orders:
                parts.append((((rolled + np.uint64(n)) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64))
        return parts

    def __call__(self, text: str) -> np.ndarray:
        found = np.concatenate([np.zeros(0, dtype=np.int64), *self.places(text)])
        # Each place is kept where it was written last: the distinct ones, without sorting.
        order = np.arange(len(found))
        self._last[found] = order
        return found[self._last[found] == order]


class WordCounts:
    """Hashed words and pairs of words with damped counts (1 + log n), scaled to unit length, and a few
    shares of kinds of signs. Words are split at white space, so that signs stay part of them."""

    SHARES = 6

    def __init__(self, bits: int = 18):
        self.bits = bits
        self.size = (1 << bits) + self.SHARES

    def _place(self, word: str) -> int:
        data = word.encode("utf-8", "surrogatepass")
        return zlib.crc32(data) >> (32 - self.bits)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        counts: dict[int, int] = {}
        for word in words:
            place = self._place(word)
            counts[place] = counts.get(place, 0) + 1
        for first, second in zip(words, words[1:]):
            place = self._place(first + " " + second)
            counts[place] = counts.get(place, 0) + 1
        places = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
        values = 1 + np.log(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
        if len(values):
            values /= np.sqrt((values * values).sum())
        shares = self._shares(text, words)
        return (np.concatenate([places, (1 << self.bits) + np.arange(self.SHARES)]), np.concatenate([values, shares]))

    def _shares(self, text: str, words: list[str]) -> np.ndarray:
        """Shares of letters (other than ASCII signs), capitals, digits and other signs; of different
        words; and the length of words."""
        counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
        signs = max(1, int(counts[:0x80].sum() + counts[0xC0:].sum()))  # bytes that begin a character
        capitals, digits, spaces = counts[0x41:0x5B].sum(), counts[0x30:0x3A].sum(), counts[0x09:0x0E].sum() + counts[0x20]
        letters = capitals + counts[0x61:0x7B].sum() + counts[0xC0:].sum()
        return np.array([
            letters / signs, capitals / max(1, letters), digits / signs, max(0.0, 1 - (letters + spaces) / signs),
            len(set(words)) / max(1, len(words)), min(1.0, signs / max(1, len(words)) / 20),
        ])


def remainder(id_col: str, folds: int = 3) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(named(id_col).cast("string"), F.lit(""))) % folds


def labelled(docs: DataFrame, labels: DataFrame, label: Column, id_col: str, text_col: str, held_out: int) -> DataFrame:
    """Texts with a label, outside the held-out fold: (doc_id, text, y). Rows without an id or a label
    are left out; of several labels of a document the greatest counts."""
    y = _judged(labels, label, held_out)
    some = may_contain(y, "doc_id")
    texts = docs.filter(some(named(id_col))).select(named(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    # Labels grow with the documents: never sent to all tasks. Few texts without one get this far.
    return texts.filter(remainder("doc_id") != held_out).join(y.hint("merge"), "doc_id")


def _judged(labels: DataFrame, label: Column, held_out: int) -> DataFrame:
    y = labels.select(F.col("doc_id"), label.cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL")
    return y.filter(remainder("doc_id") != held_out).groupBy("doc_id").agg(F.max("y").alias("y"))


#: Different labels that a sample can have.
MOST_LABELS = 100


def chosen(
    docs: DataFrame, labels: DataFrame, label: Column, id_col: str, text_col: str, held_out: int, most: int,
) -> list[tuple[DataFrame, int]]:
    """For each label whole texts (doc_id, text) of at most ``most`` documents, those whose ids'
    hashes are least; outside the held-out fold, as :func:`labelled`. Of several texts of an id the one
    whose hash is least counts. More than ``MOST_LABELS`` different labels are an error."""
    y = _judged(labels, label, held_out)
    levels = sorted(r["y"] for r in y.select("y").distinct().limit(MOST_LABELS + 1).collect())
    if len(levels) > MOST_LABELS:
        raise ValueError(f"there are more than {MOST_LABELS} different labels")
    texts, out = docs.select(named(id_col).alias("doc_id"), whole_text(text_col).alias("text")), []
    for level in levels:
        ids = y.filter(F.col("y") == level).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        rows = texts.join(F.broadcast(ids), "doc_id")  # at most so many ids
        one = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
        out.append((one.select("doc_id", "first.text"), level))
    return out


def sample(
    docs: DataFrame, labels: DataFrame, label: Column, id_col: str, text_col: str, held_out: int, most: int,
) -> Iterator[tuple[str, int]]:
    """The texts of :func:`chosen` with their labels, one after the other."""
    for texts, level in chosen(docs, labels, label, id_col, text_col, held_out, most):
        for row in texts.orderBy("doc_id").toLocalIterator():
            yield row["text"], level


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
