"""Cutting text without spaces at the words of a dictionary, the best of all overlapping cuts.

A trie finds every dictionary word at every position of a run of letters. Of all ways to cut the run, the
one that leaves the fewest letters in no word is taken; of these the one with the fewest words; of these the one whose
first word is longest, then its second, and so on. Letters in no word are put together.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

WORD = r"[\p{L}\p{N}]+"
#: Runs whose cut a worker remembers; text repeats its words.
REMEMBERED = 100_000


class Trie:
    """The words of a dictionary by their letters."""

    def __init__(self, words: Iterable[str]):
        self.root: dict = {}
        for word in words:
            node = self.root
            for letter in word:
                node = node.setdefault(letter, {})
            if word:
                node[""] = True

    def ends(self, run: str, start: int) -> list[int]:
        """Where words that begin at ``start`` end, the nearest first."""
        node, found = self.root, []
        for at in range(start, len(run)):
            node = node.get(run[at])
            if node is None:
                break
            if "" in node:
                found.append(at + 1)
        return found


def segment(run: str, trie: Trie) -> list[str]:
    """The best cut of one run of letters, from its end to its start in one go."""
    size = len(run)
    best = [(0, 0)] * (size + 1)  # letters outside words, words; of the rest from each position on
    step = [0] * (size + 1)
    for at in range(size - 1, -1, -1):
        outside, words = best[at + 1]
        choice, end = (outside + 1, words), 0  # this letter in no word
        for stop in trie.ends(run, at):
            outside, words = best[stop]
            if (outside, words + 1) <= choice:
                choice, end = (outside, words + 1), stop
        best[at], step[at] = choice, end
    out, at, plain = [], 0, 0
    while at < size:
        if step[at]:
            if plain < at:
                out.append(run[plain:at])
            out.append(run[at:step[at]])
            at = plain = step[at]
        else:
            at += 1
    if plain < size:
        out.append(run[plain:])
    return out


def cutter(words: Iterable[str]) -> Callable[[str], list[str]]:
    trie, known = Trie(words), {}

    def cut(run: str) -> list[str]:
        found = known.get(run)
        if found is None:
            if len(known) >= REMEMBERED:
                known.clear()
            found = known[run] = segment(run, trie)
        return found

    return cut


def _shared(dictionary: Iterable[str]):
    words = sorted({word.lower() for word in dictionary if word})
    return SparkSession.active().sparkContext.broadcast(words)


def segments(text: Column, dictionary: Iterable[str]) -> Column:
    """The keywords of a text as an array: lower-case runs of letters and digits, each cut at dictionary words.

    Null stays null; a text without letters gives an empty array. A dictionary of any size is sent to
    every worker once."""
    shared = _shared(dictionary)

    @F.pandas_udf("array<string>")
    def cut_runs(batches: pd.Series) -> pd.Series:
        cut = _cutter_of(shared)
        return batches.map(lambda runs: None if runs is None else [word for run in runs for word in cut(run)])

    return cut_runs(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


_cutters: dict = {}


def _cutter_of(shared):
    """One trie a worker and dictionary."""
    if shared not in _cutters:
        _cutters.clear()
        _cutters[shared] = cutter(shared.value)
    return _cutters[shared]


def register_segment_function(spark: SparkSession, name: str, dictionary: Iterable[str]) -> None:
    """``SELECT ... FROM t, LATERAL name(text) AS k(word)``, as :func:`segments`, for a dictionary of any size."""
    shared = _shared(dictionary)

    class Cut:
        def __init__(self):
            import regex

            self.cut, self.run = cutter(shared.value), regex.compile(WORD)

        def eval(self, text):
            for run in self.run.findall(text.lower()) if text is not None else ():
                for word in self.cut(run):
                    yield (word,)

    spark.udtf.register(name, F.udtf(Cut, returnType="word string", useArrow=True))
