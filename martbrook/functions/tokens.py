"""Keyword tokeniser, as a column function and as a SQL table function."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

WORD = r"[\p{L}\p{N}]+"


#: Dictionaries of at most so many words become a regular expression, which stays in the JVM.
PATTERN_WORDS = 200


def tokens(text: Column, dictionary: Iterable[str] | None = None) -> Column:
    """The keywords of a text as an array.

    Without a dictionary: lower-case runs of letters and digits, a built-in expression.
    With one: the longest dictionary word at each position, as for text written without
    spaces; characters outside every word are grouped into runs as above.
    """
    words = None if dictionary is None else frozenset(word.lower() for word in dictionary if word)
    if words is None or len(words) <= PATTERN_WORDS:
        return F.regexp_extract_all(F.lower(text), F.lit(word_pattern(words)), F.lit(0))
    return _splitter(words)(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def word_pattern(words: Iterable[str] | None = None) -> str:
    """A pattern that matches one keyword after the other; the longest word wins, being tried first."""
    known = sorted((w for w in words or () if re.fullmatch(r"[^\W_]+", w)), key=lambda w: (-len(w), w))
    if not known:
        return WORD
    either = "|".join(known)
    return rf"(?:{either})|(?:(?!{either})[\p{{L}}\p{{N}}])+"


def _splitter(words: frozenset[str]):
    """Cuts runs at the words of a large dictionary, which every worker is sent once."""
    shared = SparkSession.active().sparkContext.broadcast((words, max(map(len, words), default=1)))

    @F.pandas_udf("array<string>")
    def split_runs(batch: pd.Series) -> pd.Series:
        known, longest = shared.value
        return batch.map(lambda found: None if found is None else [
            word for run in found for word in longest_match(run, known, longest)])

    return split_runs


def longest_match(run: str, words: frozenset[str], longest: int) -> list[str]:
    """Cut one run of letters at the longest known words, left to right."""
    out, start, plain = [], 0, 0
    while start < len(run):
        size = next((n for n in range(min(longest, len(run) - start), 0, -1) if run[start:start + n] in words), 0)
        if size:
            if plain < start:
                out.append(run[plain:start])
            out.append(run[start:start + size])
            start = plain = start + size
        else:
            start += 1
    if plain < start:
        out.append(run[plain:start])
    return out


def register_keyword_function(spark: SparkSession, name: str = "ik_analyze", dictionary: Iterable[str] | None = None) -> None:
    """``SELECT ... FROM t, LATERAL name(text) AS k(word)``. Catalyst inlines the body of a pattern; a dictionary
    of more than ``PATTERN_WORDS`` words becomes a table function in Python that cuts alike."""
    words = [] if dictionary is None else sorted({word.lower() for word in dictionary if word})
    if len(words) <= PATTERN_WORDS:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE(word STRING) "
            f"RETURN SELECT explode(regexp_extract_all(lower(text), r'{word_pattern(words)}', 0))"
        )
        return
    shared = spark.sparkContext.broadcast((frozenset(words), max(map(len, words))))

    class Cut:
        def __init__(self):
            import regex

            self.known, self.run = shared.value, regex.compile(WORD)

        def eval(self, text):
            for run in self.run.findall(text.lower()) if text is not None else ():
                for word in longest_match(run, *self.known):
                    yield (word,)

    spark.udtf.register(name, F.udtf(Cut, returnType="word string", useArrow=True))
