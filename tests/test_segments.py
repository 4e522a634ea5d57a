"""Dictionary segmentation: the best of overlapping cuts, large dictionaries, and the forms for SQL."""

from __future__ import annotations

import itertools
import random

from pyspark.sql import functions as F

from martbrook.functions import segments, tokens
from martbrook.plans.queries import syllables


def best_cut(run, words):
    """All cuts, plainly: fewest letters in no word, fewest words, longest first words."""
    found = []

    def go(at, parts):
        if at == len(run):
            found.append(parts)
            return
        for end in range(at + 1, len(run) + 1):
            if run[at:end] in words:
                go(end, [*parts, (run[at:end], True)])
        go(at + 1, [*parts, (run[at], False)])

    go(0, [])
    rank = lambda parts: (sum(not known for _, known in parts), sum(known for _, known in parts),
                          [-len(w) if known else 0 for w, known in parts])
    out, plain = [], ""
    for word, known in min(found, key=rank):
        if known:
            out += [plain] * bool(plain) + [word]
            plain = ""
        else:
            plain += word
    return out + [plain] * bool(plain)


def test_every_cut_is_the_best():
    rng = random.Random(4)
    letters = ["".join(p) for n in (1, 2, 3, 4) for p in itertools.product("abc", repeat=n)]
    for _ in range(300):
        words = set(rng.sample(letters, rng.randrange(0, 25)))
        run = "".join(rng.choices("abcd", k=rng.randrange(1, 10)))
        assert segments.segment(run, segments.Trie(words)) == best_cut(run, words)


def test_where_the_longest_match_is_wrong(spark):
    words = ["研究", "研究生", "生命", "起源", "the", "then", "now"]
    frame = spark.createDataFrame([("研究生命起源 Thenow",), (None,), ("",), ("?!",), ("x研究x",)], "text string")
    smart = [r[0] for r in frame.select(segments.segments(F.col("text"), words)).collect()]
    greedy = [r[0] for r in frame.select(tokens.tokens(F.col("text"), words)).collect()]
    assert smart == [["研究", "生命", "起源", "the", "now"], None, [], [], ["x", "研究", "x"]]
    assert greedy[0] == ["研究生", "命", "起源", "then", "ow"]


def test_large_dictionaries_in_sql(spark):
    """More than ten thousand words: both forms of both cuts agree, and no form refuses."""
    words = syllables()
    assert len(set(words)) > 10_000
    frame = spark.createDataFrame([("Banana bread, café 123 tomato",), (None,), ("",), ("strengths " * 300,)], "text string")
    frame.createOrReplaceTempView("some_texts")
    segments.register_segment_function(spark, "cut_best", words)
    tokens.register_keyword_function(spark, "cut_longest", words)
    for name, column in (("cut_best", segments.segments), ("cut_longest", tokens.tokens)):
        in_sql = [r[0] for r in spark.sql(f"SELECT k.word FROM some_texts, LATERAL {name}(text) AS k(word)").collect()]
        mine = [r[0] for r in frame.select(F.explode(column(F.col("text"), words))).collect()]
        assert sorted(in_sql) == sorted(mine) and len(mine) > 300


def test_a_very_long_run():
    run = "ab" * 50_000
    assert segments.segment(run, segments.Trie(["ab", "ba", "abab"])) == ["abab"] * 25_000
