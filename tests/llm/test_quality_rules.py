"""Counts and verdicts against plain loops, on awkward texts and on the given table."""

import re
from collections import Counter

import pytest

from cases import TEXTS, documents, plain
from martbrook.llm import quality_rules
from martbrook.llm.quality_rules import Limits

SPACE = r"[ \t\n\x0b\x0c\r]+"


def words(text):
    return [w for w in re.split(SPACE, text) if w]


def plain_line(line):
    return re.sub(SPACE, " ", re.sub(r"[0-9]+", "0", line.lower())).strip(" ")


def counts(text):
    found = words(text)
    windows = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    often = Counter(windows)
    covered = {at + k for at, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words(line)]
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def brute(rows, limits):
    """Of (doc_id, host, text) rows: doc_id, the counts, base_failed, n_left_words, kept."""
    texts, by_line = {}, {}
    for _, host, text in rows:
        texts.setdefault(host, set()).add(text or "")
        for line in (text or "").split("\n"):
            if words(line):
                by_line.setdefault((host, plain_line(line)), set()).add(text or "")
    common = {key for key, found in by_line.items()
              if len(found) > limits.documents and len(found) > limits.share * len(texts[key[0]])}
    out = []
    for i, host, text in rows:
        base = counts(text or "")
        lost = sum(len(words(line)) for line in (text or "").split("\n") if words(line) and (host, plain_line(line)) in common)
        failed = base[0] < limits.least_words or 100 * base[4] > limits.most_repeated * base[0]
        out.append((i, *base, failed, base[0] - lost, not failed and base[0] - lost >= limits.left * base[0]))
    return sorted(out, key=str), common


def found_rows(docs, limits, host="source"):
    found = quality_rules.ruled(docs, host, limits=limits)
    return sorted(plain(found, "doc_id", *quality_rules.BASE, "base_failed", "n_left_words", "kept"), key=str)


def test_awkward_texts(spark, tmp_path):
    limits = Limits(documents=2, share=0.0, left=0.5, least_words=2)
    same = "Read   MORE at 12:30\n"
    texts = [*TEXTS, "a b c a b c", "x x x x", "a b\n\na b\n a b", "#1 & <b> | $%*", "é é é é\x0bé\x0cé é",
             *(f"{same}text {n} of its own" for n in range(4)), f"{same}read more at 7:5\nleft", same, same, same.lower()]
    docs = documents(spark, texts, folder=tmp_path)
    docs = docs.withColumn("source", docs.doc_id.cast("string").substr(1, 0))
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    want, common = brute(rows, limits)
    assert ("", "read more at 0:0") in common and found_rows(docs, limits) == want
    nulls = docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS source", "text", "key AS row", "key AS host", "key AS line")
    want, _ = brute([(None, None, text) for text in texts], limits)
    nulls.write.parquet(f"{tmp_path}/nulls")
    assert found_rows(spark.read.parquet(f"{tmp_path}/nulls"), limits) == want
    assert found_rows(docs.limit(0), limits) == []


def test_hosts_and_copies_count(spark, tmp_path):
    """A line of one text with many copies is no common line, and hosts are counted apart."""
    limits = Limits(documents=3, share=0.0, left=0.5, least_words=1)
    copy = "the same line\nof one text"
    rows = [(n, "a", copy) for n in range(9)] + [(10 + n, "ab"[n % 2], f"menu home\nown {chr(97 + n)} words") for n in range(7)]
    spark.createDataFrame(rows, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    want, common = brute(rows, limits)
    assert common == {("a", "menu home")} and found_rows(docs, limits) == want
    cleaned = quality_rules.without_common_lines(docs, limits=limits)
    assert cleaned.columns == docs.columns
    assert plain(cleaned, "doc_id", "source", "text") == sorted(
        (i, host, text.replace("menu home\n", "") if host == "a" else text) for i, host, text in rows)


def test_a_share_of_a_large_host(spark, tmp_path):
    limits = Limits(documents=2, share=0.5, least_words=1)
    rows = [(n, "a", ("rare line\n" if n < 4 else "") + ("often seen\n" if n < 9 else "") + f"own {chr(97 + n)}") for n in range(12)]
    spark.createDataFrame(rows, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/d")
    want, common = brute(rows, limits)
    assert common == {("a", "often seen")} and found_rows(spark.read.parquet(f"{tmp_path}/d"), limits) == want


def test_cleaning_awkward_texts(spark, tmp_path):
    docs = documents(spark, folder=tmp_path)
    limits = Limits(documents=0, share=0.0)
    cleaned = quality_rules.without_common_lines(docs, "key", limits=limits)
    assert cleaned.columns == docs.columns
    got = {r.doc_id: r.text for r in cleaned.collect()}
    for i, text in enumerate(TEXTS):
        assert got[i] == (None if text is None else "\n".join(line for line in text.split("\n") if not words(line)))


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want, _ = brute([(r.doc_id, r.source, r.text) for r in docs.collect()], Limits())
    assert found_rows(docs, Limits()) == want
    assert 0 < sum(row[-1] for row in want) < len(want)


def test_only_built_in_functions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = quality_rules.counted(docs, "source", "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    # words and windows are made once a row, outside the functions that index them
    assert plan.count("regexp_extract_all") == 1 and plan.count("sort_array(transform") <= 2
