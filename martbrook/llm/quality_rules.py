"""Quality rules: what a text has too much of, and lines that stand in too many documents of a host.

One pass over the texts counts words, signs, repeated lines and repeated runs of three words, and turns each
line into a hash of its normalised form and its number of words. That table, a fraction of the
texts, is all that the rest reads: in how many different texts of a host a line stands, which lines are
above the limits, and how many words of each document are left without them. Only built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .texts import named, whole_text

# What separates words, and which characters are symbols.
SPACES, SYMBOLS = r"\x20\x09-\x0D", r"#*$%&|<>"
WORD = rf"[^{SPACES}]+"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """A line is above the limits in more than ``documents`` different texts of a host and more than ``share``
    of its different texts. A document is depleted when less than ``left`` of its words remain."""

    documents: int = 20
    share: float = 0.002
    left: float = 0.5
    least_words: int = 50
    most_repeated: int = 50  # per cent of the words


def held(rows: DataFrame, **columns: Column) -> DataFrame:
    """Columns made once for each row. In a projection they could be merged into the expressions that use
    them, within the functions of arrays for every element; a generator is never merged."""
    return rows.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def normalised(line: Column) -> Column:
    """Lower case, digits alike, single spaces."""
    plain = F.regexp_replace(F.lower(line), r"[0-9]+", "0")
    return F.trim(F.regexp_replace(plain, rf"[{SPACES}]+", " "))


def counted(docs: DataFrame, host_col: str, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``row`` (a key), ``doc_id``, ``host`` and ``body`` (hashes), the counts of :data:`BASE`, and ``lines``,
    an array of the hash and the words of each line that has a word."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), named(id_col).alias("doc_id"),
        F.xxhash64(named(host_col)).alias("host"), whole_text(text_col).alias("text"))
    rows = held(rows, words=F.regexp_extract_all("text", F.lit(WORD), F.lit(0)),
                lines=F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)))
    rows = held(
        rows.withColumns({
            "body": F.xxhash64("text"),
            "n_words": F.size("words").cast("bigint"),
            "word_chars": F.length(F.regexp_replace("text", rf"[{SPACES}]+", "")).cast("bigint"),
            "n_symbols": F.length(F.regexp_replace("text", rf"[^{SYMBOLS}]+", "")).cast("bigint"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        }).drop("text"),
        # The last two windows are shorter, so they equal no other.
        windows=F.sort_array(F.transform("words", lambda word, i: F.struct(
            F.concat_ws(" ", word, F.get("words", i + 1), F.get("words", i + 2)).alias("key"), i.alias("at")))),
        hashes=F.transform("lines", _line))
    again = F.filter("windows", lambda w, i: (w["key"] == F.get("windows", i - 1)["key"]) | (w["key"] == F.get("windows", i + 1)["key"]))
    rows = held(rows.drop("words", "lines"), starts=F.sort_array(F.transform(again, lambda w: w["at"])))
    covered = F.transform("starts", lambda at, i: F.least(F.lit(3), F.coalesce(F.get("starts", i + 1) - at, F.lit(3))))
    repeated = F.aggregate(covered, F.lit(0).cast("bigint"), lambda total, n: total + n)
    return rows.select("row", "doc_id", "host", "body", *BASE[:-1], repeated.alias(BASE[-1]), F.col("hashes").alias("lines"))


def _line(line: Column) -> Column:
    plain = normalised(line)
    return F.struct(F.xxhash64(plain).alias("line"), F.size(F.split(plain, " ")).alias("n"))


def common_lines(found: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``host, line``: lines above the limits, of stored rows of :func:`counted`.

    Copies of a text count once. A line that very many documents share is counted in two groupings, by text
    and then by line, both of which combine before the shuffle."""
    lines = found.select("host", "body", F.explode("lines.line").alias("line"))
    texts = lines.groupBy("host", "line", "body").agg(F.lit(1).alias("one"))
    often = texts.groupBy("host", "line").agg(F.sum("one").alias("documents")).filter(F.col("documents") > limits.documents)
    hosts = found.groupBy("host", "body").agg(F.lit(1).alias("one")).groupBy("host").agg(F.sum("one").alias("all"))
    return often.join(hosts, "host").filter(F.col("documents") > F.col("all") * limits.share).select("host", "line")


def ruled(
    docs: DataFrame, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits(),
) -> DataFrame:
    """The counts of each row of ``docs``, the words that remain without common lines, and the verdict.

    Returns ``doc_id``, ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines equal
    to an earlier one), ``n_repeat_words`` (words in runs of three found twice or more), ``base_failed``,
    ``n_left_words``, and ``kept``: false for a text of fewer than ``least_words`` words, with more than
    ``most_repeated`` per cent of its words repeated, or depleted.

    A null or empty text has no words and fails. A null host is a host of its own; null or repeated ids
    are rows like others. Equal texts of a host count as one document in the frequency of lines, and get the
    same verdict. Lines are told apart by 64 bits. No rows give no rows; other columns are not looked at.
    """
    found = written(counted(docs, host_col, id_col, text_col), "rules")
    common = written(common_lines(found, limits), "common_lines")
    lines = found.select("row", "host", F.inline("lines"))
    lost = lines.join(common, ["host", "line"]).groupBy("row").agg(F.sum("n").alias("lost"))
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    base_failed = (F.col("n_words") < limits.least_words) | (100 * F.col("n_repeat_words") > limits.most_repeated * F.col("n_words"))
    return found.drop("lines").join(lost, "row", "left").select(
        "doc_id", *BASE, base_failed.alias("base_failed"), left.alias("n_left_words"),
        (~base_failed & (left >= limits.left * F.col("n_words"))).alias("kept"))


def without_common_lines(
    docs: DataFrame, host_col: str = "source", text_col: str = "text", limits: Limits = Limits(),
) -> DataFrame:
    """The rows of ``docs``, with their columns, without the lines that are above the limits on their host.

    Other lines stay as they are; a null text stays null. Nothing is judged: see :func:`ruled`."""
    keyed = docs.select("*", F.monotonically_increasing_id().alias("__row"), F.xxhash64(named(host_col)).alias("__host"))
    keyed = written(keyed, "rules_docs")
    found = written(counted(keyed, host_col, "__row", text_col).drop("row"), "rules")
    common = written(common_lines(found, limits), "common_lines")
    lines = found.select(F.col("doc_id").alias("row"), "host", F.explode(F.array_distinct("lines.line")).alias("line"))
    # At most the lines of one text come together.
    drop = lines.join(common, ["host", "line"]).groupBy(F.col("row").alias("__of")).agg(
        F.collect_list("line").alias("__drop"))
    kept = F.filter(F.split(named(text_col), "\n"), lambda line: ~F.array_contains("__drop", F.xxhash64(normalised(line))))
    text = F.when(F.col("__drop").isNull(), named(text_col)).otherwise(F.array_join(kept, "\n"))
    return keyed.join(drop, F.col("__row") == F.col("__of"), "left").select(
        *(text.alias(name) if name == text_col else named(name) for name in docs.columns))
