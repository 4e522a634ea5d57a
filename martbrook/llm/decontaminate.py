"""Benchmark decontamination: one Aho-Corasick automaton over the words of all benchmark texts.

Words are lower-cased (A-Z only) runs of characters that are neither ASCII signs nor spaces. Each
distinct benchmark word gets a character of its own, so an automaton over those characters matches
whole words only, finds positions in words, and needs one node per word of a window. A document is
scanned once, whatever the number of windows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from ..session import work_dir, written
from .texts import file_system, keep_texts, map_texts, named, whole_text

WINDOW = 10
#: Benchmark text that one automaton takes, in bytes. Its nodes take about 100 bytes per byte of
#: text in each Python worker. A larger benchmark is scanned in several passes.
BLOCK_BYTES = 2_000_000
# What is not a word, in characters and in bytes of UTF-8.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BREAKS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_TO_WORDS = bytes(
    ord(chr(b).lower()) if 0x41 <= b <= 0x5A else 0x20 if b in set(BREAKS) else b for b in range(256)
)
_OTHER = "\x00"
RESULT = ("n_words bigint, n_hit bigint, item_ids array<string>, "
          "spans array<struct<start: bigint, end: bigint>>")
#: What one of several passes finds: runs of hit words, and where they are in the text.
PART = ("n_words bigint, item_ids array<string>, "
        "runs array<struct<first: bigint, last: bigint, start: bigint, end: bigint>>")


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class Automaton:
    """The windows of some benchmark items, and the items that have each of them."""

    def __init__(self, items: Iterable[tuple[str, str]], window: int = WINDOW):
        self.letters: dict[bytes, str] = {}
        self.window_items: list[set[str]] = []
        self.trie = ahocorasick.Automaton()
        for item, text in items:
            found = words(text)
            letters = "".join([self._letter(w) for w in found])
            for at in range(max(1, len(found) - window + 1) if found else 0):
                key = letters[at:at + window]
                entry = self.trie.get(key, None)
                if entry is None:
                    entry = (len(self.window_items), len(key))
                    self.window_items.append(set())
                    self.trie.add_word(key, entry)
                self.window_items[entry[0]].add(item)
        self.trie.make_automaton()

    def _letter(self, word: bytes) -> str:
        if word not in self.letters:
            n = len(self.letters) + 1
            self.letters[word] = chr(n if n < 0xD800 else n + 0x800)  # surrogates are no characters
        return self.letters[word]

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, runs of hit words (end exclusive), and the items found."""
        found = words(text)
        if not self.window_items or not found:
            return len(found), [], []
        get = self.letters.get
        runs: list[tuple[int, int]] = []
        seen: set[int] = set()
        for last, (entry, length) in self.trie.iter("".join([get(w, _OTHER) for w in found])):
            seen.add(entry)
            runs.append((last + 1 - length, last + 1))
        items = set().union(*(self.window_items[e] for e in seen)) if seen else set()
        return len(found), merged(runs), sorted(items)


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of runs, as runs that don't touch."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def to_offsets(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as offsets in the original text (characters, end exclusive)."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    at = [m.span() for m in WORD.finditer(lowered)] if runs else []
    return [(at[start][0], at[end - 1][1]) for start, end in runs]


def _scanner(block: str, window: int) -> Callable:
    def make():
        automaton = Automaton(_items(block), window)

        def step(text):
            n, runs, items = automaton.scan(text)
            spans = [{"start": a, "end": b} for a, b in to_offsets(text, runs)]
            return n, sum(b - a for a, b in runs), items, spans
        return step
    return make


def _part_scanner(block: str, window: int) -> Callable:
    def make():
        automaton = Automaton(_items(block), window)

        def step(text):
            n, runs, items = automaton.scan(text)
            at = zip(runs, to_offsets(text, runs))
            return n, items, [{"first": a, "last": b, "start": start, "end": end} for (a, b), (start, end) in at]
        return step
    return make


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[str]:
    """The benchmark in parts of about ``block_bytes``, by a hash of the text, each in a folder of its own that
    tasks read; the driver sees the size only."""
    rows = items.select(named(id_col).cast("string").alias("item"), whole_text(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    folder = work_dir(items.sparkSession, "benchmark")
    rows.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(count))).write.partitionBy("part").parquet(folder)
    return [f"{folder}/part={k}" for k in range(count)]


def _items(folder: str) -> Iterator[tuple[str, str]]:
    """Ids and texts of one part; nothing is stored of an empty one."""
    files, path = file_system(folder)
    if files.get_file_info(path).type == pafs.FileType.NotFound:
        return
    for batch in pads.dataset(path, filesystem=files, format="parquet").to_batches(columns=["item", "text"]):
        for item, text in zip(*(column.to_pylist() for column in batch.columns)):
            yield item if item is not None else "", text


def benchmark_hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """What of each document occurs in a benchmark.

    Returns per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (words inside an occurrence of a
    window), ``item_ids`` (text, distinct, sorted) and ``spans`` (the hit runs as character offsets in
    the original text). A window is ``window`` consecutive words of an item, or all words of an item
    with fewer.

    Null or empty texts have no words and no windows; with an empty benchmark nothing is hit. A null
    item id counts as the empty text, rows with one item id as one item, in each of which windows may
    occur. Repeated document rows are each returned. Other columns are not looked at.

    A benchmark above ``block_bytes`` takes one pass over the documents for each such part (about
    so many bytes each; a single longer item stays whole). Each row is then stored with a key of its
    own, by which what the passes found is put together; ids may be null or repeat.
    """
    blocks = _blocks(items, item_id_col, item_text_col, block_bytes)
    if len(blocks) == 1:
        return map_texts(docs, _scanner(blocks[0], window), RESULT, id_col, text_col)
    rows = docs.select(
        F.struct(F.monotonically_increasing_id().alias("key"), named(id_col).alias("id")).alias("row"),
        whole_text(text_col).alias("text"))
    rows = written(rows, "decontaminate")  # keys must be the same in each pass
    passes = [map_texts(rows, _part_scanner(b, window), PART, "row") for b in blocks]
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more.filter(F.size("runs") > 0))
    grouped = every.groupBy(F.col("doc_id.key").alias("key")).agg(
        F.first("doc_id.id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.flatten(F.collect_list("runs")).alias("runs"))
    union = F.udf(_union, "struct<n_hit: bigint, spans: array<struct<start: bigint, end: bigint>>>")
    grouped = grouped.select("doc_id", "n_words", "item_ids", union("runs").alias("u"))
    return grouped.select("doc_id", "n_words", "u.n_hit", "item_ids", "u.spans")


def _union(runs):
    """Runs of several passes merged by their words; the offsets are those of the first and last word."""
    starts = {r["first"]: r["start"] for r in runs}
    ends = {r["last"]: r["end"] for r in runs}
    found = merged([(r["first"], r["last"]) for r in runs])
    return sum(b - a for a, b in found), [(starts[a], ends[b]) for a, b in found]


def decontaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` without a hit word, with their columns; no shuffle.

    Null and empty texts have no words and stay. Repeated rows are judged alike; without items all rows stay, and no
    rows give no rows. Ids of documents are not looked at."""
    for block in _blocks(items, item_id_col, item_text_col, block_bytes):

        def make(block=block):
            automaton = Automaton(_items(block), window)
            return lambda text: not automaton.scan(text)[1]

        docs = keep_texts(docs, make, text_col)
    return docs
