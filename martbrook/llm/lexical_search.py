"""Ranked lexical search: best-first intervals of documents, bounded by sums of range maxima.

The documents of a shard are put in an order, each query term has its posting list in that order with the
impact (its share of the score) of every posting, and each list a sparse table that answers where in any
range the greatest impact is. An interval of documents can score no more than the sum of its terms' range
maxima. The interval with the highest bound is taken first and split at the document of its greatest
impact, which is scored; both sides go back with bounds of their own. It ends when no bound reaches the last of
the best documents found, so nothing is missed. Some intervals are taken at a time, as arrays.

Spark counts terms, cuts shards and merges their best documents. The terms of the queries are all that is
counted, and what a shard holds is bounded by its number of postings.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import written
from .texts import ROWS, named, ship_package, whole_text

# Which bytes of UTF-8 separate terms.
_BREAKS = {*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}
_TO_TERMS = bytes(0x20 if b in _BREAKS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))

BEST = 20
#: Bytes of query texts that one pass over the documents takes; more queries take more passes.
BLOCK_BYTES = 1_000_000
#: Postings of one shard: its sparse tables take about 60 bytes for each.
SHARD_POSTINGS = 500_000
#: Intervals that are split at a time.
AT_A_TIME = 64
_NO_ID = np.iinfo(np.int64).min  # a null id comes first


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_TERMS).split()


# --- the score ----------------------------------------------------------------------
def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def damping(n_terms: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """How much a document of so many terms damps a term's occurrences; 100 for one of mean length."""
    return 100 - 25 + (25 * n_terms * n_docs) // max(1, all_terms)


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


# --- a shard --------------------------------------------------------------------------
class RangeMaximum:
    """Where the greatest of any range of an array is, by the answers for all ranges of a power of two."""

    def __init__(self, values: np.ndarray, longest: int | None = None):
        """``longest`` is the length of the longest range that will be asked for."""
        self.values = values
        longest = len(values) if longest is None else longest
        self.levels = [np.arange(len(values), dtype=np.int32)]
        step = 1
        while 2 * step <= longest:
            below = self.levels[-1]
            left, right = below[:len(below) - step], below[step:]
            self.levels.append(np.where(values[left] >= values[right], left, right))
            step *= 2
        width = len(values)
        self.table = np.zeros((len(self.levels), width), dtype=np.int32)
        for k, level in enumerate(self.levels):
            self.table[k, :len(level)] = level
        del self.levels

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Places of the greatest in [lo, hi); ranges must not be empty."""
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1
        a, b = self.table[k, lo], self.table[k, hi - (1 << k)]
        return np.where(self.values[a] >= self.values[b], a, b)


@dataclass
class Found:
    """The best documents of a query so far, best first: scores, and ids that settle ties."""

    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def none(cls) -> Found:
        return cls(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))

    def add(self, scores: np.ndarray, ids: np.ndarray, best: int) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[:best]
        self.scores, self.ids = scores[order], ids[order]

    def last(self, best: int) -> tuple[int, int]:
        """What a document must beat; any score above 0 while there is room."""
        return (int(self.scores[-1]), int(self.ids[-1])) if len(self.scores) == best else (0, _NO_ID)


class Shard:
    """Posting lists of some documents. ``owner`` and ``term`` tell document and term of each posting."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, owner: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray):
        order = np.lexsort((ids, -m))  # documents of like length, so of like impacts, stand together
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.ids, self.n = ids[order], len(order)
        keys = term.astype(np.int64) * self.n + place[owner]
        by_term = np.argsort(keys)
        self.keys = keys[by_term]
        self.docs = place[owner[by_term]]
        self.impact = impacts(weights[term[by_term]], tf[by_term].astype(np.int64), m[owner[by_term]])
        bounds = np.searchsorted(self.keys, np.arange(len(weights) + 1) * self.n)
        self.starts, self.ends = bounds[:-1], bounds[1:]
        self.greatest = RangeMaximum(self.impact, int((self.ends - self.starts).max(initial=0)))
        self.first_id = RangeMaximum(-self.ids.astype(np.float64) if len(ids) else np.zeros(0))

    def search(self, term: np.ndarray, times: np.ndarray, found: Found, best: int, at_a_time: int = AT_A_TIME) -> None:
        """Add the best documents for a query, its distinct terms and how often it has each."""
        here = self.ends[term] > self.starts[term]
        term, times = term[here], times[here]
        if not len(term):
            return
        lo, hi = self.starts[term][None, :], self.ends[term][None, :]
        span = np.array([[0, self.n]])  # documents of each interval
        bound, split = self._bounds(lo, hi, times)
        while len(bound):
            score, last_id = found.last(best)
            alive = bound > score
            tied = np.flatnonzero((bound == score) & (score > 0))
            if len(tied):
                alive[tied] = self.ids[self.first_id(span[tied, 0], span[tied, 1])] < last_id
            if not alive.all():
                lo, hi, span, bound, split = lo[alive], hi[alive], span[alive], bound[alive], split[alive]
                if not len(bound):
                    return
            if len(bound) > at_a_time:
                order = np.argpartition(-bound, at_a_time)
                now, later = order[:at_a_time], order[at_a_time:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, dtype=np.int64)
            doc = split[now]
            key = term * self.n + doc[:, None]
            mid = np.searchsorted(self.keys, key)
            has = (mid < hi[now]) & (self.keys[np.minimum(mid, len(self.keys) - 1)] == key)
            scores = (np.where(has, self.impact[np.minimum(mid, len(self.impact) - 1)], 0) * times).sum(axis=1)
            found.add(scores, self.ids[doc], best)
            new_lo, new_hi = np.concatenate([lo[now], mid + has]), np.concatenate([mid, hi[now]])
            new_span = np.concatenate([np.stack([span[now, 0], doc], axis=1), np.stack([doc + 1, span[now, 1]], axis=1)])
            new_bound, new_split = self._bounds(new_lo, new_hi, times)
            some = new_bound >= max(1, found.last(best)[0])
            lo, hi = np.concatenate([lo[later], new_lo[some]]), np.concatenate([hi[later], new_hi[some]])
            span = np.concatenate([span[later], new_span[some]])
            bound, split = np.concatenate([bound[later], new_bound[some]]), np.concatenate([split[later], new_split[some]])

    def _bounds(self, lo: np.ndarray, hi: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the range maxima of each interval, and the document of the greatest of them."""
        filled = hi > lo
        at = np.zeros(lo.shape, dtype=np.int64)
        at[filled] = self.greatest(lo[filled], hi[filled])
        most = np.where(filled, self.impact[at], -1) * times
        leading = at[np.arange(len(at)), most.argmax(axis=1)]
        return np.where(filled, most, 0).sum(axis=1), self.docs[leading]


# --- on Spark --------------------------------------------------------------------------
def counted(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n`` (all terms) and, for the terms of a vocabulary, ``terms`` and ``tfs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sizes, offsets, found, often = [], [0], [], []
                for text in part.column(1):
                    counts = Counter(terms(text.as_py()))
                    sizes.append(counts.total())
                    for term, n in counts.items():
                        place = known.get(term)
                        if place is not None:
                            found.append(place)
                            often.append(n)
                    offsets.append(len(found))
                lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), lists(found, pa.int32()), lists(often, pa.int64())],
                    names=["doc_id", "n", "terms", "tfs"])

    ship_package(docs.sparkSession)
    rows = docs.select(named(id_col).cast("bigint").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


def _shards(batches: Iterator[pa.RecordBatch], told, postings: int) -> Iterator[Shard]:
    """Shards of rows of :func:`counted`, closed at so many postings; a row stays whole."""
    parts, held = [], 0
    for batch in batches:
        lists = batch.column(2)
        ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + postings - held, side="right")))
            parts.append(batch.slice(at, stop - at))
            held += int(ends[stop - 1]) - before
            at = stop
            if held >= postings or at < batch.num_rows:
                yield _shard(parts, told)
                parts, held = [], 0
    if parts:
        yield _shard(parts, told)


def _shard(parts: list[pa.RecordBatch], told) -> Shard:
    weights, n_docs, all_terms = told
    rows = pa.Table.from_batches(parts).combine_chunks()
    ids = rows.column("doc_id").fill_null(_NO_ID).to_numpy()
    flat = lambda name: rows.column(name).combine_chunks()
    lists = flat("terms")
    sizes = np.diff(lists.offsets.to_numpy())
    return Shard(
        ids, damping(rows.column("n").to_numpy(), n_docs, all_terms), np.repeat(np.arange(len(ids)), sizes),
        lists.flatten().to_numpy(), flat("tfs").flatten().to_numpy(), weights)


def _search_block(docs, block, best, id_col, text_col, postings) -> DataFrame:
    """One pass: ``query`` (a place in the block), ``doc_id``, ``score`` of each task's best documents."""
    spark = docs.sparkSession
    queries = [Counter(terms(text)) for _, text in block]
    vocabulary = {term: place for place, term in enumerate(sorted(set().union(*queries)))}
    rows = written(counted(docs, spark.sparkContext.broadcast(vocabulary), id_col, text_col), "term_counts")
    n_docs, all_terms = rows.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for place, n in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*")).collect():
        df[place] = n  # at most as many rows as the block has terms
    weights = np.array([weight(n_docs, int(n)) for n in df], dtype=np.int64)
    asked = [(np.array([vocabulary[t] for t in q], dtype=np.int64), np.array(list(q.values()), dtype=np.int64)) for q in queries]
    shared = spark.sparkContext.broadcast((weights, n_docs, all_terms, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *told, wanted = shared.value
        found = [Found.none() for _ in wanted]
        for shard in _shards(batches, told, postings):
            for (term, times), so_far in zip(wanted, found):
                shard.search(term, times, so_far, best)
        for query, so_far in enumerate(found):
            ids = pa.array(so_far.ids, pa.int64(), mask=so_far.ids == _NO_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array([query] * len(ids), pa.int32()), ids, pa.array(so_far.scores, pa.int64())], names=["query", "doc_id", "score"])

    return rows.filter(F.size("terms") > 0).mapInArrow(run, "query int, doc_id bigint, score bigint")


def _top(rows: DataFrame, by: list[str], best: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def search(
    docs: DataFrame, items: DataFrame, best: int = BEST, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """The ``best`` documents for each row of ``items``: ``item_id``, ``rank`` from 1 on, ``doc_id``, ``score``.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with only A-Z lower-cased. A
    term's share of a score grows with its occurrences in the document, less so in long documents, and with the
    rarity of the term among documents that have any. Terms that a query repeats count as often. Only scores
    above 0 are returned; of equal ones the smaller id comes first, a null id before all.

    Ids of documents are whole numbers. Rows of documents or items that repeat are ranked, or answered, row by
    row. A null or empty text has no terms, is not counted as a document and finds nothing; neither does an item
    whose terms no document has. No documents or no items give no rows. Other columns are not looked at.

    Items are taken in parts of about ``block_bytes`` (a longer one stays whole), with one pass over the documents
    for each; a part's terms and texts are all that the driver and every worker hold of them.
    """
    spark = docs.sparkSession
    asked = items.select(named(item_id_col).alias("item_id"), whole_text(item_text_col).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    asked = written(asked.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(count))), "items")
    out = spark.createDataFrame([], T.StructType([
        asked.schema["item_id"], *T.StructType.fromDDL("rank int, doc_id bigint, score bigint").fields]))
    for part in sorted(r["part"] for r in asked.select("part").distinct().collect()):  # no more than parts that are full
        block = [(r["item_id"], r["text"]) for r in asked.filter(F.col("part") == part).collect()]
        found = _search_block(docs, block, best, id_col, text_col, postings)
        # Tasks times `best` rows a query: cut down by parts before they meet.
        found = _top(_top(found.withColumn("some", F.pmod(F.xxhash64("doc_id"), F.lit(16))), ["query", "some"], best), ["query"], best)
        names = spark.createDataFrame(
            [(k, item) for k, (item, _) in enumerate(block)],
            f"query int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        out = out.unionByName(found.join(names, "query").select("item_id", "rank", "doc_id", "score"))
    return out
