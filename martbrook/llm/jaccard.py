"""N-gram Jaccard join by partitions of the universe of shingles.

Sets are taken in bands of sizes. In a band the shingles are dealt by a hash to as many segments that
two sets similar enough must agree on some: with at most H different shingles, and segments worth
V > H, at least V - H of that worth stays untouched. A segment of weight 1 is indexed by the subset of
the set that falls into it, one of weight 2 by the subset and all subsets with one shingle less, which
still meet if one shingle differs. Which weights a band gets is a matter of cost, from the number
of its sets.

Of all subsets of a set those that say least (few shingles, frequent ones not counted) need no entry:
a set may leave out V - d - 1 of them, d being what can differ from any similar set, as long as all
sets leave out by the same order. Sets that share an entry are candidates, which are compared exactly
by their words.

Links are needed up to connection, so no group of candidates is expanded into pairs while its sets are
connected already: rounds link each set to one other of its groups, and only what then lies in
different components is compared pair by pair.
"""

from __future__ import annotations

import itertools
import math
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import work_dir
from .components import components
from .id_filter import may_contain, place_test
from .texts import ROWS, named, output_schema, ship_package, whole_text

_U = np.uint64
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Places in which a task counts shingles, to find frequent ones.
COUNTER_BITS = 22
#: Rounds of linking sets to one other go on until no more pairs than rows are left to compare, or the pairs
#: hardly get fewer: a round leaves more than this share of them.
HARDLY = 0.9
SET_ID = "struct<hash: bigint, size: int>"


@dataclass(frozen=True)
class Join:
    """``words`` to a shingle; a link is percent * union <= 100 * intersection."""

    words: int = 4
    percent: int = 85
    seed: int = 0

    def most_apart(self, a: int, b: int) -> int:
        """How many shingles may differ between linked sets of these sizes."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def largest(self, size: int) -> int:
        """The largest set that a set can be linked to."""
        return 100 * size // self.percent

    def apart_from_any(self, size: int) -> int:
        return self.most_apart(size, self.largest(size))


# --- sets --------------------------------------------------------------------------
def text_words(text: str) -> list[bytes]:
    """Words in UTF-8: runs without white space of ASCII, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingles(text: str, n: int) -> set:
    """The distinct runs of n words; all words as one where there are fewer, none without words."""
    words = text_words(text)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(n))))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def hashed_shingles(text: str, n: int, seed: int) -> np.ndarray:
    """64-bit hashes of the distinct shingles, sorted."""
    words = text_words(text)
    if not words:
        return np.zeros(0, dtype=_U)
    digest = xxhash.xxh3_64_intdigest
    if len(words) < n:
        return np.array([digest(b" ".join(words), seed + len(words))], dtype=_U)
    hashes = np.fromiter(map(digest, words), dtype=_U, count=len(words))
    many = len(words) - n + 1
    total = np.full(many, seed, dtype=_U)
    for k in range(n):
        total += hashes[k:k + many] * _multiplier(k)
    return np.unique(mixed(total))


@lru_cache(maxsize=64)
def _multiplier(k: int) -> np.uint64:
    return mixed(np.array([k + 1], dtype=_U))[0] | _U(1)


def set_hash(found: np.ndarray) -> int:
    return int(mixed(np.array([found.sum(dtype=_U)], dtype=_U)).view(np.int64)[0])


def sketch(found: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each of the 1024 places, as 16 numbers. Sets differ in
    at least as many shingles as their sketches do in bits."""
    odd = np.bincount((found >> _U(54)).astype(np.int64), minlength=1024) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


# --- bands and segments --------------------------------------------------------------
def band_limits(join: Join, up_to: int) -> list[int]:
    """First sizes of the bands. A band's sets can be linked to its own and the next band only."""
    limits = [1]
    while limits[-1] <= up_to:
        first = limits[-1]
        limits.append(max(first + 1, 3 * first // 2, join.largest(first) + 1))
    return limits


@dataclass(frozen=True)
class Band:
    """How the pairs whose smaller set is in this band are found."""

    number: int
    first: int
    last: int
    ones: int  # segments of weight 1
    twos: int  # segments of weight 2

    @property
    def worth(self) -> int:
        return self.ones + 2 * self.twos


def allocate(join: Join, number: int, first: int, last: int, sets: int) -> Band:
    """The weights with the least cost: entries to write, and sets met by chance.

    A tenth of the worth is added beyond what is needed, so that sets can leave out more. By chance
    two subsets of k shingles are taken to be equal with a probability of CHANCE to the power k.
    """
    need = join.apart_from_any(last) + 1
    worth = need + need // 10
    size = (first + last) / 2

    def cost(twos: int) -> float:
        ones = max(0, worth - 2 * twos)
        each = size / (ones + twos)
        entries = ones + twos * (each + 1)
        met = sets * (ones * CHANCE ** each + twos * (each + 1) * CHANCE ** max(0.0, each - 1))
        return entries + met * PAIR_COST

    # Mixed allocations lie between; all of one kind and a quarter steps are enough to choose from.
    options = sorted({round(q * worth / 8) for q in range(5)} | {math.ceil(worth / 2)})
    twos = min(options, key=cost)
    return Band(number, first, last, max(0, worth - 2 * twos), twos)


#: Assumed chance that two sets share a shingle, and the cost of a pair met in entries written.
CHANCE, PAIR_COST = 0.02, 5.0


def entries(join: Join, band: Band, found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """What a set with these hashed shingles is indexed by for one band."""
    n, segments = len(found), band.ones + band.twos
    salt, names = _names(join.seed, band.number, segments)
    marks = mixed(found ^ salt)
    where = (((marks >> _U(32)) * _U(segments)) >> _U(32)).astype(np.int64)
    rare = ~frequent
    sums, sizes = np.zeros(segments, dtype=_U), np.bincount(where[rare], minlength=segments)
    np.add.at(sums, where, marks)
    keys, says = mixed(sums + names), sizes
    if band.twos:  # the first segments are those of weight 2
        two = where < band.twos
        less = mixed(sums[where[two]] - marks[two] + names[where[two]])
        empty = np.flatnonzero(np.bincount(where, minlength=segments)[:band.twos] == 0)
        again = mixed(~names[empty])  # an empty subset is worth 2 as well
        keys = np.concatenate([keys, less, again])
        says = np.concatenate([says, sizes[where[two]] - rare[two], np.zeros(len(empty), dtype=np.int64)])
    # What can differ from a linked set, where the smaller of both is in this band.
    apart = join.apart_from_any(n) if n <= band.last else join.most_apart(band.last, n)
    left_out = band.worth - apart - 1
    if left_out > 0:
        keys = keys[np.lexsort((keys, says))[left_out:]]
    return keys


@lru_cache(maxsize=4096)
def _names(seed: int, band: int, segments: int) -> tuple[np.uint64, np.ndarray]:
    """What tells the bands and their segments apart."""
    salt = mixed(np.array([band + 1 + (seed << 20)], dtype=_U))[0]
    return salt, mixed(np.arange(segments, dtype=_U) + salt)


def of_set(join: Join, bands: list[Band], found: np.ndarray, frequent: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """Entries of a set, and whether it is in the band itself or only linked to it from the next."""
    n = len(found)
    number = bisect_right(bands, n, key=lambda b: b.first) - 1
    yield entries(join, bands[number], found, frequent), True
    if number and join.largest(bands[number - 1].last) >= n:
        yield entries(join, bands[number - 1], found, frequent), False


# --- jobs --------------------------------------------------------------------------
def _stored(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def document_sets(docs: DataFrame, join: Join, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``hash`` and ``size`` of each document's set; also rows with a ``place`` only, the
    hashed shingles that a task has met far more often than their share."""
    schema = T.StructType([*output_schema(docs, id_col, "hash bigint, size int").fields, T.StructField("place", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        counts, met = np.zeros(1 << COUNTER_BITS, dtype=np.int32), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                hashes, sizes = [], []
                for text in part.column(1).to_pylist():
                    found = hashed_shingles(text, join.words, join.seed)
                    places = (found >> _U(64 - COUNTER_BITS)).astype(np.int64)
                    counts[places] += 1
                    met += len(found)
                    hashes.append(set_hash(found))
                    sizes.append(len(found))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(out.field(0).type), pa.array(hashes, pa.int64()), pa.array(sizes, pa.int32()),
                     pa.nulls(len(sizes), pa.int64())], schema=out)
        share = met / len(counts)
        often = np.flatnonzero(counts >= max(8, share + 6 * math.sqrt(share)))
        for at in range(0, len(often), 100_000):
            some = pa.array(often[at:at + 100_000], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(some), out.field(0).type), pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int32()), some], schema=out)

    ship_package(docs.sparkSession)
    return docs.select(named(id_col).alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, schema)


def _bitmap(places: DataFrame) -> np.ndarray:
    """Places as bits; of fixed size."""
    place = F.col("place") + 1
    rows = places.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    bits = np.zeros(1 << COUNTER_BITS, dtype=bool)
    for row in rows:
        part = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8), bitorder="little")
        bits[(row["bucket"] - 1) * len(part):row["bucket"] * len(part)] = part
    return bits


def _bands(join: Join, sets: DataFrame) -> list[Band]:
    """Bands for all sizes, with weights for the number of sets in each. One row a band is read."""
    top = sets.agg(F.max("size")).first()[0] or 0
    limits = band_limits(join, top)
    number = F.lit(0)
    for n, first in enumerate(limits):
        number = F.when(F.col("size") >= first, F.lit(n)).otherwise(number)
    counts = {r["band"]: r["n"] for r in sets.filter("size > 0").groupBy(number.alias("band")).agg(F.count("*").alias("n")).collect()}
    return [
        allocate(join, n, first, after - 1, counts.get(n, 0) + counts.get(n + 1, 0))
        for n, (first, after) in enumerate(zip(limits, limits[1:]))
    ]


def index_entries(docs: DataFrame, join: Join, bands: list[Band], frequent: np.ndarray, text_col: str) -> DataFrame:
    """``entry``, and by ``hash`` and ``size`` the set that has it; ``own`` if the set is in the entry's
    band itself. A task writes equal sets once."""
    schema = T.StructType.fromDDL("entry bigint, hash bigint, size int, own boolean")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((bands, np.packbits(frequent)))  # both of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, (bands, packed) = to_arrow_schema(schema), shared.value
        often, seen = np.unpackbits(packed).astype(bool), set()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS // 4):
                parts, names, sizes, owns = [], [], [], []
                for text in batch.column(0).slice(at, ROWS // 4).to_pylist():
                    found = hashed_shingles(text, join.words, join.seed)
                    name = set_hash(found)
                    if not len(found) or (name, len(found)) in seen:
                        continue
                    seen.add((name, len(found)))
                    known = often[(found >> _U(64 - COUNTER_BITS)).astype(np.int64)]
                    for keys, own in of_set(join, bands, found, known):
                        parts.append(keys)
                        names.append(name)
                        sizes.append(len(found))
                        owns.append(own)
                if parts:
                    many = [len(p) for p in parts]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.repeat(np.array(names, dtype=np.int64), many)),
                        pa.array(np.repeat(np.array(sizes, dtype=np.int32), many)), pa.array(np.repeat(owns, many))], schema=out)

    ship_package(spark)
    return docs.select(whole_text(text_col).alias("text")).mapInArrow(run, schema)


def shared_entries(index: DataFrame) -> DataFrame:
    """Rows of the index whose entry two or more different sets have.

    Rows come sorted by entry, so a task only holds a batch and the last row; groups of any size pass
    through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, if it is not known yet whether it is alone
        last_entry = last_hash = last_size = None
        grouped = False  # whether the last entry has been found to be shared
        for batch in batches:
            if not batch.num_rows:
                continue
            entry, name, size = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            same = np.zeros(len(entry), dtype=bool)  # entry equal to the row before
            same[1:] = entry[1:] == entry[:-1]
            again = same.copy()  # the same set once more
            again[1:] &= (name[1:] == name[:-1]) & (size[1:] == size[:-1])
            if last_entry is not None:
                same[0] = entry[0] == last_entry
                again[0] = same[0] and name[0] == last_hash and size[0] == last_size
            new = ~again
            joined = same & new  # differs from the row before but for the entry
            group = np.cumsum(~same)
            hit = np.zeros(group[-1] + 1, dtype=bool)
            hit[group[joined]] = True
            first_goes_on = bool(same[0])
            if first_goes_on and grouped:
                hit[group[0]] = True
            if held is not None and first_goes_on and hit[group[0]]:
                yield held
            keep = new & hit[group]
            if keep.any():
                yield batch.filter(pa.array(keep))
            last_entry, last_hash, last_size = entry[-1], name[-1], size[-1]
            grouped = bool(hit[group[-1]])
            if grouped:
                held = None
            elif group[-1] != 0 or not first_goes_on:  # a new group began in this batch
                held = batch.slice(int(np.flatnonzero(~same)[-1]), 1)
        return

    ordered = index.repartition("entry").sortWithinPartitions("entry", "hash", "size")
    return ordered.mapInArrow(run, index.schema)


def verified(pairs: DataFrame, texts: DataFrame, join: Join) -> DataFrame:
    """Links (a, b) among candidate pairs of sets, by the words of one text of each."""
    schema = T.StructType.fromDDL(f"a {SET_ID}, b {SET_ID}")
    one = texts.select(F.col("set").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("set").alias("b"), F.col("text").alias("text_b"))
    n, percent = join.words, join.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: OrderedDict[str, set] = OrderedDict()

        def of(text: str) -> set:
            found = memo.pop(text, None)
            if found is None:
                found = shingles(text, n)
                if len(memo) >= 16:
                    memo.popitem(last=False)
            memo[text] = found
            return found

        for batch in batches:
            keep = []
            for text_a, text_b in zip(batch.column(2), batch.column(3)):
                a, b = of(text_a.as_py()), of(text_b.as_py())
                both = len(a & b)
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    ship_package(pairs.sparkSession)
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, schema)


def linked_sets(docs: DataFrame, join: Join, sets: DataFrame, frequent: np.ndarray, folder: str, id_col: str, text_col: str) -> DataFrame:
    """``node`` and ``least`` of each set that is linked to another one."""
    spark = docs.sparkSession
    bands = _bands(join, sets)
    none = spark.createDataFrame([], f"node {SET_ID}, least {SET_ID}")
    if not bands:
        return none
    shared = _stored(shared_entries(index_entries(docs, join, bands, frequent, text_col)), f"{folder}/shared")
    shared = shared.select("entry", F.struct("hash", "size").alias("set"), "own")
    if shared.isEmpty():
        return none
    texts = _stored(_texts(docs, join, sets, shared, id_col, text_col), f"{folder}/texts")

    links, groups, found, before = None, shared, none, None
    for turn in itertools.count():
        best = _to_centres(groups, turn, join, texts)
        new = _stored(verified(best, texts, join), f"{folder}/links{turn}")
        links = new if links is None else links.unionByName(new)
        found = _stored(components(links), f"{folder}/found{turn}")
        groups = _stored(_mixed(groups, found), f"{folder}/mixed{turn}")
        sizes = groups.groupBy("entry", "least").agg(F.count("*").alias("n")).groupBy("entry").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside"))
        across, rows = sizes.agg(F.sum((F.col("n") * F.col("n") - F.col("inside")) / 2), F.sum("n")).first()
        if not across:
            return found
        if across <= rows or before is not None and across > HARDLY * before:
            break  # few are left, or what is left over is hardly linked at all
        before = across
    rest = _stored(verified(_across(groups, join, texts), texts, join), f"{folder}/rest")
    if rest.isEmpty():
        return found
    return _stored(components(links.unionByName(rest)), f"{folder}/found")


def _texts(docs: DataFrame, join: Join, sets: DataFrame, shared: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One document's text for each set of ``shared``, and its sketch."""
    one = sets.filter("size > 0").groupBy(F.struct("hash", "size").alias("set")).agg(F.min(F.struct("doc_id")).alias("first"))
    one = one.join(shared.select("set").distinct(), "set", "left_semi").select("set", F.col("first.doc_id").alias("first"))
    wanted = _stored(one, work_dir(docs.sparkSession, "jaccard_wanted"))
    place, make = place_test(wanted, "first")
    schema = output_schema(docs, id_col, f"set {SET_ID}, text string, sketch array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, wanted_at = to_arrow_schema(schema), make()
        for batch in batches:
            batch = batch.filter(pa.array(wanted_at(batch.column(2).to_numpy())))
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = [hashed_shingles(text, join.words, join.seed) for text in part.column(1).to_pylist()]
                names = [{"hash": set_hash(x), "size": len(x)} for x in found]
                yield pa.RecordBatch.from_arrays([
                    part.column(0).cast(out.field(0).type), pa.array(names, out.field(1).type),
                    part.column(1).cast(out.field(2).type), pa.array([sketch(x).tolist() for x in found], out.field(3).type)], schema=out)

    rows = docs.select(named(id_col).alias("doc_id"), whole_text(text_col).alias("text"), place(named(id_col)).alias("place"))
    rows = rows.mapInArrow(run, schema)  # the set again, should an id have several texts
    wanted = wanted.withColumnRenamed("set", "wanted")
    return rows.join(wanted, (F.col("set") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("first"))).select("set", "text", "sketch")


def _may_link(join: Join) -> Column:
    """Whether sets a and b can be linked by their sizes and sketches."""
    a, b = F.col("a.size"), F.col("b.size")
    sizes = F.greatest(a, b) * join.percent <= F.least(a, b) * 100
    differ = F.lit(0)
    for k in range(16):
        differ = differ + F.bit_count(F.get("sketch_a", F.lit(k)).bitwiseXOR(F.get("sketch_b", F.lit(k))))
    return sizes & (differ * (100 + join.percent) <= (a + b) * (100 - join.percent))


def _to_centres(groups: DataFrame, turn: int, join: Join, texts: DataFrame) -> DataFrame:
    """Each set with the centre that it shares most entries with, of those it can be linked to. The centre
    of an entry's sets is the one that comes first by a hash, another in each turn; sets connected
    to it already are left out."""
    order = F.xxhash64("set", F.lit(turn))
    chosen = ["least"] if "least" in groups.columns else []
    centre = groups.groupBy("entry").agg(F.min(F.struct(order.alias("order"), "set", *chosen)).alias("c"))
    pairs = groups.join(centre, "entry").filter(F.col("set") != F.col("c.set"))
    if chosen:
        pairs = pairs.filter(F.col("least") != F.col("c.least"))
    counted = pairs.groupBy(F.col("set").alias("a"), F.col("c.set").alias("b")).agg(F.count("*").alias("n"))
    counted = counted.join(texts.select(F.col("set").alias("a"), F.col("sketch").alias("sketch_a")), "a").join(
        texts.select(F.col("set").alias("b"), F.col("sketch").alias("sketch_b")), "b").filter(_may_link(join))
    return counted.groupBy("a").agg(F.max(F.struct("n", "b")).alias("best")).select("a", F.col("best.b").alias("b"))


def _mixed(groups: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the entries whose sets are in more than one component."""
    of = groups.select("entry", "set", "own").join(found.withColumnRenamed("node", "set"), "set", "left")
    of = of.withColumn("least", F.coalesce("least", "set"))
    several = of.groupBy("entry").agg(F.min("least").alias("one"), F.max("least").alias("other")).filter("one != other")
    return of.join(several.select("entry"), "entry", "left_semi").select("entry", "set", "own", "least")


def _across(groups: DataFrame, join: Join, texts: DataFrame) -> DataFrame:
    """Pairs of sets that share an entry, can be linked and are in different components. What can't be
    linked is left out inside the join."""
    rows = groups.join(texts.select("set", "sketch"), "set")
    one, two = (rows.select("entry", *(F.col(c).alias(f"{name}_{side}") if name else F.col(c).alias(side) for c, name in (
        ("set", ""), ("own", "own"), ("least", "least"), ("sketch", "sketch")))) for side in "ab")
    pairs = one.join(two, "entry").filter((F.col("a") < F.col("b")) & (F.col("least_a") != F.col("least_b")))
    return pairs.filter(F.col("own_a") | F.col("own_b")).filter(_may_link(join)).select("a", "b").distinct()


def similar_documents(
    docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The component of each document under links of a Jaccard similarity of ``join.percent`` or more.

    Returns per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the least id that is
    reachable by links, its own included. Null and empty texts and texts without words have no
    shingles and no links; texts with fewer words than a shingle have one, all their words. Documents
    with equal sets are one class, whose members are all linked. Repeated rows are returned each. A null
    id comes before all others. Other columns are not looked at; no rows give no rows.

    Sets are told apart by a 64-bit hash and their size, shingles of one text by 64 bits; links between
    different sets are decided by the words. ``docs`` must give the same rows each time it is read.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "jaccard")
    first = _stored(document_sets(docs, join, id_col, text_col), f"{folder}/sets")
    frequent = _bitmap(first.filter("place IS NOT NULL"))
    sets = first.filter("size IS NOT NULL").select("doc_id", "hash", "size")
    found = linked_sets(docs, join, sets, frequent, folder, id_col, text_col)
    keyed = sets.withColumn("set", F.struct("hash", "size"))
    classes = keyed.filter("size > 0").groupBy("set").agg(F.min(F.struct("doc_id")).alias("first"))
    classes = classes.join(found.withColumnRenamed("node", "set"), "set", "left").withColumn("least", F.coalesce("least", "set"))
    tops = classes.groupBy("least").agg(F.min("first").alias("top"))
    classes = _stored(classes.join(tops, "least").select("set", "top"), f"{folder}/classes")
    rows = keyed.join(classes, "set", "left")
    return rows.select(
        "doc_id", F.col("size").cast("bigint").alias("n_shingles"),
        F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that a component has besides the one with its least id; columns as
    they were. Rows that repeat an id stay or go together, but for the class of texts without words."""
    found = similar_documents(docs, join, id_col, text_col)
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__gone"))
    gone = _stored(gone, work_dir(docs.sparkSession, "jaccard_gone"))
    may_go = may_contain(gone, "__gone")(named(id_col))
    some = docs.filter(may_go).join(gone, named(id_col).eqNullSafe(F.col("__gone")), "left_anti")
    return docs.filter(~may_go).unionByName(some)
