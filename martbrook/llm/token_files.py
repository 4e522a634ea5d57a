"""Token ids in files: range-coded blocks with an index of documents, in order of document ids.

A file holds the documents of one range of ids, in order:

    magic (8 bytes), documents, ids, blocks (64-bit numbers)
    index: its size and CRC-32 (64-bit numbers), then zlib-compressed JSON of [document ids, numbers of ids]
    a line for each block: number of ids, CRC-32 of the ids, bytes (32-bit numbers)
    the data of the blocks

All numbers are little-endian. Blocks run across documents, so short texts share one.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from ..session import work_dir
from .range_coder import BLOCK, checksum, decode_blocks, encode_blocks
from .texts import file_system, named, ship_package, whole_text

# Fixed value: the mark at the start of a file.
MAGIC = b"MBIDRC2\n"
#: Ids from which a task begins another file; bounds its memory. A file's blocks are coded side by side.
FILE_IDS = 7 * 1024 * 1024
#: Pieces of text whose ids a worker keeps, and bytes of text that it tokenises at once, by whole texts.
PIECES, TEXT_BYTES = 1_000_000, 20 * 1024 * 1024

#: Bytes that are looked at at once for places to cut, two at least.
WINDOW = 128 * 1024


def _kinds() -> bytes:
    """The kind of each byte of UTF-8; 0 stands for signs, white space for one, that nothing is said of."""
    kinds = bytearray(256)
    for byte in range(128, 256):
        kinds[byte] = _HIGH
    for byte in range(33, 127):
        kinds[byte] = _LETTER if chr(byte).isalpha() else _DIGIT if chr(byte).isdigit() else _SIGN
    kinds[ord(" ")], kinds[ord("\n")], kinds[0xC3] = _SPACE, _LINE, _LATIN
    kinds[0x97] = kinds[0xB7] = _TIMES
    return bytes(kinds)


# Latin: the first byte of U+00C0 to U+00FF, all letters but the signs for times and divided, which end in bytes of their own.
_SPACE, _LETTER, _SIGN, _LINE, _LATIN, _HIGH, _TIMES, _DIGIT = 1, 2, 4, 8, 16, 32, 64, 128
_KINDS = _kinds()
_WORD, _SEEN, _ABOVE = _LETTER | _DIGIT, _LETTER | _DIGIT | _SIGN, _HIGH | _TIMES
_FIRM = _SEEN | _LATIN


def _spelling() -> np.ndarray:
    """The character of each byte in the spelling of byte-level tokens; a line's end for 0xFF, which UTF-8 never has."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    table = np.zeros(256, np.uint32)
    table[shown], table[hidden] = shown, 256 + np.arange(len(hidden))
    table[0xFF] = ord("\n")
    return table


_SPELLED = _spelling()
MANIFEST = "part bigint, number bigint, file string, n_docs bigint, n_ids bigint"


# --- ids ------------------------------------------------------------------------
class TextIds:
    """Ids of texts by the tokenizers library, without special tokens.

    Texts are cut where byte-level pre-tokenisation always begins anew, whatever stands around, so that a piece has
    the same ids everywhere; each different piece of many texts is looked up, or tokenised, once. Tokenizers that
    do not pre-tokenise so get whole texts.
    """

    def __init__(self, model: str):
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        spec = json.loads(model)
        before = spec.get("pre_tokenizer") or {}
        self.cut = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not (
            before.get("add_prefix_space", True) or spec.get("normalizer")
            or not all(token["special"] for token in spec.get("added_tokens", ())))
        #: The same merges for words that are one match as they are, spelled as tokens are.
        self.words = Tokenizer.from_str(json.dumps({**spec, "pre_tokenizer": None, "added_tokens": []}))
        vocabulary = self.tokenizer.get_vocab()
        #: Bytes of each token: its spelling has a character for each.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)
        #: Pieces, their ids one after another, where these end, and in how many calls a piece was met of late.
        self.known = pa.array([], pa.binary())
        self.ids, self.ends, self.uses = np.zeros(0, np.uint32), np.zeros(1, np.int32), np.zeros(0, np.int32)

    def __call__(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.cut:
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            return [np.array(x.ids, np.uint32) for x in found]
        pieces, first = _pieces(texts.cast(pa.binary()))
        coded = pieces.dictionary_encode()
        at = self._places(coded.dictionary).take(coded.indices.to_numpy())
        ids, ends = _taken(self.ids, self.ends, at)
        return np.split(ids, ends.take(first[1:-1])) if len(texts) else []

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where these pieces stand among the known ones, which they become."""
        if len(self.known) > PIECES:
            self._forget()
        at = pc.index_in(pieces, value_set=self.known).fill_null(-1).to_numpy().copy()
        new = np.flatnonzero(at < 0)
        at[new] = len(self.known) + np.arange(len(new))
        pieces = pieces.take(pa.array(new))
        ids, ends = self._encode(pieces)
        self.ids, self.ends = np.append(self.ids, ids), np.append(self.ends, self.ends[-1] + ends[1:])
        self.known = pa.concat_arrays([self.known, pieces])
        self.uses = np.append(self.uses, np.zeros(len(new), np.int32))
        self.uses[at] += 1
        return at

    def _forget(self) -> None:
        """Keep the half that was met most, of those met again."""
        stay = np.argsort(-self.uses, kind="stable")[:PIECES // 2]
        stay = stay[self.uses[stay] > 1]
        self.ids, self.ends = _taken(self.ids, self.ends, stay)
        self.known, self.uses = self.known.take(pa.array(stay)), self.uses[stay] // 2

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after another, and where those of each begin and end."""
        data, off = _buffers(pieces)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(1, np.int32)
        kinds = np.frombuffer(data.tobytes().translate(_KINDS) + bytes(2), np.uint8)
        begin, second, last, before = (kinds.take(x) for x in (off[:-1], off[:-1] + 1, off[1:] - 1, off[1:] - 2))
        # Letters, the first byte aside, which may be a space.
        other = (kinds & (_LETTER | _LATIN) == 0)
        other[1:] &= (kinds[1:] != _HIGH) | (kinds[:-1] != _LATIN)
        other = np.cumsum(np.append(False, other))
        word = (other.take(off[1:]) == other.take(off[:-1] + 1)) & (begin & (_SPACE | _LETTER) > 0)
        # White space before a sign, after a sign: cut out of one long text again, at the bytes.
        closed = (last & _SEEN > 0) | (before == _LATIN) & (last & _ABOVE > 0)
        joined = ~word & (np.diff(off) > 1) & (begin & (_SPACE | _LINE) > 0) & (second & _FIRM > 0) & closed
        alone = ~word & ~joined
        sizes, parts = [], []
        for some, encode in ((word, self._of_words), (joined, self._of_text)):
            found = pieces.take(pa.array(np.flatnonzero(some)))
            if len(found):
                ids = np.array(encode(found), dtype=np.uint32)
                at, ends = np.cumsum(self.sizes.take(ids)), _buffers(found)[1][1:]
                end = np.searchsorted(at, ends)
                if at[-1] != ends[-1] or not (at.take(end) == ends).all():
                    raise ValueError("a token runs across pieces")
                sizes.append(np.diff(end, prepend=-1))
                parts.append(ids)
        texts = [p.decode("utf-8") for p in pieces.take(pa.array(np.flatnonzero(alone))).to_pylist()]
        found = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes.append(np.array(list(map(len, found)), np.int64))
        # Back into the order of the pieces.
        order = np.concatenate([np.flatnonzero(some) for some in (word, joined, alone)])
        ends = np.cumsum(np.concatenate([[0], *sizes]))
        return _taken(np.concatenate([*parts, *found]), ends, np.argsort(order))

    def _of_words(self, words: pa.Array) -> list[int]:
        spelled = np.frombuffer(b"\xff".join(words.to_pylist()), np.uint8)
        words = _SPELLED.take(spelled).astype("<u4").tobytes().decode("utf-32-le").split("\n")
        return self.words.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids

    def _of_text(self, pieces: pa.Array) -> list[int]:
        text = _buffers(pieces)[0].tobytes().decode("utf-8")
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


def _taken(values: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of values, given by where they begin and end, some, one after another, and where these begin and end."""
    runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values)).take(pa.array(at))
    return runs.flatten().to_numpy(), runs.offsets.to_numpy()


def _buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array without nulls, and where its values begin and end in them."""
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(array.buffers()[1], np.int32)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data else np.zeros(0, np.uint8), off - off[0]


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces of texts in UTF-8, and for each text, and the end, how many pieces come before it.

    A piece begins with a text; at a space after a sign, which a match may begin with but not take in later (after a
    sign that may be white space, if the next one is none); at a line's end after a sign; and at an ASCII sign after a
    letter or digit of ASCII or Latin-1: no match takes both.
    """
    data, off = _buffers(texts)
    cut = np.empty(len(data), bool)
    for at in range(0, len(data), WINDOW):  # with two bytes before it and one after it
        kinds = data[max(0, at - 2):at + WINDOW + 1].tobytes().translate(_KINDS)
        kinds = np.frombuffer(bytes(2 if at == 0 else 0) + kinds + bytes(at + WINDOW >= len(data)), np.uint8)
        before, last, here, then = kinds[:-3], kinds[1:-2], kinds[2:-1], kinds[3:]
        high, seen = last & _ABOVE > 0, last & _SEEN > 0
        some = cut[at:at + WINDOW]
        np.logical_and(here == _SPACE, seen | high & (then & _FIRM > 0), out=some)
        some |= (here == _LINE) & seen
        some |= (here == _SIGN) & ((last & _WORD > 0) | (last == _HIGH) & (before == _LATIN))
    cut[off[:-1][np.diff(off) > 0]] = True
    at = np.flatnonzero(cut)
    ends = np.append(at, len(data)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    return pieces, np.searchsorted(at, off)


@lru_cache(maxsize=2)
def _text_ids(key: str, shared) -> TextIds:
    return TextIds(shared.value)


# --- files ----------------------------------------------------------------------
def pack(doc_ids: list[str | None], ids: list[np.ndarray], block: int = BLOCK) -> bytes:
    """A file of these documents."""
    flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint32)
    blocks = encode_blocks(flat, block)
    index = zlib.compress(json.dumps([doc_ids, [len(x) for x in ids]]).encode("ascii"), 6)
    lines = b"".join(struct.pack("<III", n, check, len(data)) for n, check, data in blocks)
    return b"".join([
        MAGIC, struct.pack("<QQQ", len(doc_ids), len(flat), len(blocks)),
        struct.pack("<QQ", len(index), zlib.crc32(index)), index, lines, *(data for _, _, data in blocks)])


def unpack(data: bytes, block: int = BLOCK) -> tuple[list[str | None], list[np.ndarray]]:
    """Documents and their ids; raises ValueError if anything is damaged."""
    if data[:8] != MAGIC:
        raise ValueError("not a file of token ids")
    n_docs, n_ids, n_blocks = struct.unpack("<QQQ", data[8:32])
    size, check = struct.unpack("<QQ", data[32:48])
    at = 48 + size
    if zlib.crc32(data[48:at]) != check:
        raise ValueError("the index is damaged")
    doc_ids, counts = json.loads(zlib.decompress(data[48:at]))
    lines = [struct.unpack("<III", data[at + 12 * k:at + 12 * k + 12]) for k in range(n_blocks)]
    at += 12 * n_blocks
    blocks = []
    for n, check, length in lines:
        blocks.append((n, check, data[at:at + length]))
        at += length
    flat = decode_blocks(blocks, block)
    if len(flat) != n_ids or sum(counts) != n_ids or len(doc_ids) != n_docs:
        raise ValueError("the index and the blocks differ")
    return doc_ids, np.split(flat, np.cumsum(counts)[:-1]) if counts else []


def read_model(spark: SparkSession, path: str) -> str:
    """A tokenizer file, by a path of the driver or of any store that Spark reads."""
    if "://" in path:
        return spark.read.text(path, wholetext=True).first()["value"]
    with open(path, encoding="utf-8") as file:
        return file.read()


def write_ids(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Tokenise every whole text, append ``end_id``, and write the ids to files in ascending order of
    document ids. Returns the list of files, which is stored: part, number, file, n_docs, n_ids.

    Null texts are empty: they have the end id only. A null id comes first; rows that repeat an id are
    ordered by a hash of their text. Other columns are not looked at. Tasks write files of their own
    under ``folder``; files of failed or repeated tasks are in no list.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(read_model(spark, tokenizer))  # bounded by the vocabulary
    rows = docs.select(named(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows = rows.select(F.spark_partition_id().cast("bigint").alias("part"), F.col("doc_id").cast("string").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, files = _text_ids(tokenizer, shared), []
        doc_ids, ids, held, part = [], [], 0, 0

        def close() -> None:
            name = f"{folder}/{uuid.uuid4().hex}.ids"
            system, path = file_system(name)
            with system.open_output_stream(path) as out:
                out.write(pack(doc_ids, ids))
            files.append((part, len(files), name, len(doc_ids), held))

        for batch in batches:
            ends, at = np.cumsum(np.append(0, pc.binary_length(batch.column(2)).to_numpy())), 0
            while at < batch.num_rows:
                full = int(np.searchsorted(ends, ends[at] + TEXT_BYTES, "right")) - 1
                some = batch.slice(at, max(1, full - at))
                at += some.num_rows
                part = some.column(0)[0].as_py()
                for doc_id, found in zip(some.column(1).to_pylist(), of(some.column(2))):
                    doc_ids.append(doc_id)
                    ids.append(np.append(found, np.uint32(end_id)))
                    held += len(found) + 1
                    if held >= file_ids:
                        close()
                        doc_ids, ids, held = [], [], 0
        if doc_ids:
            close()
        if files:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*files)], ["part", "number", "file", "n_docs", "n_ids"])

    system, path = file_system(folder)
    system.create_dir(path)
    rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_ids(manifest: DataFrame, id_type: T.DataType, make: Callable[[np.ndarray], tuple] | None = None,
             result: str = "ids array<bigint>") -> DataFrame:
    """Documents of the files of a list: ``doc_id``, ``start`` (ids of all documents before it) and what
    ``make`` returns of a document's ids (they themselves, if not given). A task reads a file at a time."""
    spark = manifest.sparkSession
    ship_package(spark)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # Running totals over parts (one row a task), then within a part.
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("first"))
    inside = F.coalesce(F.sum("n_ids").over(before.partitionBy("part").orderBy("number")), F.lit(0))
    placed = manifest.withColumn("inside", inside).join(parts, "part").select("file", (F.col("first") + F.col("inside")).alias("start"))
    schema = T.StructType([*T.StructType.fromDDL("doc_id string, start bigint").fields, *T.StructType.fromDDL(result).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        of = make or (lambda ids: (ids,))
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, path = file_system(name)
                with system.open_input_file(path) as file:
                    doc_ids, ids = unpack(file.read())
                starts = start + np.cumsum([0, *map(len, ids)])[:-1]
                for at in range(0, len(ids), 4096):
                    columns = zip(*(of(x) for x in ids[at:at + 4096]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), f.type) for c, f in zip([doc_ids[at:at + 4096], starts[at:at + 4096], *columns], out)], schema=out)

    # A task for each file: these rows are too small for Spark to judge the work by their size.
    read = placed.repartitionByRange(max(1, manifest.count()), "start").mapInArrow(run, schema)
    return read.withColumn("doc_id", F.col("doc_id").cast(id_type))


def id_checksums(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents written as ids and read back: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``."""
    manifest = write_ids(docs, work_dir(docs.sparkSession, "token_ids"), tokenizer, end_id, id_col, text_col)
    return read_ids(manifest, docs.schema[id_col].dataType, lambda ids: (len(ids), checksum(ids)), "n_tokens bigint, ids_crc32 bigint")
