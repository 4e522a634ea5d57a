"""Byte-level BPE by backtracking over longest matches, and its inverse.

The vocabulary is a rank file: base64 of a token's bytes, then its id. Ids order the merges. Bytes
are mapped to the characters of Latin-1, over which one Aho-Corasick automaton finds the longest
token at every position of a piece in one pass. A piece is encoded greedily by longest tokens; a token
may follow another only if merging by rank would leave both as they are, which is kept for each
pair once it is known. If a token can't follow, its next shorter prefix is tried, and then the token
before is taken back. A position that led nowhere is never entered again, so the work is linear.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .texts import ROWS, named, output_schema, ship_package, whole_text

#: Entries that a worker keeps of each memo: pieces of text, and pairs of tokens.
PIECES, PAIRS = 300_000, 400_000
#: A run of white space that may not be cut at its spaces: a space after white space, before no sign.
_INNER = regex.compile(r"\s (?!\S)")


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The rank file, by a path of the driver or of any store that Spark reads."""
    if "://" in path:
        lines = (r["value"].encode("ascii") for r in spark.read.text(path).collect())
    else:
        with open(path, "rb") as file:
            lines = file.read().splitlines()
    pairs = (line.split() for line in lines)
    return {base64.b64decode(p[0]): int(p[1]) for p in pairs if p}


class Encoder:
    """The merges of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.id_of = {b.decode("latin-1"): i for b, i in ranks.items()}
        self.trie = ahocorasick.Automaton()
        for token, i in self.id_of.items():
            self.trie.add_word(token, (len(token) - 1, i))
        self.trie.make_automaton()
        self.size_of = {i: len(b) for b, i in ranks.items()}
        #: The longest token that is a proper prefix of each token; -1 without any.
        self.shorter = {
            i: next((self.id_of[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in self.id_of), -1)
            for token, i in self.id_of.items()
        }
        self.halves: dict[int, tuple[int, int]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.old_fits: dict[tuple[int, int], bool] = {}  # what was known before the last turn of half the limit
        self.pieces = _Memo(self.chunk_ids, PIECES)

    def split(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes this one; a single byte is its own half."""
        if token not in self.halves:
            text = self.bytes_of[token]
            parts = [text[k:k + 1] for k in range(len(text))]
            ranks = self.id_of
            while len(parts) > 2:
                found = [
                    (r, k) for k in range(len(parts) - 1)
                    if (r := ranks.get((parts[k] + parts[k + 1]).decode("latin-1"))) is not None and r < token
                ]
                if not found:
                    break
                _, k = min(found)
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
            if len(parts) == 2:
                self.halves[token] = (ranks[parts[0].decode("latin-1")], ranks[parts[1].decode("latin-1")])
            else:  # a byte, or a token that merging never makes
                self.halves[token] = (token, token)
        return self.halves[token]

    def reachable(self, token: int) -> bool:
        """Whether merging makes the token at all; some rank files list others."""
        return len(self.bytes_of[token]) == 1 or self.split(token)[0] != token

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging keeps the border between two adjacent tokens.

        The merges are undone from the latest to the earliest, on the side that was made last. If at
        any time the two tokens at the border have a merge that comes before the one undone last, it
        would have happened first and removed the border.
        """
        key = (left, right)
        known = self.fits.get(key)
        if known is None and (known := self.old_fits.get(key)) is not None:
            self._know(key, known)
        if known is not None:
            return known
        bytes_of, id_of = self.bytes_of, self.id_of
        undone = 1 << 62
        while True:
            both = id_of.get((bytes_of[left] + bytes_of[right]).decode("latin-1"))
            if both is not None and both < undone:
                fits = False
                break
            parts_left, parts_right = self.split(left), self.split(right)
            whole_left, whole_right = parts_left[0] == left, parts_right[0] == right
            if whole_left and whole_right:
                fits = True
                break
            # An earlier merge wins; of one rank, the left one does.
            if not whole_left and (whole_right or left > right):
                undone, left = left, parts_left[1]
            else:
                undone, right = right + 1, parts_right[0]
        self._know(key, fits)
        return fits

    def _know(self, key: tuple[int, int], fits: bool) -> None:
        if 2 * len(self.fits) >= PAIRS:  # copied and emptied: others hold this dict by name
            self.old_fits = dict(self.fits)
            self.fits.clear()
        self.fits[key] = fits

    def piece_ids(self, piece: str) -> list[int]:
        """Ids of one match of the pattern."""
        text = piece if piece.isascii() else piece.encode("utf-8", "surrogatepass").decode("latin-1")
        whole = self.id_of.get(text)
        if whole is not None:  # a token of its own is always kept whole by the rank files' library
            return [whole]
        n = len(text)
        size, fits, prefix = self.size_of, self.fits, self.shorter
        out = [token for _, (_, token) in self.trie.iter_long(text)]
        for pair in zip(out, out[1:]):
            fit = fits.get(pair)
            if fit is None:
                fit = self.compatible(*pair)
            if not fit:
                break
        else:
            return out
        longest = [-1] * n
        for last, (more, token) in self.trie.iter(text):
            longest[last - more] = token  # later ends are longer tokens
        dead: set[int] = set()
        out: list[int] = []
        at, before, token = 0, -1, longest[0]
        while True:
            while token >= 0:
                end = at + size[token]
                if end not in dead:
                    if before < 0:
                        break
                    fit = fits.get((before, token))
                    if fit or fit is None and self.compatible(before, token):
                        break
                token = prefix[token]
            if token >= 0:
                out.append(token)
                if end == n:
                    return out
                at, before, token = end, token, longest[end]
            elif out:
                dead.add(at)
                token = out.pop()
                at -= size[token]
                before = out[-1] if out else -1
                token = prefix[token]
            else:
                raise ValueError("the vocabulary lacks a byte")

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of a stretch of text, as 32-bit numbers one after the other."""
        word = chunk[1:] if chunk[:1] == " " else chunk
        if word.isascii() and word.isalpha():  # one match of the pattern
            return array("i", self.piece_ids(chunk)).tobytes()
        parts, known = [], self.pieces.known
        for piece in self.pattern.findall(chunk):
            ids = known(piece)
            parts.append(array("i", self.piece_ids(piece)).tobytes() if ids is None else ids)
        return b"".join(parts)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text.

        The pattern never matches across a space that follows a sign or comes before one, other than
        as a match's first character; so the text is cut there, and what the pieces between give is
        kept. Texts with spaces inside longer white space are not cut.
        """
        if "\x00" in text or _INNER.search(text):
            return np.frombuffer(self.chunk_ids(text), dtype=np.int32)
        chunks = text.replace(" ", "\x00 ").split("\x00")
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, chunks)), dtype=np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def forget(self) -> None:
        for memo in (self.fits, self.old_fits, self.pieces, self.pieces.old):
            memo.clear()


class _Memo(dict):
    """A bounded memo of a function: what was not asked for since it was last half full is forgotten."""

    def __init__(self, make: Callable, most: int):
        self.make, self.most, self.old = make, most, {}

    def known(self, key):
        value = self.get(key)
        return self.old.get(key) if value is None else value

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            if 2 * len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


@lru_cache(maxsize=1)
def _encoder(key: tuple, shared) -> Encoder:
    while _kept:  # of an earlier job in this worker
        _kept.pop().forget()
    _kept.append(Encoder(shared.value, key[1]))
    return _kept[0]


_kept: list[Encoder] = []


class Vocabulary:
    """A rank file on its way to the tasks; a worker builds its encoder once and keeps it."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.key = (path, pattern)
        self.shared = spark.sparkContext.broadcast(read_ranks(spark, path))  # bounded by the vocabulary

    def encoder(self) -> Encoder:
        return _encoder(self.key, self.shared)


def encode(
    docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False,
) -> DataFrame:
    """Token ids of every whole text: ``doc_id``, ``ids`` (array of int); with ``decoded`` also the bytes
    that the ids decode to, as :func:`decode` gives them, made by the same worker.

    Null and empty texts have no ids. Every row is encoded, repeated ones too. Other columns are not
    looked at. An empty table gives no rows.
    """
    schema = output_schema(docs, id_col, "ids array<int>" + ", decoded binary" * decoded)
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = vocabulary.encoder(), to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = [encoder.encode(text) for text in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids), pa.int32()))
                columns = [part.column(0).cast(out.field(0).type), lists.cast(out.field(1).type)]
                if decoded:
                    columns.append(pa.array([encoder.decode(x.tolist()) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    texts = docs.select(named(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    return texts.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows of :func:`encode` with ``decoded``, the bytes of their ids; null ids count as none."""
    ship_package(encoded.sparkSession)
    schema = T.StructType([*encoded.select("doc_id", "ids").schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = vocabulary.encoder(), to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).tolist()
                texts, first = [], 0
                for n in part.column(1).value_lengths().to_pylist():
                    texts.append(encoder.decode(flat[first:first + (n or 0)]))
                    first += n or 0
                columns = [part.column(k).cast(out.field(k).type) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())], schema=out)

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def token_digests(decoded: DataFrame, *more: str) -> DataFrame:
    """Rows with ids and ``decoded`` as numbers of tokens and digests of ids and bytes, and ``more`` columns."""
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *more)
