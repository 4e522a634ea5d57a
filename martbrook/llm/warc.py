"""Web archives in ZIP packages: written by tasks to the shared folder, read by ranges of bytes.

A package holds two members, stored without compression: ``archive/data.warc.gz``, whose
records are compressed one by one, and ``indexes/index.cdx``, one line of JSON a record with its place in
the first member. The reader finds the members through the end record (plain or ZIP64) and the central
directory, reads the index, and then just the bytes of records; nothing is unpacked to disk.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import work_dir
from .texts import file_system, named, ship_package, whole_text

#: Payloads from so many bytes on are written once.
REVISIT_BYTES = 1000
#: Compressed record bytes from which a task begins another package.
PACKAGE_BYTES = 128 << 20
#: Bytes that the reader fetches at once, if records lie next to each other.
FETCH_BYTES = 4 << 20

# Names, signatures and layouts of the ZIP and WARC formats.
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
END, END64_PLACE, END64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
END_SIZE, END64_PLACE_SIZE, END64_SIZE, ENTRY_SIZE, LOCAL_SIZE = 22, 20, 56, 46, 30
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "2024-01-01T00:00:00Z"
MANIFEST = "package string, n_records bigint"


# --- records ---------------------------------------------------------------------
def record_id(page: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(page))}>"


def warc_record(page: str | None, url: str, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    """One record: an HTTP response, or a revisit with only the response's head."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page)),
        ("WARC-Date", WARC_DATE), ("WARC-Target-URI", "".join(url.split())),
        ("WARC-Payload-Digest", "sha1:" + hashlib.sha1(payload).hexdigest()),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", record_id(refers_to))]
    text = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return text.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and the HTTP body."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    return fields, rest[:int(fields["content-length"])].partition(b"\r\n\r\n")[2]


# --- writing ---------------------------------------------------------------------
class _Package:
    """One package on its way: records go to the data member, lines to the index after it."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.zip"  # a repeated task writes another file
        files, path = file_system(self.uri)
        self.file = files.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.lines, self.at = [], 0

    def add(self, page: str | None, record: bytes, refers_to: str | None, revisit: bool) -> None:
        packed = gzip.compress(record, 6, mtime=0)
        self.data.write(packed)
        kind = "revisit" if revisit else "response"
        self.lines.append(json.dumps([page, self.at, len(packed), kind, refers_to]))
        self.at += len(packed)

    def close(self) -> tuple[str, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.lines))
        self.zip.close()
        self.file.close()
        return self.uri, len(self.lines)


def same_payloads(pages: DataFrame, id_col: str, text_col: str, least: int = REVISIT_BYTES) -> DataFrame:
    """Pages that revisit another: ``page``, ``digest`` and ``refers_to``, the largest id with the payload.

    Payloads are equal if their SHA-256 and lengths are. Counting combines before the shuffle, and a
    page is looked up by digest only if its payload occurs twice.
    """
    payload = whole_text(text_col)
    rows = pages.select(named(id_col).alias("page"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size"))
    rows = rows.filter(F.col("size") >= least).select("page", "digest")
    first = rows.groupBy("digest").agg(F.max("page").alias("refers_to"), F.count("*").alias("n"))
    first = first.filter("n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to")
    found = rows.join(first, "digest")
    return found.filter(~F.col("page").eqNullSafe(F.col("refers_to"))).distinct()


def write_packages(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
    least: int = REVISIT_BYTES, package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write a record for each row of ``pages`` and return the finished packages (package, n_records).

    Of pages with equal payloads of at least ``least`` bytes, the one with the largest id is a
    response and others revisit it (all rows with that id are responses); smaller payloads are all
    responses. Null payloads are empty, null URLs too; a page without an id never is revisited, but
    may revisit. Repeated rows have a record each. Only the three columns are looked at. An empty
    table gives packages without records, or none.

    Tasks write files of their own under ``folder``. What counts is the list that this returns, which is
    stored: files of failed or repeated tasks are in no list.
    """
    spark = pages.sparkSession
    ship_package(spark)
    payload = whole_text(text_col)
    rows = pages.select(
        named(id_col).alias("page"), whole_text(url_col).alias("url"), payload.alias("payload"),
        F.when(F.octet_length(payload) >= least, F.sha2(payload, 256)).alias("digest"))
    again = same_payloads(pages, id_col, text_col, least).select(
        F.col("page").alias("again"), F.col("digest").alias("again_digest"), "refers_to")
    rows = rows.join(again, F.col("page").eqNullSafe(F.col("again")) & (F.col("digest") == F.col("again_digest")), "left")
    rows = rows.select(
        F.col("page").cast("string").alias("page"), "url", "payload", F.col("refers_to").cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for page, url, payload, refers_to in zip(*(c for c in batch.columns)):
                page, refers_to = page.as_py(), refers_to.as_py()
                package = package or _Package(folder)
                data = payload.as_py().encode("utf-8", "surrogatepass")
                revisit = refers_to is not None
                package.add(page, warc_record(page, url.as_py(), data, refers_to, revisit), refers_to, revisit)
                if package.at >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        names, counts = zip(*done) if done else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["package", "n_records"])

    files, path = file_system(folder)
    files.create_dir(path)
    rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


# --- reading ---------------------------------------------------------------------
@dataclass(frozen=True)
class Member:
    name: str
    start: int  # of the stored bytes
    size: int


class RangeReader:
    """The stored members of a ZIP file, through a function that reads (offset, size)."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read, self.size = read, size
        self.members = {m.name: m for m in self._entries()}

    def _directory(self) -> tuple[int, int, int]:
        """Where the central directory is, its size and its number of entries."""
        tail_at = max(0, self.size - END_SIZE - FULL16)  # a comment may follow the end record
        tail = self.read(tail_at, self.size - tail_at)
        at = tail.rfind(END)
        while at >= 0:
            if at + END_SIZE <= len(tail):
                _, _, _, count, size, start, comment = struct.unpack("<HHHHIIH", tail[at + 4:at + END_SIZE])
                if at + END_SIZE + comment == len(tail):
                    break
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no ZIP file: the end record is missing")
        place = tail_at + at - END64_PLACE_SIZE
        if (FULL16 == count or FULL32 in (size, start)) and place >= 0:
            locator = self.read(place, END64_PLACE_SIZE)
            if locator[:4] == END64_PLACE:
                end64 = self.read(struct.unpack("<Q", locator[8:16])[0], END64_SIZE)
                if end64[:4] != END64:
                    raise ValueError("the ZIP64 end record is missing")
                count, size, start = struct.unpack("<QQQ", end64[32:56])
        return start, size, count

    def _entries(self) -> Iterator[Member]:
        start, size, count = self._directory()
        data, at = self.read(start, size), 0
        for _ in range(count):
            if data[at:at + 4] != ENTRY:
                raise ValueError("the central directory is damaged")
            flags, method = struct.unpack("<HH", data[at + 8:at + 12])
            packed, plain, names, extras, comments = struct.unpack("<IIHHH", data[at + 20:at + 34])
            local = struct.unpack("<I", data[at + 42:at + 46])[0]
            name = data[at + ENTRY_SIZE:at + ENTRY_SIZE + names].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[at + ENTRY_SIZE + names:at + ENTRY_SIZE + names + extras]
            plain, packed, local = self._wide(extra, plain, packed, local)
            at += ENTRY_SIZE + names + extras + comments
            if method == 0 and not flags & 1:  # stored, and not encrypted
                yield Member(name, local, plain)

    @staticmethod
    def _wide(extra: bytes, *values: int) -> list[int]:
        """Sizes and offset, from the ZIP64 field for those that are full."""
        wide, at = b"", 0
        while at + 4 <= len(extra):
            kind, size = struct.unpack("<HH", extra[at:at + 4])
            if kind == 1:
                wide = extra[at + 4:at + 4 + size]
            at += 4 + size
        out, used = [], 0
        for value in values:
            if value == FULL32 and len(wide) >= used + 8:
                value = struct.unpack("<Q", wide[used:used + 8])[0]
                used += 8
            out.append(value)
        return out

    def span(self, name: str) -> tuple[int, int]:
        """Where a member's bytes begin in the file, and how many there are."""
        member = self.members[name]
        local = self.read(member.start, LOCAL_SIZE)
        if local[:4] != LOCAL:
            raise ValueError("a local header is missing")
        names, extras = struct.unpack("<HH", local[26:30])
        return member.start + LOCAL_SIZE + names + extras, member.size


def open_package(uri: str) -> RangeReader:
    files, path = file_system(uri)
    file = files.open_input_file(path)

    def read(offset: int, size: int) -> bytes:
        file.seek(offset)
        return file.read(size)

    return RangeReader(read, file.size())


def records(package: RangeReader, fetch: int = FETCH_BYTES) -> Iterator[tuple]:
    """Index line and unpacked record of each record, in the order of the index; records that follow
    each other are fetched together."""
    at, size = package.span(INDEX)
    lines = [json.loads(line) for line in package.read(at, size).decode("utf-8").split("\n") if line]
    data_at, _ = package.span(DATA)
    buffer, first = b"", 0
    for line in lines:
        offset, length = line[1], line[2]
        if not first <= offset <= offset + length <= first + len(buffer):
            buffer, first = package.read(data_at + offset, max(length, fetch)), offset
        packed = buffer[offset - first:offset - first + length]
        yield line, gzip.decompress(packed)


def read_packages(packages: DataFrame, id_type: T.DataType) -> DataFrame:
    """All records of ``packages`` (package): ``page_id``, ``payload_digest``, ``record_type``,
    ``refers_to`` and ``payload``, null for revisits. A task reads one package after the other."""
    schema = T.StructType.fromDDL(
        "page_id string, payload_digest string, record_type string, refers_to string, payload binary")
    ship_package(packages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, held = [], 0
                for (page, _, _, kind, refers_to), data in records(open_package(uri)):
                    fields, payload = parse_record(data)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind != fields["warc-type"]:
                        raise ValueError(f"the index and the record of {page} differ")
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"the payload of {page} is damaged")
                    rows.append((page, digest, kind, refers_to, payload if kind == "response" else None))
                    held += len(payload)
                    if len(rows) >= 1000 or held >= 16 << 20:
                        yield _batch(rows, out)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, out)

    # A task for each package: these rows are too small for Spark to judge the work by their size.
    each = packages.select("package").repartitionByRange(max(1, packages.count()), "package")
    read = each.mapInArrow(run, schema)
    return read.select(F.col("page_id").cast(id_type).alias("page_id"), "payload_digest", "record_type",
                       F.col("refers_to").cast(id_type).alias("refers_to"), "payload")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
             least: int = REVISIT_BYTES) -> DataFrame:
    """Pages written to packages in the shared folder and read back: ``page_id``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``. A revisit has the size of the response it
    refers to, found by that id and digest."""
    spark = pages.sparkSession
    folder = work_dir(spark, "warc")
    packages = write_packages(pages, folder, id_col, url_col, text_col, least)
    read = read_packages(packages, pages.schema[id_col].dataType)
    read.select("page_id", F.octet_length("payload").cast("bigint").alias("payload_bytes"), "payload_digest",
                "record_type", "refers_to").write.parquet(f"{folder}/read")
    rows = spark.read.parquet(f"{folder}/read")
    responses = rows.filter("record_type = 'response'")
    sizes = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = rows.filter("record_type = 'revisit'").drop("payload_bytes").join(sizes, ["refers_to", "payload_digest"])
    return responses.unionByName(revisits.select(*responses.columns))
