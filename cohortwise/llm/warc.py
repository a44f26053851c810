"""WARC archives as a Spark data source, written and read by file.

``spark.read.format("warc")`` plans a partition per archive file. Filters on
the record type and on header columns are pushed into the reader: it parses a
record's header, and skips the payload of a record that a filter rejects, or
of every record with option ``payload=false``, without reading or decoding it.
``df.write.format("warc")`` writes one record per row, each a gzip member that
states its lengths, so that a skipped payload is not inflated; a manifest, written on
commit, names the files of successful tasks, so lost or repeated tasks leave
nothing that is read.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

from cohortwise.llm.store import new_path, ship

MANIFEST = "_records.json"
SCHEMA = (
    "record_id string, warc_type string, target_uri string, date string, payload_digest string,"
    " refers_to string, payload_bytes long, payload binary"
)
#: Columns that a header decides, so their filters are tested before the payload is read.
HEADER = ("record_id", "warc_type", "target_uri", "date", "payload_digest", "refers_to", "payload_bytes")
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class PlainFile:
    """Bytes of an uncompressed archive; ``skip`` reads nothing."""

    AHEAD = 1 << 16

    def __init__(self, file: pa.NativeFile):
        self.file, self.at, self.held, self.start = file, 0, b"", 0

    def peek(self, n: int) -> bytes:
        """The next bytes, ``n`` if there are so many."""
        i = self.at - self.start
        if i < 0 or i + n > len(self.held):
            self.held, self.start, i = self.file.read_at(max(n, self.AHEAD), self.at), self.at, 0
        return self.held[i : i + n]

    def read(self, n: int) -> bytes:
        data = self.peek(n)
        self.at += len(data)
        return data

    def skip(self, n: int) -> None:
        self.at += n


class GzipFile:
    """Bytes of an archive of gzip members.

    ``skip`` jumps over the rest of a member that states its lengths (as
    ``_member`` writes them), and inflates a piece of any other at a time.
    """

    AHEAD, FEED = 1 << 16, 1 << 14

    def __init__(self, file: pa.NativeFile):
        self.raw, self.held = PlainFile(file), b""
        self.inflate = self.left = None  # left: bytes of the member that are not inflated yet, if known
        self.end = 0

    def peek(self, n: int) -> bytes:
        parts, have = [self.held], len(self.held)
        while have < n and (raw := self.raw.peek(self.FEED)):
            if self.inflate is None:
                self.inflate = zlib.decompressobj(31)
                size, self.left = _member_lengths(raw)
                self.end = self.raw.at + size
            parts.append(self.inflate.decompress(raw))
            have += len(parts[-1])
            self.raw.skip(len(raw) - len(self.inflate.unused_data))
            if self.left is not None:
                self.left -= len(parts[-1])
            if self.inflate.eof:
                self.inflate = self.left = None
        self.held = b"".join(parts)
        return self.held[:n]

    def read(self, n: int) -> bytes:
        data = self.peek(n)
        self.held = self.held[len(data) :]
        return data

    def skip(self, n: int) -> None:
        while n > 0:
            if self.held or self.left is None or n < self.left:
                data = self.read(min(n, len(self.held) or self.AHEAD))
                if not data:
                    return
                n -= len(data)
            else:
                n -= self.left
                self.raw.at = self.end
                self.inflate = self.left = None


_LENGTHS = b"SK"  # the extra field of a gzip header that holds a member's lengths


def _member(data: bytes) -> bytes:
    """``data`` as one gzip member whose header states its lengths, packed and not."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    field = _LENGTHS + struct.pack("<HQQ", 16, 12 + 20 + len(body) + 8, len(data))
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(field)) + field
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _member_lengths(raw: bytes) -> tuple[int, int | None]:
    """(bytes of the member, bytes it inflates to) as its header states; (0, None) if not."""
    if len(raw) >= 32 and raw[3] & 4 and raw[10:16] == struct.pack("<H2sH", 20, _LENGTHS, 16):
        return struct.unpack("<QQ", raw[16:32])
    return 0, None


def _head(file: PlainFile | GzipFile) -> dict[str, str] | None:
    """A header block as lower-case names and values; None at the file's end.

    The first line stands under the empty name.
    """
    n = 1024
    while (cut := (data := file.peek(n)).find(b"\r\n\r\n")) < 0 and len(data) == n:
        n *= 4
    if not data:
        return None
    if cut < 0:
        raise ValueError("an archive ends within a header")
    file.skip(cut + 4)
    first, *lines = data[:cut].decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines)
    return {"": first} | {name.strip().lower(): value.strip() for name, _, value in pairs}


def _hex_digest(value: str | None) -> str | None:
    """A labelled base-32 SHA-1 as bare hexadecimal; other digests as they are."""
    if value and value.startswith("sha1:") and len(value) == 37:
        return base64.b32decode(value[5:].upper()).hex()
    return value


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value


def _matches(row: dict, tests: list) -> bool:
    for test in tests:
        value = row[test.attribute[0]]
        if isinstance(test, IsNull):
            ok = value is None
        elif value is None:
            ok = False
        elif isinstance(test, EqualTo):
            ok = value == test.value
        elif isinstance(test, In):
            ok = value in test.value
        elif isinstance(test, StringStartsWith):
            ok = value.startswith(test.value)
        else:  # IsNotNull
            ok = True
        if not ok:
            return False
    return True


def records(file: PlainFile | GzipFile, tests: list, payload: bool) -> Iterator[dict]:
    """The records of a file that pass ``tests`` (filters on header columns)."""
    while (head := _head(file)) is not None:
        left = int(head.get("content-length", 0))
        row = {
            "record_id": _bare(head.get("warc-record-id")),
            "warc_type": head.get("warc-type"),
            "target_uri": head.get("warc-target-uri"),
            "date": head.get("warc-date"),
            "payload_digest": _hex_digest(head.get("warc-payload-digest")),
            "refers_to": _bare(head.get("warc-refers-to")),
            "payload_bytes": int(head["x-payload-bytes"]) if "x-payload-bytes" in head else None,
            "payload": None,
        }
        if payload and row["warc_type"] != "revisit" and _matches(row, tests):
            block = file.read(left)
            if len(block) < left:
                raise ValueError("an archive ends within a record")
            if head.get("content-type", "").startswith("application/http"):
                block = block.partition(b"\r\n\r\n")[2]
            row["payload"] = block
            file.skip(4)
            yield row
        else:
            file.skip(left + 4)
            if _matches(row, tests):
                yield row


def _record(row: dict) -> bytes:
    revisit = row["warc_type"] == "revisit"
    payload = b"" if revisit else row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    block = http.encode() + payload
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['warc_type']}",
        f"WARC-Record-ID: <{row['record_id']}>",
        f"WARC-Date: {row['date'] or DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Bytes: {row['payload_bytes']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["target_uri"] is not None:
        lines.append("WARC-Target-URI: " + " ".join(row["target_uri"].split()))
    if revisit:
        lines += [f"WARC-Refers-To: <{row['refers_to']}>", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Archive(InputPartition):
    uri: str


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, names: list[str]):
        self.path, self.payload, self.names, self.tests = path, payload, names, []

    def pushFilters(self, filters):
        for test in filters:
            known = isinstance(test, EqualTo | In | IsNull | IsNotNull | StringStartsWith)
            if known and len(test.attribute) == 1 and test.attribute[0] in HEADER:
                self.tests.append(test)
            else:
                yield test

    def partitions(self):
        store, path = _store(self.path)
        base = self.path.rstrip("/")
        info = store.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [Archive(self.path)]
        if store.get_file_info(f"{path}/{MANIFEST}").type == pafs.FileType.File:
            with store.open_input_stream(f"{path}/{MANIFEST}") as file:
                names = json.loads(file.read())
        else:
            found = store.get_file_info(pafs.FileSelector(path))
            names = [f.base_name for f in found if f.base_name.endswith((".warc", ".warc.gz"))]
        return [Archive(f"{base}/{name}") for name in sorted(names)] or [Archive("")]

    def read(self, partition):
        if not partition.uri:
            return
        store, path = _store(partition.uri)
        schema = pa.schema([(n, {"payload_bytes": pa.int64(), "payload": pa.binary()}.get(n, pa.string())) for n in self.names])
        with store.open_input_file(path) as raw:
            file = GzipFile(raw) if path.endswith(".gz") else PlainFile(raw)
            rows, held = [], 0
            for row in records(file, self.tests, self.payload):
                rows.append({n: row[n] for n in self.names})
                held += 200 + len(row["payload"] or b"")
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, file_bytes: int):
        self.path, self.file_bytes = path, file_bytes

    def write(self, iterator):
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{base}/{files[-1]}", compression=None, buffer_size=1 << 18), 0
                data = _member(_record(row))
                out.write(data)
                size += len(data)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages):
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{MANIFEST}") as file:
            file.write(json.dumps(sorted(f for m in messages if m for f in m.files)).encode())

    def abort(self, messages):
        store, base = _store(self.path)
        for name in (f for m in messages if m for f in m.files):
            store.delete_file(f"{base}/{name}")


class WarcSource(DataSource):
    """Options: ``path``; ``payload`` (false: headers only); ``fileBytes`` (of a written file)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false", schema.names)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], int(self.options.get("filebytes", self.options.get("fileBytes", 64 << 20))))


def register(spark: SparkSession) -> None:
    """Make format ``warc`` known, with its filters pushed down."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """WARC rows for ``pages(page_id, url, html)``; copies become revisits.

    Of records with equal payloads (the html in UTF-8; null is empty) of at
    least ``least`` bytes, the one with the largest ``page_id`` is the
    response and the others revisit it; shorter ones are all responses. Rows
    that repeat the largest ``page_id`` are all responses. A row without
    ``page_id`` can only revisit. Other columns are ignored.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.length("payload").cast("long")})
    long = rows.where(F.col("size") >= least).select("page_id", "digest", "size")
    last = long.groupBy("digest", "size").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null")
    # Few columns meet the groups of copies; the pages join by their own id.
    copies = long.join(last, ["digest", "size"]).where(~F.col("page_id").eqNullSafe(F.col("last")))
    copies = copies.select(F.col("page_id").alias("id"), F.col("digest").alias("of"), "last").distinct()
    joined = rows.join(copies, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left")
    revisit = F.col("last").isNotNull()
    return joined.select(
        F.concat(F.lit("urn:x-page:"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
        F.col("url").alias("target_uri"),
        F.lit(DATE).alias("date"),
        F.col("digest").alias("payload_digest"),
        F.when(revisit, F.concat(F.lit("urn:x-page:"), F.col("last").cast("string"))).alias("refers_to"),
        F.col("size").alias("payload_bytes"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back.

    Responses are read in full, and their size and digest are those of the
    payload read; revisits come from a second read that skips all payloads.
    """
    spark = pages.sparkSession
    register(spark)
    path = new_path(spark, "warc")
    page_records(pages).write.format("warc").mode("append").save(path)

    def read(kind: str, payload: str) -> DataFrame:
        return spark.read.format("warc").option("payload", payload).load(path).where(F.col("warc_type") == kind)

    full, short = read("response", "true"), read("revisit", "false")

    def page(name: str):
        return F.substring_index(name, ":", -1).try_cast("long")

    return full.select(
        page("record_id").alias("page_id"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(
        short.select(
            page("record_id").alias("page_id"),
            "payload_bytes",
            "payload_digest",
            F.col("warc_type").alias("record_type"),
            page("refers_to").alias("refers_to"),
        )
    )


def op8_warc_round_trip(spark, sf_dir: str) -> DataFrame:
    """Archive the whole ``pages`` table and read the archives back."""
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))
