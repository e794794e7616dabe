"""WARC archives as a Spark data source.

Reading: the files below a path are planned into partitions of about ``partition_bytes`` (whole
files; the writer bounds their size). Predicates on the record type and on headers come down to
the reader; a record's headers are parsed first, and the block of a record that is not wanted is
passed over without being decoded: skipped by position in a plain file, inflated in pieces and
dropped in a compressed one. With the option ``payload`` false no block is kept.

Writing: each task writes files of about ``file_bytes``, a gzip member for each record, below a
staging folder of its job; the commit moves the files of the tasks that succeeded and removes
the rest, so a task that is tried again, or twice at once, leaves no second copy.

Paths are those of pyarrow's file systems (local, hdfs, s3, gs); on a cluster the folder has to
be one that all executors share.

Defined results: a null payload is empty; a null id gives an id without a number and reads back
as null; control characters of a url are percent-encoded; repeated rows are records of their
own; no rows give an archive without records, which reads as an empty table.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from ludomart.llm.common import stored

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, "
    "payload_digest string, payload_bytes bigint, headers map<string,string>, payload binary"
)
# Columns that are headers as they stand.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARTITION_BYTES = 64 << 20
FILE_BYTES = 64 << 20
BATCH_BYTES = 8 << 20


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


@dataclass
class Files(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.size = int(options.get("partition_bytes", PARTITION_BYTES))
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list) -> Iterable:
        for f in filters:
            name = HEADERS.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if name and isinstance(f, EqualTo):
                self.tests.append(("in", name, (f.value,)))
            elif name and isinstance(f, In):
                self.tests.append(("in", name, tuple(f.value)))
            elif name and isinstance(f, StringStartsWith):
                self.tests.append(("prefix", name, f.value))
            else:
                yield f

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        store, root = _files(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        names = sorted((f.path, f.size) for f in found if f.is_file and re.search(r"\.warc(\.gz)?$", f.path) and "/_" not in f.path[len(root) :])
        out: list[Files] = []
        held = self.size
        for name, size in names:
            if held + size > self.size:
                out.append(Files([]))
                held = 0
            out[-1].names.append(name)
            held += size
        return out or [Files([])]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for kind, name, value in self.tests:
            have = headers.get(name)
            if have is None or not (have in value if kind == "in" else have.startswith(value)):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _files(self.path)
        rows: list[tuple] = []
        held = 0
        for name in partition.names:
            with store.open_input_file(name) as raw:
                packed = name.endswith(".gz")
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if packed else raw, 1 << 18)
                for row in self._records(stream, packed):
                    rows.append(row)
                    held += len(row[8] or b"") + 500
                    if held > BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)

    def _records(self, stream: io.BufferedReader, packed: bool) -> Iterator[tuple]:
        while True:
            line = stream.readline()
            if not line:
                return
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no WARC record begins with {line[:40]!r}")
            headers = _headers(stream)
            length = int(headers.get("content-length", "0"))
            if not self._wanted(headers):
                _skip(stream, length, packed)
                continue
            http, left = {}, length
            if headers.get("content-type", "").startswith("application/http") and length:
                at = stream.readline()
                left -= len(at)
                while left > 0:
                    at = stream.readline()
                    left -= len(at)
                    if not at.strip():
                        break
                    k, _, v = at.decode("utf-8", "replace").partition(":")
                    http[k.strip().lower()] = v.strip()
            payload = None
            if self.payload:
                payload = stream.read(left)
            else:
                _skip(stream, left, packed)
            size = int(http.get("content-length", left))
            yield (*(headers.get(h) for h in HEADERS.values()), size, list(headers.items()), payload)


def _headers(stream: io.BufferedReader) -> dict[str, str]:
    out: dict[str, str] = {}
    while line := stream.readline().strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _skip(stream: io.BufferedReader, n: int, packed: bool) -> None:
    if not packed:
        stream.seek(n, io.SEEK_CUR)
        return
    while n > 0:
        got = len(stream.read(min(n, 1 << 18)))
        if not got:
            return
        n -= got


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [*[pa.string()] * 6, pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [*HEADERS, "payload_bytes", "headers", "payload"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Writes columns record_id, record_type, target_uri, refers_to, digest (base32 SHA-1 of
    the payload), payload_bytes, payload (null in a revisit)."""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path = options["path"].rstrip("/")
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))
        self.date = options.get("date", "2024-01-01T00:00:00Z")
        self.level = int(options.get("level", 3))
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def _staging(self) -> str:
        return f"{self.path}/_staging-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _files(self._staging())
        store.create_dir(root, recursive=True)
        names: list[str] = []
        out, size = None, 0
        for batch in iterator:
            cols = [batch.column(c).to_pylist() for c in ("record_id", "record_type", "target_uri", "refers_to", "digest", "payload_bytes", "payload")]
            for row in zip(*cols, strict=True):
                if out is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                member = _member(*row, date=self.date, level=self.level)
                out.write(member)
                size += len(member)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list) -> None:
        store, root = _files(self.path)
        store.create_dir(root, recursive=True)
        staging = f"{root}/_staging-{self.job}"
        for m in messages:
            for name in m.names if m else ():
                store.move(f"{staging}/{name}", f"{root}/{name}")
        self._clear(store, staging)

    def abort(self, messages: list) -> None:
        store, root = _files(self.path)
        self._clear(store, f"{root}/_staging-{self.job}")

    @staticmethod
    def _clear(store, staging: str) -> None:
        from pyarrow import fs

        if store.get_file_info(staging).type == fs.FileType.Directory:
            store.delete_dir(staging)


def _member(record_id, kind, uri, refers_to, digest, size, payload, date: str, level: int) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = b"" if kind == "revisit" else payload or b""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", uri or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:record:{'' if record_id is None else record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:record:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return b"".join([pack.compress(head), pack.compress(http), pack.compress(body), pack.compress(b"\r\n\r\n"), pack.flush()])


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def base32(sha1_hex: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hexadecimal: forty bits, eight digits at a time."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    digits = []
    for part in range(4):
        bits = F.conv(F.substring(sha1_hex, 10 * part + 1, 10), 16, 10).cast("long")
        for j in range(8):
            at = F.shiftright(bits, 35 - 5 * j).bitwiseAND(F.lit(31)) + 1
            digits.append(F.substring(alphabet, at.cast("int"), F.lit(1)))
    return F.concat(*digits)


def archive(pages: DataFrame, path: str, key: str, url: str, html: str, min_bytes: int = 0, **options) -> None:
    """Writes a record for each row. Of rows with equal payloads of ``min_bytes`` or more the
    one of the largest key is a response and the others revisit it; rows that repeat it are
    responses too.

    Equal payloads are found by SHA-1 on narrow rows: copies are aggregated before the shuffle,
    and only the revisits, without payload, join the pages.
    """
    register(pages.sparkSession)
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    own = pages.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{url}`").alias("_url"), body.cast("binary").alias("_body"))
    own = own.withColumn("_sha", F.sha1("_body"))
    narrow = own.where(F.octet_length("_body") >= min_bytes).select("_key", "_sha")
    groups = narrow.groupBy("_sha").agg(F.max("_key").alias("_to"), F.count("*").alias("_n")).where("_n > 1 AND _to IS NOT NULL")
    revisits = narrow.join(groups, "_sha").where("NOT (_key <=> _to)").select("_key", "_sha", "_to").distinct()
    revisits = stored(revisits.withColumnsRenamed({"_key": "_k", "_sha": "_s"}), "revisits")
    out = own.join(revisits, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_sha") == F.col("_s")), "left")
    kind = F.when(F.col("_to").isNull(), "response").otherwise("revisit")
    out.select(
        F.col("_key").cast("string").alias("record_id"),
        kind.alias("record_type"),
        F.col("_url").alias("target_uri"),
        F.col("_to").cast("string").alias("refers_to"),
        base32(F.col("_sha")).alias("digest"),
        F.octet_length("_body").cast("long").alias("payload_bytes"),
        F.when(F.col("_to").isNull(), F.col("_body")).alias("payload"),
    ).write.format("warc").options(**options).mode("append").save(path)


def check_digests(records: DataFrame) -> DataFrame:
    """``records`` with ``intact``: whether a response's payload has its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for kind, digest, payload in zip(*(batch.column(c) for c in ("record_type", "payload_digest", "payload")), strict=True):
                if kind.as_py() == "revisit":
                    ok.append(True)
                else:
                    own = base64.b32encode(hashlib.sha1(payload.as_buffer() if payload.is_valid else b"").digest()).decode()
                    ok.append(digest.as_py() == f"sha1:{own}")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ok, pa.bool_())], names=[*batch.schema.names, "intact"])

    return records.mapInArrow(run, StructType.fromDDL(f"{SCHEMA}, intact boolean"))
