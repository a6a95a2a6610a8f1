"""WARC archives as a data source: pruned reads, revisit records for repeated payloads."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from quarry.llm.common import quoted, written

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "payload_length long, refers_to string, payload binary"
)
HEADER_COLUMNS = ("record_id", "record_type", "target_uri", "date", "payload_digest", "payload_length", "refers_to")
MANIFEST = "_committed"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
BATCH_BYTES, BATCH_RECORDS = 8 << 20, 2_000


def base32_sha1(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _clean(value: str) -> str:
    """A header value stays on its line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row: dict) -> bytes:
    """One record; a response holds an HTTP head and the payload, a revisit the head alone."""
    payload = row.get("payload") or b""
    kind = row.get("record_type") or "response"
    length = row.get("payload_length")
    if kind != "revisit" or length is None:
        length = len(payload)
    digest = row.get("payload_digest") or base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{row.get('record_id') or 'urn:uuid:' + str(uuid.uuid4())}>"),
        ("WARC-Date", row.get("date") or "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", row.get("target_uri")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", REVISIT_PROFILE if kind == "revisit" else None),
        ("WARC-Refers-To", f"<{row['refers_to']}>" if row.get("refers_to") else None),
        ("X-Payload-Length", str(length)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {_clean(v)}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """One file per task, rolled at ``maxFileBytes``; only files named in the manifest count.

    A task that dies leaves a file that no manifest names, its rerun writes another.
    """

    def __init__(self, path: str, names: list[str], roll: int, packed: bool):
        self.path, self.names, self.roll, self.packed = path, names, roll, packed

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append(f"{uuid.uuid4().hex}.warc" + ".gz" * self.packed)
                    out, size = fs.open_output_stream(f"{root}/{files[-1]}", compression=None, buffer_size=1 << 20), 0
                record = record_bytes(row)
                record = gzip.compress(record, 6, mtime=0) if self.packed else record
                out.write(record)
                size += len(record)
                if size >= self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        names = [f for m in messages if m for f in m.files]
        with fs.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            for f in m.files if m else []:
                fs.delete_file(f"{root}/{f}")


@dataclass
class Files(InputPartition):
    names: list

    def __init__(self, names):
        self.names = names


class WarcReader(DataSourceReader):
    """Parses headers first; a record that a pushed predicate excludes is never decoded."""

    def __init__(self, path: str, payload: bool, per_task: int):
        self.path, self.payload, self.per_task = path, payload, per_task
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            inner = f.child if isinstance(f, Not) else f
            known = isinstance(inner, (EqualTo, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains))
            if known and len(inner.attribute) == 1 and inner.attribute[0] in HEADER_COLUMNS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Whole files, small ones together, largest first, about ``bytesPerTask`` each."""
        fs, root = pafs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(pafs.FileSelector(root))
        sizes = {i.base_name: i.size for i in info if i.base_name.endswith((".warc", ".warc.gz"))}
        manifests = [i.path for i in info if i.base_name.startswith(MANIFEST)]
        if manifests:
            named = set()
            for m in manifests:
                with fs.open_input_stream(m) as f:
                    named |= set(json.loads(f.read()))
            sizes = {n: s for n, s in sizes.items() if n in named}
        parts, held, names = [], 0, []
        for n in sorted(sizes, key=lambda n: (-sizes[n], n)):
            if names and held + sizes[n] > self.per_task:
                parts.append(Files(names))
                held, names = 0, []
            names.append(n)
            held += sizes[n]
        return parts + [Files(names)] if names else parts or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = {"payload_length": pa.int64(), "payload": pa.binary()}
        rows, size = [], 0

        def batch():
            cols = [pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names]
            return pa.RecordBatch.from_arrays(cols, names)

        for name in partition.names:
            raw = io.BufferedReader(fs.open_input_file(f"{root}/{name}"), 1 << 20)
            stream = gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw
            for row in records(stream, self.filters, self.payload):
                rows.append(row)
                size += len(row["payload"] or b"")
                if size >= BATCH_BYTES or len(rows) >= BATCH_RECORDS:
                    yield batch()
                    rows, size = [], 0
            raw.close()
        if rows:
            yield batch()


def _passes(row: dict, f: Filter) -> bool:
    if isinstance(f, Not):
        inner = f.child
        if isinstance(inner, (IsNull, IsNotNull)):
            return not _passes(row, inner)
        return row[inner.attribute[0]] is not None and not _passes(row, inner)
    value = row[f.attribute[0]]
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if value is None:
        return False
    if isinstance(f, EqualTo):
        return value == f.value
    if isinstance(f, In):
        return value in f.value
    test = {StringStartsWith: str.startswith, StringEndsWith: str.endswith, StringContains: str.__contains__}
    return test[type(f)](value, f.value)


def records(stream, filters: list[Filter], payload: bool) -> Iterator[dict]:
    """The records of one file that pass the filters, as header columns and payload.

    Payloads that are not wanted are skipped by their length. A payload whose SHA-1 is not
    that of its header raises.
    """
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
        fields: dict[str, str] = {}
        last = None
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            if line[:1] in (b" ", b"\t") and last:  # a folded line
                fields[last] += " " + line.decode("utf-8", "replace").strip()
                continue
            key, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(":")
            last = key.strip().lower()
            fields[last] = value.strip()
        size = int(fields.get("content-length", 0))
        length = fields.get("x-payload-length")
        unbracketed = lambda k: fields[k].strip("<>") if k in fields else None
        row = {
            "record_id": unbracketed("warc-record-id"),
            "record_type": fields.get("warc-type"),
            "target_uri": fields.get("warc-target-uri"),
            "date": fields.get("warc-date"),
            "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:") if "warc-payload-digest" in fields else None,
            "payload_length": int(length) if length is not None else None,
            "refers_to": unbracketed("warc-refers-to"),
            "payload": None,
        }
        if not all(_passes(row, f) for f in filters):
            stream.seek(size, io.SEEK_CUR)
            continue
        if not payload or row["record_type"] == "revisit":
            stream.seek(size, io.SEEK_CUR)
            yield row
            continue
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record ends too early")
        if fields.get("content-type", "").startswith("application/http"):
            at = block.find(b"\r\n\r\n")
            block = block[at + 4 :] if at >= 0 else b""
        row["payload"], row["payload_length"] = block, len(block)
        digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
        if row["payload_digest"] not in (None, digest):
            raise ValueError(f"payload of {row['record_id']} does not have its digest")
        row["payload_digest"] = digest
        yield row


class WarcDataSource(DataSource):
    """Format ``warc``. Options: ``path``; reading ``payload`` (default true) and
    ``bytesPerTask``; writing ``maxFileBytes`` and ``compression`` (``none`` or ``gzip``, one
    member per record)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        o = self.options
        return WarcReader(o["path"], o.get("payload", "true").lower() == "true", int(o.get("bytesPerTask", 64 << 20)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        o = self.options
        if overwrite:
            raise ValueError("archives are only appended to; name a new folder")
        return WarcWriter(o["path"], schema.names, int(o.get("maxFileBytes", 256 << 20)), o.get("compression", "none") == "gzip")


def register(spark: SparkSession) -> None:
    """Make the format known and let predicates reach it."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives in ``path``; predicates on header columns reach the parser.

    With ``payload`` false no payload is read; revisits never have one. A folder without
    archives gives no rows.
    """
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def write_warc(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write records: columns of the format's schema, all but ``payload`` optional per row."""
    register(df.sparkSession)
    df.write.format("warc").mode("append").option("compression", compression).save(path)


def archive(
    df: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", body: Column | None = None, min_bytes: int = 0, prefix: str = "urn:page:", compression: str = "none"
) -> None:
    """One record per row. Of rows with equal payloads of at least ``min_bytes`` that with the
    largest id is a response and the others are revisits of it; shorter ones are responses.

    ``body`` (default: column ``html``) is the payload in UTF-8, null is empty. A null uri
    leaves the header out. A row with a null id gets a random record id; it is a revisit if
    another row of its group has an id, else a response. Rows that repeat the largest id are
    all responses. An empty table writes no record.

    Plan: payloads are grouped by hash, summed before the shuffle; groups of more than one row
    are written and joined back (copied only if their files are small). Payloads of revisits
    are dropped before the rows go to Python.
    """
    payload = F.coalesce((F.col("html") if body is None else body).cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(uri_col)).cast("string").alias("uri"), payload.alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n"))
    same = (
        rows.filter(F.col("n") >= min_bytes)
        .groupBy(F.col("sha1").alias("g_sha1"), F.col("n").alias("g_n"))
        .agg(F.max("id").alias("first"), F.count("*").alias("c"))
        .filter((F.col("c") > 1) & F.col("first").isNotNull())
    )
    same = written(same.select("g_sha1", "g_n", "first"), "payloads")
    joined = rows.join(same, (F.col("sha1") == F.col("g_sha1")) & (F.col("n") == F.col("g_n")), "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    write_warc(
        joined.select(
            F.concat(F.lit(prefix), F.col("id").cast("string")).alias("record_id"),
            F.when(again, "revisit").otherwise("response").alias("record_type"),
            F.col("uri").alias("target_uri"),
            F.when(again, base32(F.col("sha1"))).alias("payload_digest"),
            F.col("n").alias("payload_length"),
            F.when(again, F.concat(F.lit(prefix), F.col("first").cast("string"))).alias("refers_to"),
            F.when(~again, F.col("payload")).alias("payload"),
        ),
        path,
        compression,
    )


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex: four groups of 40 bits, eight letters each."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = []
    for k in range(4):
        bits = F.conv(F.substring(hexadecimal, 10 * k + 1, 10), 16, 10).cast("long")
        groups += [F.substring(letters, F.shiftright(bits, s).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1)) for s in range(35, -1, -5)]
    return F.concat(*groups)
