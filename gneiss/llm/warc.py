"""WARC archives as a Spark data source, and deduplicated archiving of pages.

Reading plans a partition per archive file, takes predicates on the record type and on header columns, parses a
record's headers first and passes over the block of every record that no predicate or option asks for. Writing puts
each task's records into files of its own in a temporary folder; the commit renames them, an abort removes them.
"""

from __future__ import annotations

import gzip
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage

SCHEMA = "warc_type string, record_id string, target_uri string, page_id long, payload_digest string, payload_length long, refers_to string, refers_to_page long, content_length long, headers map<string,string>, payload binary"
#: Column and header of the values that predicates can test before a block is read.
HEADER_COLUMNS = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "page_id": "X-Page-ID", "payload_length": "X-Payload-Length", "refers_to_page": "X-Refers-To-Page-ID"}
_KNOWN = {h.lower(): h for h in (*HEADER_COLUMNS.values(), "Content-Length", "Content-Type")}
_NUMBERS = {"page_id", "payload_length", "refers_to_page"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below are archived each; a task starts another file after so many bytes.
LEAST_DEDUP_BYTES = 100
FILE_BYTES = 64_000_000
_BATCH_BYTES = 8_000_000
_SKIP = 1 << 20


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}') if page_id is not None else uuid.uuid4()}>"


def record(kind: str, headers: dict[str, object], block: bytes) -> bytes:
    """One record; control characters in header values are percent-encoded, null values left out."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    for name, value in headers.items():
        if value is not None:
            text = str(value)
            lines.append(f"{name}: {quote(text, safe=''.join(map(chr, range(32, 127)))) if any(ord(c) < 32 or ord(c) == 127 for c in text) else text}")
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def page_record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, length: int, refers_to: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    headers = {"WARC-Record-ID": record_id(page_id), "WARC-Date": "1970-01-01T00:00:00Z", "WARC-Target-URI": url, "X-Page-ID": page_id, "WARC-Payload-Digest": f"sha256:{digest}", "X-Payload-Length": length, "Content-Type": "application/http;msgtype=response"}
    if kind == "revisit":
        return record(kind, headers | {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_to), "X-Refers-To-Page-ID": refers_to}, http + b"\r\n")
    return record(kind, headers, http + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload)


def _damaged(strict: bool, what: str) -> None:
    if strict:
        raise ValueError(what)


def records(source, wanted, with_payload: bool, strict: bool = True, size: int | None = None) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of the records whose headers ``wanted`` accepts; other blocks are passed over undecoded.

    Header names are matched whatever their case. A damaged record (no version line where one is due, no valid length,
    a block cut short) is an error if ``strict``, else it is left out and reading goes on at the next version line.
    """
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            _damaged(strict, f"no WARC record begins with {line[:40]!r}")
            continue
        headers: dict[str, str] = {}
        while (line := source.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[_KNOWN.get(name.strip().lower(), name.strip())] = value.strip()
        length = headers.get("Content-Length", "")
        if not (length.isascii() and length.isdigit()):
            _damaged(strict, f"a WARC record has the length {length!r}")
            continue
        keep = wanted(headers)
        block = source.read(int(length)) if keep and with_payload else None
        read = _passed(source, int(length), size) if block is None else len(block)
        if read < int(length):
            _damaged(strict, f"a WARC record of {length} bytes ends after {read}")
            return
        if keep:
            payload = None
            if block is not None:
                if headers.get("WARC-Type") == "response" and headers.get("Content-Type", "").startswith("application/http"):
                    payload = block.partition(b"\r\n\r\n")[2]
                elif headers.get("WARC-Type") != "revisit":
                    payload = block
            yield headers, payload


def _passed(source, length: int, size: int | None) -> int:
    """Pass over so many bytes, in a plain file of a known size without reading them; how many there were."""
    if size is not None:
        there = min(length, size - source.tell())
        source.seek(there, io.SEEK_CUR)
        return there
    left = length
    while left and (part := source.read(min(left, _SKIP))):
        left -= len(part)
    return length - left


@dataclass
class _File(InputPartition):
    path: str


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


def _number(text: str | None) -> int | None:
    """A header's number; null if it is missing or none, as other writers may use the name for something else."""
    return int(text) if text and text.isascii() and text.isdigit() and len(text) < 19 else None


class WarcReader(DataSourceReader):
    """A partition per file; equality and membership tests on header columns are pushed down."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.with_payload = options["path"], options.get("payload", "true").lower() == "true"
        self.strict = options.get("mode", "FAILFAST").upper() != "DROPMALFORMED"
        self.tests: list[tuple[str, frozenset[str]]] = []
        self.present: list[str] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = HEADER_COLUMNS.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if name and isinstance(f, EqualTo) and f.value is not None:
                self.tests.append((name, frozenset([str(f.value)])))
            elif name and isinstance(f, In) and None not in f.value:
                self.tests.append((name, frozenset(map(str, f.value))))
            elif name and isinstance(f, IsNotNull):
                self.present.append(name)
            else:
                yield f

    def wanted(self, headers: dict[str, str]) -> bool:
        return all(headers.get(name) in values for name, values in self.tests) and all(name in headers for name in self.present)

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, root = _open(self.folder)
        found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return [_File(f.path) for f in sorted(found, key=lambda f: f.path) if f.is_file and "/_" not in f.path[len(root) :] and f.base_name.endswith((".warc", ".warc.gz"))]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        store, _ = _open(self.folder)
        rows, held = [], 0
        with store.open_input_file(partition.path) as raw:
            packed = partition.path.endswith(".gz")
            source = gzip.GzipFile(fileobj=raw) if packed else io.BufferedReader(raw, 1 << 16)
            for headers, payload in self._records(source, None if packed else raw.size()):
                values = {c: _number(headers.get(h)) if c in _NUMBERS else headers.get(h) for c, h in HEADER_COLUMNS.items()}
                rows.append(values | {"content_length": int(headers.get("Content-Length", 0)), "headers": list(headers.items()), "payload": payload})
                held += len(payload or b"") + 500
                if held > _BATCH_BYTES:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _records(self, source, size: int | None) -> Iterator[tuple[dict[str, str], bytes | None]]:
        try:
            yield from records(source, self.wanted, self.with_payload, self.strict, size)
        except (EOFError, zlib.error, gzip.BadGzipFile):  # the rest of a compressed file cannot be read
            if self.strict:
                raise

    @staticmethod
    def _batch(rows: list[dict]) -> pa.RecordBatch:
        s, n = pa.string(), pa.int64()
        kinds = {"warc_type": s, "record_id": s, "target_uri": s, "page_id": n, "payload_digest": s, "payload_length": n, "refers_to": s, "refers_to_page": n, "content_length": n, "headers": pa.map_(s, s), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in kinds.items()], names=list(kinds))


class WarcWriter(DataSourceArrowWriter):
    """Rows of (page_id, target_uri, record_type, payload, payload_length, payload_digest, refers_to) as records."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.gzip = options["path"], options.get("compression", "gzip").lower() == "gzip"
        self.file_bytes, self.job = int(options.get("file_bytes", FILE_BYTES)), uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _open(self.folder)
        temporary = f"{root}/_temporary-{self.job}"
        store.create_dir(temporary, recursive=True)
        files: list[str] = []
        out, held = None, 0

        def put(data: bytes) -> int:
            data = gzip.compress(data, 1, mtime=0) if self.gzip else data
            out.write(data)
            return len(data)

        try:
            for b in iterator:
                columns = {name: b.column(i).to_pylist() for i, name in enumerate(b.schema.names)}
                for row in zip(*(columns[c] for c in ("record_type", "page_id", "target_uri", "payload", "payload_digest", "payload_length", "refers_to")), strict=True):
                    if out is None or held > self.file_bytes:
                        if out is not None:
                            out.close()
                        files.append(f"{uuid.uuid4().hex}.warc{'.gz' * self.gzip}")
                        out, held = store.open_output_stream(f"{temporary}/{files[-1]}", compression=None), 0
                        put(record("warcinfo", {"WARC-Record-ID": record_id(None), "WARC-Date": "1970-01-01T00:00:00Z", "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))
                    kind, page_id, url, payload, digest, length, refers_to = row
                    held += put(page_record(kind, page_id, url, payload or b"", digest, length, refers_to))
        finally:
            if out is not None:
                out.close()
        return _Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _open(self.folder)
        for m in messages:
            for name in m.files if m else []:
                store.move(f"{root}/_temporary-{self.job}/{name}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        store, root = _open(self.folder)
        temporary = f"{root}/_temporary-{self.job}"
        if store.get_file_info(temporary).type == fs.FileType.Directory:
            store.delete_dir(temporary)


class WarcDataSource(DataSource):
    """``format("warc")``: options path, payload (true or false), mode (FAILFAST or
    DROPMALFORMED, which leaves damaged records out), compression (gzip or none), file_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("archives are only added to; use mode append")
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = LEAST_DEDUP_BYTES) -> DataFrame:
    """A row per record to write: of equal payloads of at least ``least_bytes`` the smallest id is the response.

    A null html is an empty payload. A null id never wins and refers to the response like any other copy; where all
    copies have null ids each is a response, as are repeated rows of the winning id.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("target_uri"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_length", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    copies = rows.where(F.col("payload_length") >= least_bytes).groupBy("payload_digest").agg(F.min("page_id").alias("winner"), F.count(F.lit(1)).alias("n"))
    copies = copies.where("n > 1 and winner is not null").select(F.col("payload_digest").alias("_key"), "winner")
    # Short payloads share few digests and never match: a key of their own spreads them.
    own = F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string"))
    rows = rows.withColumn("_key", F.when(F.col("payload_length") >= least_bytes, F.col("payload_digest")).otherwise(own)).join(copies, "_key", "left")
    revisit = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    return rows.select("page_id", "target_uri", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(~revisit, F.col("payload")).alias("payload"), "payload_length", "payload_digest", F.when(revisit, F.col("winner")).alias("refers_to"))


def archive_pages(pages: DataFrame, folder: str, compression: str = "gzip", **columns) -> None:
    """Write a record per page into the folder; pages may be empty, and columns beyond the three named are ignored."""
    register(pages.sparkSession)
    plan_records(pages, **columns).write.format("warc").option("compression", compression).mode("append").save(folder)


def archived_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) read back from archives.

    A response's length and digest are computed from its payload; a revisit's stand in its headers.
    """
    found = read_warc(spark, folder).where(F.col("warc_type").isin("response", "revisit"))
    own = F.col("warc_type") == "response"
    return found.select("page_id", F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"), F.when(own, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"), F.col("warc_type").alias("record_type"), F.col("refers_to_page").alias("refers_to"))
