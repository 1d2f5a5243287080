"""Token files: an id array with Elias-Fano coded document boundaries.

A file holds, little-endian: magic, seven unsigned 64-bit numbers (documents, documents with a null id, ids, bytes per
id, low bits, bytes of the high bits, documents between select samples), document ids (signed 64-bit), the low bits of
the document ends, their high bits in unary, the bit position of every sampled end, and the ids. Ids take two bytes if
the vocabulary allows. No table of 64-bit offsets is kept: the i-th end is the i-th set bit of the high bits, found
from the nearest sample, and its low bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gneiss.llm.common import bounded_batches, settle
from gneiss.llm.tokens import END_ID, decoded, default_path, encoder

MAGIC = b"GNTOKEN1"
SAMPLE = 512
#: A partition starts another file after so many ids or documents.
FILE_IDS, FILE_DOCUMENTS = 16_000_000, 1_000_000
_BATCH_BYTES = 8_000_000
_MANIFEST = "part int, piece int, path string, n_docs long, n_ids long"


class EliasFano:
    """A non-decreasing sequence of ends below or at ``total``."""

    def __init__(self, low_bits: int, count: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray, sample: int = SAMPLE):
        self.low_bits, self.count, self.low, self.high, self.samples, self.sample = low_bits, count, low, high, samples, sample

    @classmethod
    def encode(cls, ends: np.ndarray, total: int, sample: int = SAMPLE) -> EliasFano:
        ends = ends.astype(np.uint64)
        n = len(ends)
        bits = max(0, (total // n).bit_length() - 1) if n else 0
        low = (ends[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        at = (ends >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(at[-1]) // 8 + 1) * 8 if n else 0, dtype=np.uint8)
        high[at] = 1
        return cls(bits, n, np.packbits(low.astype(np.uint8).ravel(), bitorder="little"), np.packbits(high, bitorder="little"), at[::sample].astype("<i8"), sample)

    def _low(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, dtype=np.int64)
        begin, end = first * self.low_bits, (first + count) * self.low_bits
        bits = np.unpackbits(self.low[begin // 8 : -(-end // 8)], bitorder="little")[begin % 8 : begin % 8 + end - begin]
        return bits.reshape(count, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, i: int) -> int:
        """The i-th end, read from the sample before it on."""
        at = int(self.samples[i // self.sample])
        left, byte = i % self.sample, at // 8
        word = int(self.high[byte]) >> at % 8 << at % 8
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        return (byte * 8 + (word & -word).bit_length() - 1 - i << self.low_bits) + int(self._low(i, 1)[0])

    def ends(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        return (at - np.arange(self.count) << self.low_bits) + self._low(0, self.count)


def pack_file(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """The bytes of a file; ``ids`` are unsigned 32-bit little-endian, documents with a null id come first."""
    ends = np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    ef = EliasFano.encode(ends, total)
    head = np.array([len(ids), sum(x is None for x in doc_ids), total, width, ef.low_bits, len(ef.high), ef.sample], dtype="<u8")
    array = np.frombuffer(b"".join(ids), dtype="<u4").astype(f"<u{width}")
    return b"".join((MAGIC, head.tobytes(), np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(), ef.low.tobytes(), ef.high.tobytes(), ef.samples.tobytes(), array.tobytes()))


class TokenFile:
    """A file's documents; ``document(i)`` reads one without the others."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        n, nulls, self.total, width, bits, high, sample = (int(x) for x in np.frombuffer(data, "<u8", 7, 8))
        at = 64
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.nulls, at = nulls, at + 8 * n
        low = np.frombuffer(data, np.uint8, -(-n * bits // 8), at)
        at += len(low)
        self.bounds = EliasFano(bits, n, low, np.frombuffer(data, np.uint8, high, at), np.frombuffer(data, "<i8", -(-n // sample), at + high), sample)
        self.ids = np.frombuffer(data, f"<u{width}", self.total, at + high + 8 * -(-n // sample))

    def __len__(self) -> int:
        return self.bounds.count

    def span(self, i: int) -> tuple[int, int]:
        return (self.bounds.select(i - 1) if i else 0), self.bounds.select(i)

    def document(self, i: int) -> np.ndarray:
        start, end = self.span(i)
        return self.ids[start:end]


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Write all documents in ascending id order (nulls first, equal ids by the text's hash); returns the settled manifest.

    A null text has the end id alone; an empty table writes no file. Partitions are ranges of ids. A file is written under a name of its own and then renamed to one that its place
    gives, so a repeated task replaces the same file with the same bytes.
    """
    bounded_batches(docs.sparkSession)
    path = tokenizer or default_path()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        encode = encoder(path)
        width = 2 if encode.library.get_vocab_size() <= 1 << 16 else 4
        part, made, doc_ids, ids, held = TaskContext.get().partitionId(), 0, [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal made, doc_ids, ids, held
            name = f"{root}/part-{part:06d}-{made:04d}.tokens"
            with store.open_output_stream(own := f"{name}.{uuid.uuid4().hex}") as f:
                f.write(pack_file(doc_ids, ids, width))
            store.move(own, name)
            row = {"part": [part], "piece": [made], "path": [name], "n_docs": [len(ids)], "n_ids": [held]}
            made, doc_ids, ids, held = made + 1, [], [], 0
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("piece", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

        for b in batches:
            for doc_id, x in zip(b.column(0).to_pylist(), encode.encode(decoded(b.column(1).cast(pa.binary()).to_pylist())), strict=True):
                doc_ids.append(doc_id)
                ids.append(x + end)
                held += len(x) // 4 + 1
                if held >= file_ids or len(ids) >= FILE_DOCUMENTS:
                    yield flush()
        if ids:
            yield flush()

    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h").select("id", "text")
    return settle(dealt.mapInArrow(run, _MANIFEST))


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) from the files of a manifest: ids as unsigned 32-bit little-endian.

    start counts the ids of all documents before, over all files; it is a running sum over one manifest row per file.
    """
    spark: SparkSession = manifest.sparkSession
    before = F.sum("n_ids").over(Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("base", F.coalesce(before, F.lit(0))).select("path", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open(folder)
        for b in batches:
            for path, base in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with store.open_input_file(path) as f:
                    found = TokenFile(f.read())
                ends = found.bounds.ends()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                first = 0
                while first < len(found):
                    last = max(first + 1, int(np.searchsorted(ends, starts[first] + _BATCH_BYTES // 4, "right")))
                    values = found.ids[starts[first] : ends[last - 1]].astype("<u4")
                    offsets = np.concatenate([starts[first:last], ends[last - 1 : last]]) - starts[first]
                    column = pa.Array.from_buffers(pa.large_binary(), last - first, [None, pa.py_buffer((offsets * 4).astype("<i8").tobytes()), pa.py_buffer(values.tobytes())]).cast(pa.binary())
                    doc_ids = pa.array(found.doc_ids[first:last], mask=np.arange(first, last) < found.nulls)
                    yield pa.RecordBatch.from_arrays([doc_ids, pa.array(starts[first:last] + base), pa.array(ends[first:last] - starts[first:last]), column], names=["doc_id", "start", "n_tokens", "ids"])
                    first = last

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(parts, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
