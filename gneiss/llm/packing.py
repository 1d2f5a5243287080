"""Harmonic packing of tokenized documents into sequences of a fixed capacity.

A document is cut into full sequences, then into halves, quarters and eighths of the capacity, and one rest. A piece of
length n belongs to class k = floor(capacity / n) and a bin of class k takes k pieces, so it is filled to k / (k + 1) at
least; there are about twice the square root of the capacity classes. Pieces of a class are numbered
through (partition counts, then a running sum over the small table of counts), so each worker fills its bins without
seeing the others' pieces. What is left over of each class, fewer than k pieces, is a bounded set that is packed last by
first fit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gneiss.llm.common import bounded_batches, settle
from gneiss.llm.tokens import END_ID, decoded, default_path, encoder

CAPACITY = 1024
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker int, class int, place long"


def cuts(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces, in order: full ones, then a half, a quarter and an eighth where they fit, the rest."""
    full, rest = divmod(tokens, capacity)
    out = [capacity] * full
    for part in (capacity // 2, capacity // 4, capacity // 8):
        if part and rest >= part:
            out.append(part)
            rest -= part
    return out + [rest] * (rest > 0)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Spans of each document's ids with their class and their number among the class's pieces of this worker.

    with_ids adds the ids themselves (binary, unsigned 32-bit little-endian).
    """
    bounded_batches(docs.sparkSession)
    path = tokenizer or default_path()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, seen, encode = TaskContext.get().partitionId(), {}, encoder(path).encode
        for b in batches:
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), encode(decoded(b.column(1).cast(pa.binary()).to_pylist())), strict=True):
                ids += end
                start = 0
                for n in cuts(len(ids) // 4, capacity):
                    own = ids[4 * start : 4 * (start + n)]
                    k = capacity // n
                    rows.append((doc_id, start, n, zlib.crc32(own), len(ids) // 4, worker, k, seen.get(k, 0), *([own] * with_ids)))
                    seen[k] = seen.get(k, 0) + 1
                    start += n
            kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()] + [pa.binary()] * with_ids
            names = [x.split()[0] for x in _PIECES.split(", ")] + ["ids"] * with_ids
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, _PIECES + ", ids binary" * with_ids)


def _first_fit(capacity: int, base: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "class", "number"], ascending=[False, True, True], kind="stable")
        room: list[int] = []
        at, offset = [], []
        for n in rows["length"]:
            bin_ = next((i for i, r in enumerate(room) if r >= n), len(room))
            if bin_ == len(room):
                room.append(capacity)
            at.append(base + bin_)
            offset.append(capacity - room[bin_])
            room[bin_] -= n
        return rows.assign(sequence_id=at, offset=offset)

    return run


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to settled pieces (see ``pieces``)."""
    counts = found.groupBy("class", "worker").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0)))
    totals = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}  # a row for each class
    first, table = 0, []
    for k in sorted(totals):
        table.append((k, first, totals[k] // k * k))
        first += totals[k] // k
    spark = found.sparkSession
    classes = spark.createDataFrame(table or [(0, 0, 0)], "class int, first long, whole long")
    kept = [c for c in found.columns if c not in ("worker", "place")]
    rows = found.join(counts.drop("n"), ["class", "worker"]).join(F.broadcast(classes), "class")
    rows = rows.select(*kept, (F.col("before") + F.col("place")).alias("number"), "first", "whole")
    bins = rows.where("number < whole").withColumn("sequence_id", F.expr("first + number div class"))
    within = Window.partitionBy("sequence_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)))
    left = rows.where("number >= whole")  # fewer than k pieces of each class k
    schema = left.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    left = left.groupBy(F.lit("rest").alias("set")).applyInPandas(_first_fit(capacity, first), schema)
    return bins.unionByName(left).drop("class", "number", "first", "whole")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), one row per piece.

    Ids are those of the tokenizer file and the end id. A null or empty text has the end id alone. Repeated rows are
    packed once each and a null id stays null; other columns are ignored; an empty table gives no rows.
    """
    return pack(settle(pieces(docs, id_col, text_col, tokenizer, capacity, with_ids)), capacity).withColumnRenamed("doc_id", id_col)
