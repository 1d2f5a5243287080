"""Readers of landed files: manifests, dumps, pipe-separated files, JSON lines, binary objects, stream files."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gneiss.operators.joins import BROADCAST_ROWS
from gneiss.plans.contracts import Contract
from gneiss.sources.dumps import read_dump

STREAM_SCHEMA = "key string, timestamp long, value string, topic string"


_MANIFEST = "source string, business_date string, batch_id string, file_count int, files array<struct<name:string,size:long,sha256:string,entity:string,records:long,pages:long,control_total:double>>"


def manifests(spark: SparkSession, landing: str, date: str) -> DataFrame:
    """A row per listed file of each source's manifest of a date: source, name, size, sha256, records, control_total.

    Spark's readers pass over names that begin with an underscore, so the manifests (one small file per source) are
    read through the file system's own calls.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{landing}/*/{date}/_manifest.json")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    texts = []
    for found in fs.globStatus(pattern):
        stream = fs.open(found.getPath())
        try:
            texts.append((jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"),))
        finally:
            stream.close()
    raw = spark.createDataFrame(texts, "value string").select(F.from_json("value", _MANIFEST).alias("m")).select("m.*")
    return raw.select("source", "business_date", "batch_id", F.explode("files").alias("f")).select("source", "business_date", "batch_id", "f.*")


def _with_source(df: DataFrame) -> DataFrame:
    return df.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/\\]+)$", 1).alias("_source_file"), "*")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(_source_file, _source_row, _first, value): numbered lines, empty ones left out, and the first line of their file.

    Files are split. Lines are counted in each split first; a split's lines are numbered from the sum of those before.
    """
    place = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block")]
    raw = _with_source(spark.read.text(path, lineSep="\n").select(*place, "_metadata", F.regexp_replace("value", "\r$", "").alias("value"))).drop("_metadata")
    counted = raw.withColumn("_i", F.monotonically_increasing_id()).groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min_by("value", "_i").alias("_line"))
    of_file = Window.partitionBy("_path").orderBy("_block")
    before = F.coalesce(F.sum("_n").over(of_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = counted.select("_path", "_block", before.alias("_before"), F.first("_line").over(of_file).alias("_first"))
    few = splits.limit(BROADCAST_ROWS + 1).collect()  # a row for each split, kept only up to the limit
    if len(few) <= BROADCAST_ROWS:
        splits = F.broadcast(spark.createDataFrame(few, splits.schema))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A split lies in one task, its lines in order."""
        split, at = None, 0
        for b in batches:
            paths, blocks = b.column("_path").to_pylist(), b.column("_block").to_pylist()
            rows = []
            for here in zip(paths, blocks, strict=True):
                split, at = here, at + 1 if here == split else 1
                rows.append(at)
            yield b.append_column("_at", pa.array(rows, pa.int64()))

    numbered = raw.mapInArrow(number, "_source_file string, _path string, _block long, value string, _at long")
    found = numbered.join(splits, ["_path", "_block"]).where("value <> ''")
    return found.select("_source_file", (F.col("_before") + F.col("_at")).alias("_source_row"), "_first", "value")


def read_psv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Pipe-separated rows by header name; empty values are null and the trailer line is left out."""
    rows = _lines(spark, path).where("_source_row > 1 and not startswith(value, 'T|')")
    rows = rows.withColumns({"_head": F.split("_first", r"\|"), "_v": F.split("value", r"\|", -1)})
    pick = [F.when(F.array_position("_head", c) > 0, F.get("_v", (F.array_position("_head", c) - 1).cast("int"))).alias(c) for c in columns]
    found = rows.select("_source_file", "_source_row", *pick)
    return found.select("_source_file", "_source_row", *(F.when(F.col(c) != "", F.col(c)).alias(c) for c in columns))


def psv_stats(spark: SparkSession, path: str) -> DataFrame:
    """(file, data lines, trailer count, trailer total) of each file."""
    lines = _lines(spark, path)
    trailer = F.startswith("value", F.lit("T|"))
    part = lambda i: F.max(F.when(trailer, F.get(F.split("value", r"\|"), F.lit(i))))
    return lines.groupBy("_source_file").agg(
        F.sum(F.when(~trailer & (F.col("_source_row") > 1), 1).otherwise(0)).alias("n_lines"), part(1).try_cast("long").alias("trailer_count"),
        part(2).try_cast("double").alias("trailer_total"),
    )


def read_jsonl(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """JSON lines as strings (nested values as JSON) with the raw line and a parse error; a non-object is an error too."""
    lines = _lines(spark, path)
    m = F.from_json("value", ", ".join(f"`{c}` string" for c in [*columns, "_corrupt"]), {"columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.withColumn("m", m)
    bad = F.col("m._corrupt").isNotNull() | ~F.col("value").rlike(r"^\s*\{")
    return rows.select("_source_file", "_source_row", *(F.when(~bad, F.col(f"m.{c}")).alias(c) for c in columns), F.col("value").alias("payload"), F.when(bad, "MALFORMED_JSON").alias("_parse_error"))


def raw_frame(spark: SparkSession, contract: Contract, path: str) -> DataFrame:
    """The reader of the contract's format; an unknown format is an error."""
    kind, names = contract.options.get("format"), contract.names
    readers: dict[str, Callable[[], DataFrame]] = {
        "mysqldump": lambda: read_dump(spark, path, contract.options.get("table", contract.entity), names),
        "psv": lambda: read_psv(spark, path, names),
        "jsonl": lambda: read_jsonl(spark, path, names),
    }
    if kind not in readers:
        raise ValueError(f"{contract.entity}: unknown format {kind}")
    return readers[kind]()


def binary_objects(spark: SparkSession, path: str) -> DataFrame:
    """(path, file_name, size, sha256, content) of the files under a path."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return raw.select("path", F.regexp_extract("path", r"([^/\\]+)$", 1).alias("file_name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), "content")


def manifest_checks(listed: DataFrame, objects: DataFrame, formats: DataFrame | None = None) -> DataFrame:
    """Adds the verdict on each listed file: MISSING_FILE, UNKNOWN_FORMAT, SIZE_MISMATCH, SHA_MISMATCH or, with the
    ``formats.verdicts`` of the objects, what its bytes lack; else OK."""
    found = objects.select(F.col("file_name").alias("name"), F.col("size").alias("_size"), F.col("sha256").alias("_sha"))
    known = F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)).isin("pdf", "png", "sgy", "segy", "las", "avi", "json")
    if formats is not None:
        found = found.join(formats.select(F.col("file_name").alias("name"), F.col("format_verdict").alias("_format")), "name", "left")
    else:
        found = found.withColumn("_format", F.lit("OK"))
    verdict = F.when(F.col("_sha").isNull(), "MISSING_FILE").when(~known, "UNKNOWN_FORMAT").when(
        F.col("size") != F.col("_size"), "SIZE_MISMATCH",
    ).when(F.col("sha256") != F.col("_sha"), "SHA_MISMATCH").otherwise(F.coalesce("_format", F.lit("OK")))
    return listed.join(found, "name", "left").withColumn("verdict", verdict).drop("_size", "_sha", "_format")


def stream_files(spark: SparkSession, path: str, files_per_trigger: int = 24) -> DataFrame:
    """A stream of message files with the columns of a message bus."""
    return spark.readStream.schema(STREAM_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(path)


def topic_files(spark: SparkSession, root: str, topics: Sequence[str], files_per_trigger: int = 24) -> DataFrame:
    """One stream of the message files of several topics, each in the folder of its name."""
    return reduce(DataFrame.unionByName, [stream_files(spark, f"{root}/{t}", files_per_trigger).withColumn("topic", F.lit(t)) for t in topics])


def bus_stream(spark: SparkSession, servers: str, topics: Sequence[str], options: dict | None = None) -> DataFrame:
    """The same columns from Kafka, where its connector is on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("failOnDataLoss", "false")
    return reader.options(**(options or {})).load().select(F.col("key").cast("string"), F.unix_millis("timestamp").alias("timestamp"), F.col("value").cast("string"), "topic")


def write_stream_files(messages: DataFrame, path: str) -> None:
    """Messages as JSON lines in a folder per topic and hour of sending."""
    hour = F.date_format(F.timestamp_millis("timestamp"), "yyyyMMddHH")
    messages.withColumn("hour", hour).write.mode("append").partitionBy("topic", "hour").json(path)
