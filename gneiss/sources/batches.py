"""Tables of plain Parquet that batches write again and again without doubling or losing rows.

A batch's rows are a partition of their own that the same batch overwrites, or they are folded into the partitions they
touch. Nothing but Spark's dynamic partition overwrite is used; there is no log and no version.
"""

from __future__ import annotations

import re
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch_key"


def _place(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder has come to its end."""
    fs, at = _place(spark, f"{path}/_SUCCESS")
    return fs.exists(at)


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _place(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """The entries of a folder, sorted; none where it is absent."""
    fs, at = _place(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, such as a manifest or a marker, written whole or replaced."""
    fs, at = _place(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where it is absent."""
    fs, at = _place(spark, path)
    if not fs.exists(at):
        return None
    found = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(found, "UTF-8")
    finally:
        found.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _place(spark, path)
    fs.delete(at, True)


def replace_batch(rows: DataFrame, path: str, batch: str, by: Sequence[str] = ()) -> None:
    """Write a batch's rows as a folder of its own; a rerun replaces all of them, and no other batch's.

    A batch's name holds letters, digits and ``. : - _`` only.
    """
    if not re.fullmatch(r"[\w.:-]+", batch):
        raise ValueError(f"{batch!r} does not name a batch")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(f"{path}/{BATCH}={batch.replace(':', '%3A')}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches; the batch is a string column."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/{BATCH}=*")
    return rows.withColumn(BATCH, F.col(BATCH).cast("string"))


def as_of_batch(spark: SparkSession, path: str, keys: Sequence[str], batch: str) -> DataFrame:
    """The newest row of each key among the batches up to one, in the order of their names."""
    rows = read_batches(spark, path).where(F.col(BATCH) <= str(batch))
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(BATCH)).alias("r")).select(*keys, "r.*")


def fold(rows: DataFrame, path: str, keys: Sequence[str], order: str, by: str, run: str, files: int = 1) -> int:
    """Fold rows into a table: the row of the greatest ``order`` wins for each key; (partitions written).

    ``by`` is a column that the keys determine, such as a day; only the partitions that the rows touch are written, each
    as so many files. The new partitions are finished in a staging folder of the run before any old one goes, so a run
    that died anywhere can be repeated: it takes what is staged if that is finished, and else starts from a table that it
    has not touched. The staging folders of earlier runs are removed.
    """
    spark = rows.sparkSession
    stage = f"{path}/_stage/{run}"
    if not finished(spark, stage):
        touched = [r[by] for r in rows.select(by).distinct().collect()]  # a value for each partition written
        new = rows.select(*sorted(rows.columns))
        if any(n.startswith(f"{by}=") for n in names(spark, path)):
            old = spark.read.schema(new.schema).parquet(path).where(F.col(by).isin(touched))
            new = new.unionByName(old.select(*new.columns))
        rest = [c for c in new.columns if c not in (*keys, order)]
        newest = new.groupBy(*keys).agg(F.max(order).alias(order), F.max_by(F.struct(*rest), order).alias("_r"))
        newest.select(*keys, order, "_r.*").write.mode("overwrite").partitionBy(by).parquet(stage)
    # A stage without rows has no file to tell the columns from.
    staged = spark.read.schema(rows.schema).parquet(stage)
    spread = staged.repartition(F.col(by), F.pmod(F.xxhash64(*keys), F.lit(files)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    written = len([n for n in names(spark, stage) if n.startswith(f"{by}=")])
    for n in names(spark, f"{path}/_stage"):
        if n < run:
            remove(spark, f"{path}/_stage/{n}")
    return written


class Audit:
    """Load and lineage rows of a run, buffered until flushed; a flush is a batch of its own that a rerun replaces."""

    LOAD = "stage string, batch_id string, entity string, status string, rows_in long, rows_out long, rows_rejected long, message string, at double"
    LINEAGE = "step string, transform_type string, sources array<string>, target string, rows_in long, rows_out long, details string, at double"

    def __init__(self, spark: SparkSession, path: str, stage: str, batch_id: str):
        self.spark, self.path, self.stage, self.batch_id = spark, path, stage, batch_id
        self._rows: dict[str, list[tuple]] = {"loads": [], "lineage": []}
        self._flushes = 0

    def load(self, entity: str, status: str, rows_in: int | None = None, rows_out: int | None = None, rows_rejected: int | None = None, message: str = "") -> None:
        self._rows["loads"].append((self.stage, self.batch_id, entity, status, rows_in, rows_out, rows_rejected, message[:500], time.time()))

    def transform(self, step: str, kind: str, sources: Sequence[str], target: str, rows_in: int | None = None, rows_out: int | None = None, details: str = "") -> None:
        self._rows["lineage"].append((step, kind, list(sources), target, rows_in, rows_out, details, time.time()))

    def flush(self) -> None:
        for (name, rows), schema in zip(self._rows.items(), (self.LOAD, self.LINEAGE), strict=True):
            if rows:
                replace_batch(self.spark.createDataFrame(rows, schema), f"{self.path}/{name}", f"{self.stage}-{self.batch_id}-{self._flushes}")
                rows.clear()
        self._flushes += 1

    def loads(self) -> DataFrame:
        return read_batches(self.spark, f"{self.path}/loads").drop(BATCH)


def committed_since_complete(audit: DataFrame, batch_id: str) -> DataFrame:
    """Entities committed after the batch's last COMPLETED: what a resumed run may skip."""
    own = audit.where(F.col("batch_id") == batch_id)
    done = own.where("status = 'COMPLETED'").agg(F.coalesce(F.max("at"), F.lit(0.0)).alias("_done"))
    return own.where("status = 'COMMITTED'").crossJoin(F.broadcast(done)).where("at > _done").select("entity").distinct()


def publish(spark: SparkSession, path: str, rows: Sequence[dict], schema: str, batch: str) -> None:
    """Write a few result rows (dicts by column; a missing column is null) as a batch that a repeated call replaces."""
    names = [f.split()[0] for f in schema.split(", ")]
    replace_batch(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema), path, batch)
