"""What the operators of this subpackage share: the shared folder, lineage cuts and table reads."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch handed to Python, whichever comes first; both bound a worker's memory.
ARROW_ROWS, ARROW_BYTES = 512, "16m"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: the session's spark.checkpoint.dir.

    Only where none is set on a local master (tests) a folder is made and set as the checkpoint folder; on a cluster a
    missing setting is an error, as a machine-local folder would be seen by one machine alone.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        found = "file://" + tempfile.mkdtemp(prefix="gneiss-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def settle(df: DataFrame) -> DataFrame:
    """Compute df once and cut its lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches sent to Python small, as texts may be very long. The settings are read when a plan runs,
    after an operator has returned, so they stay on the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string")) % modulus
