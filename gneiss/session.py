"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session: UTC, adaptive execution, overwriting only the partitions written."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a temporary folder, then also set as checkpoint folder, where that is unset on a local master."""
    import tempfile

    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        shared = "file://" + tempfile.mkdtemp(prefix="gneiss-")
        spark.sparkContext.setCheckpointDir(shared)
    return shared


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder every executor sees, under the shared one."""
    import uuid

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession, rows: int = 512, size: str = "16m") -> None:
    """Bound the Arrow batches handed to Python in rows and bytes, as texts and objects may be large. Plans read the
    settings when they run, so they stay on the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def settle(df: DataFrame) -> DataFrame:
    """df computed once, its lineage cut by a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
