"""Failure drills: one task of a plan dies on purpose."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame


class DrillFailure(RuntimeError):
    """The failure that a drill plants."""


def fail_on_partition(df: DataFrame, partition: int = 0, attempts: int | None = 1) -> DataFrame:
    """df's rows, but the task of one partition fails after its first batch, on its first ``attempts`` attempts or, with
    None, on all. A retried task gives the same rows; a write that fails for good must leave nothing that readers see."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        dies = task.partitionId() == partition and (attempts is None or task.attemptNumber() < attempts)
        for b in batches:
            yield b
            if dies:
                raise DrillFailure(f"partition {partition}, attempt {task.attemptNumber()}")
        if dies:
            raise DrillFailure(f"partition {partition}, attempt {task.attemptNumber()}")

    return df.mapInArrow(run, df.schema)
