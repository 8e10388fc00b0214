"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def tasks_for(rows: int, each: int) -> int:
    """Tasks that get about ``each`` rows."""
    return max(1, -(-rows // each))


def stored(rows: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
    """The rows, written to the folder that all executors share and read back: cuts the lineage and survives a lost executor.

    ``tasks``: the last step runs in so many tasks at most, for results whose size is known, so that small ones are not many files.
    """
    rows = rows.coalesce(tasks) if tasks else rows
    path = scratch_path(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
