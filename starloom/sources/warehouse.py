"""Published tables: immutable folders, and a run log whose newest entry says which are in force.

A run writes new folders only and becomes visible by one entry in the run log, for all its
tables at once. A failed run leaves the published state as it was. Large tables are split
into segments (the fact by month, a dimension by a hash of the id), and a run
rewrites only the segments it changes. A segment that has gathered MANY_FOLDERS folders is written as one.

Runs of one warehouse must not overlap. A file store may let two of them write the same log entry; a commit therefore
reads its entry back and fails if another run is in it, and so does every later reader.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.extract import windows_of_days
from ..operators.rows import literal_rows
from ..schemas import SERVING, STAGING_RECORDS_PER_FILE
from ..session import run_together
from .files import PARQUET, read_parquet, write_parquet

MANY_FOLDERS = 8

LOG_SCHEMA = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("previous_date", T.DateType()),
        T.StructField("run_date", T.DateType()),
        T.StructField("table", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("top_key", T.LongType()),
        T.StructField("writer", T.StringType()),
    ]
)


class Warehouse:
    """The serving tables under one folder of a shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._log = f"{self.root}/run_log"
        literal_rows(spark, LOG_SCHEMA).write.mode("ignore").parquet(f"{self._log}/seq=0")

    def log(self) -> DataFrame:
        """The run log: per finished run, the folders in force after it."""
        with_seq = T.StructType([*LOG_SCHEMA.fields, T.StructField("seq", T.LongType())])
        return self.spark.read.schema(with_seq).option("basePath", self._log).parquet(self._log)

    def entries(self, seq: int | None = None) -> tuple[int, list]:
        """Number and log entries of a finished run, the newest by default (0 and none before the first)."""
        log = self.log()
        number = int(log.agg(F.max("seq")).first()[0] or 0) if seq is None else seq
        found = log.filter(F.col("seq") == number).collect()
        if len({e["writer"] for e in found}) > 1:
            raise RuntimeError(f"two runs have written entry {number} of the run log; remove one of them")
        return number, found

    def next_window(self, run_date: dt.date, job: str = "daily") -> tuple[dt.date, dt.date]:
        """From the day of the job's last finished run (or the fixed first start) to ``run_date``, a business day after it."""
        done = self.log().filter(F.col("job") == job).select(F.col("run_date").alias("current_date"), F.lit(True).alias("succeeded")).distinct()
        last = done.agg(F.max("current_date")).first()[0]
        if last is not None and run_date <= last:
            raise ValueError(f"{run_date} is not after {last}, the day of the last finished run")
        now = literal_rows(self.spark, done.schema, [(run_date, None)])
        window = windows_of_days(done.unionByName(now)).filter(F.col("current_date") == F.lit(run_date)).first()
        return window["previous_date"], run_date

    def read(self, table: str, seq: int | None = None) -> DataFrame:
        """A published table as of a finished run, the newest by default."""
        return Run(self, "", "", None, None, seq).read(table)

    def top_key(self, table: str, seq: int | None = None) -> int:
        """The highest surrogate key of a published table, from the run log."""
        return Run(self, "", "", None, None, seq).top_key(table)

    def begin(self, previous: dt.date, current: dt.date, job: str = "daily", run_id: str | None = None) -> Run:
        """Start a run for the window ``(previous, current]``."""
        return Run(self, job, run_id or f"{current:%Y%m%d}", previous, current)

    def has_run(self, job: str, run_id: str) -> bool:
        return not self.log().filter((F.col("job") == job) & (F.col("run_id") == run_id)).isEmpty()


class Run:
    """One run: sees the published tables and its own writes, and publishes them by ``commit``."""

    def __init__(
        self,
        warehouse: Warehouse,
        job: str,
        run_id: str,
        previous: dt.date | None,
        current: dt.date | None,
        seq: int | None = None,
    ):
        self.warehouse, self.spark = warehouse, warehouse.spark
        self.job, self.run_id, self.previous, self.current = job, run_id, previous, current
        self._folder = f"{job}-{run_id}-{uuid.uuid4().hex[:8]}"
        self._seq, entries = warehouse.entries(seq)
        self._in_force: dict[str, list[tuple[str, str]]] = {}
        self._top_keys: dict[str, int] = {}
        self._staged: dict[str, T.StructType] = {}
        for e in entries:
            if e["table"]:
                self._top_keys[e["table"]] = e["top_key"] or 0
                self._in_force.setdefault(e["table"], []).append((e["segment"], e["folder"]))

    def read(self, table: str, segments: Sequence[str] | None = None) -> DataFrame:
        """The table as this run sees it, or only some of its segments."""
        parts = self._in_force.get(table, [])
        folders = [f for s, f in parts if segments is None or s in segments]
        if not folders:
            return literal_rows(self.spark, SERVING[table])
        return self.spark.read.schema(SERVING[table]).parquet(*folders)

    def segments(self, table: str) -> list[str]:
        """The segments of the table as this run sees it."""
        return sorted({s for s, _ in self._in_force.get(table, [])})

    def top_key(self, table: str) -> int:
        """The highest surrogate key of the table so far."""
        return self._top_keys.get(table, 0)

    def publish(
        self, table: str, rows: DataFrame, segment: Column, replaces: Sequence[str] = (), key: str | None = None, moved: bool = True
    ) -> None:
        """Write rows to new folders by segment; they come on top of all segments not in ``replaces``.

        ``key`` names the surrogate key, whose highest value goes to the run log. With ``moved=False`` each task writes its rows by segment
        where they are: for rows that a shuffle has just spread evenly, so that a large table is not shuffled once more to be laid out.
        """
        counts = Counter(s for s, _ in self._in_force.get(table, []) if s not in set(replaces))
        crowded = [s for s, n in counts.items() if n >= MANY_FOLDERS]
        if crowded:
            rows = rows.select(*SERVING[table].names).unionByName(self.read(table, crowded))
            replaces = [*replaces, *crowded]
        folder = f"{self.warehouse.root}/serving/{table}/run={self._folder}"
        columns = SERVING[table].names
        # Rebalancing by segment gives few files per segment, and splits a segment that is too large.
        out = rows.select(*columns, segment.alias("segment"))
        out = out.hint("rebalance", "segment") if moved else out
        out.write.mode("error").options(**PARQUET).partitionBy("segment").parquet(folder)
        # Partition values and the key only: one row per segment to the driver.
        layout = T.StructType([*SERVING[table].fields, T.StructField("segment", T.StringType())])
        back = self.spark.read.schema(layout).parquet(folder)
        written = back.groupBy("segment").agg(F.max(key or F.lit(0)).alias("top")).collect()
        self._top_keys[table] = max([self.top_key(table), *(w["top"] or 0 for w in written)])
        kept = [(s, f) for s, f in self._in_force.get(table, []) if s not in set(replaces)]
        self._in_force[table] = kept + sorted((w["segment"], f"{folder}/segment={w['segment']}") for w in written)

    def stage(self, name: str, rows: DataFrame, sort: Sequence[str] = ()) -> DataFrame:
        """Write an intermediate table of this run and read it back: later steps start from it."""
        self._staged[name] = rows.schema
        records = STAGING_RECORDS_PER_FILE if sort else None
        write_parquet(rows, self._staging(name), sort, records)
        return read_parquet(self.spark, self._staging(name), rows.schema)

    def staged(self, name: str, schema: T.StructType) -> DataFrame:
        return read_parquet(self.spark, self._staging(name), schema)

    def clear(self, name: str, schema: T.StructType) -> None:
        """Empty an intermediate table, once the run is published."""
        literal_rows(self.spark, schema).write.mode("overwrite").parquet(self._staging(name))

    def clear_all(self, keep: Sequence[str] = ()) -> None:
        """Empty all intermediate tables of this run but those to keep."""
        run_together([lambda n=n, s=s: self.clear(n, s) for n, s in self._staged.items() if n not in keep])

    def commit(self) -> None:
        """Make the run visible. Fails if another run has finished since this one began, or finishes at the same time."""
        window = (self.job, self.run_id, self.previous, self.current)
        entries = [(*window, t, s, f, self.top_key(t), self._folder) for t, parts in sorted(self._in_force.items()) for s, f in parts]
        rows = self.spark.createDataFrame(entries or [(*window, None, None, None, None, self._folder)], LOG_SCHEMA)
        rows.coalesce(1).write.mode("error").parquet(f"{self.warehouse._log}/seq={self._seq + 1}")
        self.warehouse.entries(self._seq + 1)

    def _staging(self, name: str) -> str:
        return f"{self.warehouse.root}/staging/run={self._folder}/{name}"
