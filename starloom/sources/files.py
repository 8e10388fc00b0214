"""CSV and parquet files, and where the daily extracts lie."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import run_together


def extract_path(root: str, run_date: dt.date | str, table: str, kind: str = "csv") -> str:
    """``root/2024/10/09/20241009-orders.csv``; the date may be a date or ``yyyymmdd`` text."""
    day = run_date if isinstance(run_date, dt.date) else dt.datetime.strptime(run_date, "%Y%m%d").date()
    return f"{root.rstrip('/')}/{day:%Y/%m/%d}/{day:%Y%m%d}-{table}.{kind}"


# Zstd takes about two thirds of the default's bytes. Without dictionaries, which zstd makes up for, order lines take the same bytes and
# half the time: most of their columns have too many values for one, and the writer tells so only after it has built it.
PARQUET = {"compression": "zstd", "parquet.enable.dictionary": "false"}


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, strict_header: bool = True) -> DataFrame:
    """CSV with a header and a fixed schema; a cell that does not fit its type becomes NULL.

    A doubled quote inside a quoted field is one quote. The header must name the schema's
    columns in order; with ``strict_header=False`` it is skipped and columns bind by position.
    """
    reader = spark.read.schema(schema).options(header=True, escape='"', enforceSchema=not strict_header)
    return reader.csv(path if isinstance(path, str) else list(path))


MISFIT_COLUMNS = ["file", "line", "misfit"]
WRONG_NUMBER = "number of cells"


def read_csv_checked(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, strict_header: bool = True) -> DataFrame:
    """The same rows as ``read_csv``, and for each line that does not fit the schema where it is from and why.

    ``file`` is the path read. ``misfit`` is empty for a line that fits, and otherwise names the columns whose cells do not fit their
    types, comma-separated, or is ``WRONG_NUMBER`` if there are too many or too few cells; ``line`` is the text of such a line.
    """
    # The reader tells misfits by the columns that are asked for. A test of ``misfit`` needs all of them, so it is right for any selection.
    nullable = [T.StructField(f.name, f.dataType) for f in schema.fields]
    reader = spark.read.schema(T.StructType([*nullable, T.StructField("line", T.StringType())]))
    reader = reader.options(header=True, escape='"', enforceSchema=not strict_header, columnNameOfCorruptRecord="line")
    found = reader.csv(path if isinstance(path, str) else list(path))
    cells = F.from_csv("line", ", ".join(f"`{n}` STRING" for n in schema.names), {"escape": '"'})
    found = found.select(*schema.names, F.col("_metadata.file_path").alias("file"), "line", cells.alias("_cells"))
    bad = F.array_compact(F.array(*[F.when(F.col(n).isNull() & F.col("_cells")[n].isNotNull(), F.lit(n)) for n in schema.names]))
    why = F.when(F.size(bad) > 0, F.array_join(bad, ",")).otherwise(WRONG_NUMBER)
    return found.withColumn("misfit", F.when(F.col("line").isNull(), "").otherwise(why)).drop("_cells")


def split_misfits(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of checked lines, the rows that fit, and ``MISFIT_COLUMNS`` of those that do not."""
    return checked.filter("misfit = ''").drop(*MISFIT_COLUMNS), checked.filter("misfit <> ''").select(*MISFIT_COLUMNS)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; replaces what is there. One file per task, no funnel through one."""
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Parquet with exactly the columns of ``schema``, in its order; raises if they differ."""
    found = spark.read.parquet(*([path] if isinstance(path, str) else path))
    have = {f.name: f.dataType for f in found.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    if have != want:
        different = sorted(n for n in have.keys() | want.keys() if have.get(n) != want.get(n))
        raise ValueError(f"{path}: columns differ from the schema: {', '.join(different)}")
    return found.select(*schema.names)


def write_parquet(
    df: DataFrame, path: str, sort: Sequence[str] = (), records_per_file: int | None = None
) -> None:
    """Parquet, replacing what is there. ``records_per_file`` bounds the rows of a file, as the staging outputs ask.

    The tasks are those of the plan: AQE has sized them after a shuffle, the scan otherwise, so
    the rows are not moved once more for the write. ``sort`` orders rows inside each file, which
    is what readers gain from (row-group statistics).
    """
    rows = df.sortWithinPartitions(*sort) if sort else df
    rows.write.mode("overwrite").options(**PARQUET, maxRecordsPerFile=records_per_file or 0).parquet(path)


def import_csv(spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType], target: str) -> dict[str, DataFrame]:
    """Load ``folder/<table>.csv`` for every table into parquet under ``target``; returns the tables."""

    def load(name: str) -> DataFrame:
        write_parquet(read_csv(spark, f"{folder}/{name}.csv", schemas[name]), f"{target}/{name}")
        return read_parquet(spark, f"{target}/{name}", schemas[name])

    return dict(zip(schemas, run_together([lambda n=n: load(n) for n in schemas])))


def export_csv(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Write every table to ``folder/<table>.csv``."""
    run_together([lambda n=n, t=t: write_csv(t, f"{folder}/{n}.csv") for n, t in tables.items()])
