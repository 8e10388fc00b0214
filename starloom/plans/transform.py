"""Jobs from files to files: one day's extracts to CSV, one day's CSV to staging parquet.

    python -m starloom.plans.transform RAW_ROOT YYYYMMDD PROCESSED_ROOT [reject]
"""

from __future__ import annotations

import datetime as dt
import logging
import sys
from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.extract import EXTRACTIONS, Day
from ..operators.staging import STAGE, STAGING_ORDER, complete_lines, repeated_lines, stage_date, stage_sales
from ..schemas import DATE, EXTRACT, STAGING, STAGING_RECORDS_PER_FILE
from ..session import build_session, run_together, scratch_path
from ..sources.files import extract_path, read_csv, read_csv_checked, read_parquet, split_misfits, write_csv, write_parquet


def export_extracts(
    tables: Mapping[str, DataFrame], previous: Day, current: Day, raw_root: str, run_date: dt.date | str
) -> None:
    """Write the five extracts of a window as CSV under the path of ``run_date``."""
    run_together(
        [
            lambda n=n, f=f: write_csv(f(tables, previous, current), extract_path(raw_root, run_date, n))
            for n, f in EXTRACTIONS.items()
        ]
    )


def staging_path(processed_root: str, run_date: dt.date | str, table: str) -> str:
    """``root/2024/10/09/table``."""
    return extract_path(processed_root, run_date, table).rsplit("/", 1)[0] + f"/{table}"


def transform_day(spark: SparkSession, raw_root: str, run_date: dt.date | str, processed_root: str, reject: bool = False) -> None:
    """Read one day's five CSV extracts and write the six staging tables.

    A cell that does not fit its type is read as NULL. With ``reject`` its line is left out instead, and all such lines are
    written to the table ``rejected`` beside the staging tables, with their extract, file and the reason.
    """
    paths = {n: extract_path(raw_root, run_date, n) for n in EXTRACT}
    if reject:
        extracts = _without_misfits(spark, paths, staging_path(processed_root, run_date, "rejected"))
    else:
        # Two tables come from the orders: their text is parsed once.
        extracts = {n: read_csv(spark, paths[n], s) for n, s in EXTRACT.items()}
        extracts["orders"] = _landed(spark, "orders", extracts["orders"])
    staged = {name: stage(extracts[name]) for name, stage in STAGE.items()}
    staged |= {"date": stage_date(extracts["orders"]), "sales": _one_of_repeated(spark, extracts["orders"])}
    run_together(
        [
            lambda n=n, df=df: write_parquet(
                df, staging_path(processed_root, run_date, n), STAGING_ORDER[n], STAGING_RECORDS_PER_FILE
            )
            for n, df in staged.items()
        ]
    )


def transform_days(spark: SparkSession, raw_root: str, days: Sequence[dt.date], processed_root: str) -> None:
    """Stage the extracts of many days in one job: for each the rows of ``transform_day``, in tables partitioned by ``run_date``.

    One scan reads the files of all days, and each file tells its day. Of the tables (``processed_root/<table>``) only the partitions of these days
    are replaced; a day without rows gets an empty one. A job that failed half way is repeated as it is.
    """

    def land(name: str) -> DataFrame:
        rows = read_csv(spark, [extract_path(raw_root, day, name) for day in days], EXTRACT[name])
        day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), rf"/(\d{{8}})-{name}\.csv", 1), "yyyyMMdd")
        return rows.select("*", day.alias("run_date"))

    extracts = {n: land(n) for n in EXTRACT}
    extracts["orders"] = _landed(spark, "orders", extracts["orders"])
    by = ["run_date"]
    staged = {name: stage(extracts[name], by=by) for name, stage in STAGE.items()}
    staged |= {"date": stage_date(extracts["orders"], by=by), "sales": _one_of_repeated(spark, extracts["orders"], by)}
    # A day has sales if it has a complete line: told by the stored lines, as a plan of joins may be found empty before it is observed.
    lines = {"sales": complete_lines(extracts["orders"]).select("run_date")}
    run_together([lambda n=n, df=df: _replace_days(df, f"{processed_root.rstrip('/')}/{n}", days, STAGING_ORDER[n], lines.get(n)) for n, df in staged.items()])


def _replace_days(rows: DataFrame, path: str, days: Sequence[dt.date], order: Sequence[str], dated: DataFrame | None = None) -> None:
    """Replace the partitions of the given days, also of those that have no rows. ``dated`` tells the days that have some; else the rows are observed."""
    seen = Observation()
    watched = rows if dated is not None else rows.observe(seen, F.collect_set("run_date").alias("days"))  # bounded: calendar days
    out = watched.hint("rebalance", "run_date").sortWithinPartitions("run_date", *order)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", STAGING_RECORDS_PER_FILE)
    writer = writer.option("compression", "zstd")
    writer.partitionBy("run_date").parquet(path)
    found = seen.get["days"] if dated is None else [r[0] for r in dated.distinct().collect()]  # bounded as well
    for day in sorted(set(days) - set(found)):
        write_parquet(rows.drop("run_date").limit(0), f"{path}/run_date={day}")


def read_staged_days(spark: SparkSession, processed_root: str, table: str, first: dt.date, last: dt.date) -> DataFrame:
    """A staging table of ``transform_days`` over a range of days, both ends included; other days' files are not read."""
    kinds = [T.StructField(f.name, f.dataType) for f in STAGING[table].fields]
    rows = spark.read.schema(T.StructType([*kinds, T.StructField("run_date", DATE)])).parquet(f"{processed_root.rstrip('/')}/{table}")
    return rows.filter(F.col("run_date").between(F.lit(first), F.lit(last)))


def _landed(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    path = scratch_path(spark, name)
    write_parquet(rows, path)
    return read_parquet(spark, path, rows.schema)


def _one_of_repeated(spark: SparkSession, orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The staged sales of stored extracts, in which only repeated lines are compared."""
    return stage_sales(orders, by=by, several=_landed(spark, "repeated-lines", repeated_lines(orders, by)))


def _without_misfits(spark: SparkSession, paths: Mapping[str, str], rejected: str) -> dict[str, DataFrame]:
    """The extracts without the lines that do not fit, which go to the table at ``rejected``. All text is parsed once."""

    def land(name: str) -> DataFrame:
        return _landed(spark, name, read_csv_checked(spark, paths[name], EXTRACT[name]))

    parts = {n: split_misfits(c) for n, c in zip(paths, run_together([lambda n=n: land(n) for n in paths]))}
    write_parquet(reduce(DataFrame.unionByName, [bad.select(F.lit(n).alias("extract"), "*") for n, (_, bad) in parts.items()]), rejected)
    return {n: good for n, (good, _) in parts.items()}


def main(arguments: list[str]) -> int:
    if len(arguments) not in (3, 4) or arguments[3:] not in ([], ["reject"]):
        logging.error("usage: transform RAW_ROOT YYYYMMDD PROCESSED_ROOT [reject]")
        return 1
    spark = build_session("starloom-transform")
    try:
        transform_day(spark, *arguments[:3], reject=len(arguments) == 4)
    except Exception:
        logging.exception("transform failed")
        return 1
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
