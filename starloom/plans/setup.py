"""First-time setup: the raw dataset as CSV becomes the operational tables, as CSV and parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.bootstrap import bootstrap_store
from ..schemas import OPERATIONAL, RAW
from ..sources.files import export_csv, import_csv, read_csv


def prepare_dataset(spark: SparkSession, dataset: str, prepared: str) -> None:
    """Read ``dataset/<table>.csv`` (nine tables), add audit columns and statuses, write ten CSV tables."""
    raw = {name: read_csv(spark, f"{dataset}/{name}.csv", schema) for name, schema in RAW.items()}
    export_csv(bootstrap_store(spark, raw), prepared)


def load_operational_tables(spark: SparkSession, prepared: str, target: str) -> dict[str, DataFrame]:
    """Load the prepared CSV tables into parquet under ``target``; returns the tables.

    Nothing is stamped on this way in, so the historical update days survive.
    """
    return import_csv(spark, prepared, OPERATIONAL, target)
