"""Catalog tables, and tables of an operational database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def create_tables(spark: SparkSession, database: str, schemas: Mapping[str, T.StructType]) -> None:
    """Create the database and its parquet tables where they do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in schemas.items():
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
        )
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def drop_tables(spark: SparkSession, database: str, names: Sequence[str]) -> None:
    """Drop the tables that exist."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def read_database_table(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], **properties: str
) -> DataFrame:
    """A table of a database, one Spark partition per predicate.

    The predicates must be disjoint and cover the table, e.g. one per month of ``updated_at``.
    Needs the database's JDBC driver on the class path.
    """
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))
