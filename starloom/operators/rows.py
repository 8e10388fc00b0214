"""Keyed row selection and key look-ups against large tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[Sequence] = ()) -> DataFrame:
    """A table of a few constant rows, or an empty one, whose size the optimizer knows."""
    one = spark.sql("SELECT 1")
    if not rows:
        return one.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).limit(0)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows
    ]
    return one.select(F.inline(F.array(*structs)))


def keep_one(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by ``prefer``, ties settled by all other columns (NULL first).

    The outcome does not depend on the order in which rows arrive. Spark limits each key to
    one row per task before the shuffle (WindowGroupLimit), so a key that holds most of the
    rows sends no more than one row per task.
    """
    ties = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*prefer, *ties)
    return df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def known_keys(large: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """The distinct keys of ``small`` that occur in ``large``.

    While ``small`` is small enough to broadcast, the optimizer moves the semi-join below the
    distinct, so ``large`` is scanned on one column and not shuffled. Otherwise ``large`` is
    reduced to distinct keys in each task first, and both sides shuffle on the key.
    """
    return large.select(key).distinct().join(small.select(key).distinct(), key, "left_semi")


def unseen(small: DataFrame, large: DataFrame, key: str) -> DataFrame:
    """The rows of ``small`` whose key does not occur in ``large``."""
    return small.join(known_keys(large, small, key), key, "left_anti")
