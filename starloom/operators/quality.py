"""Integrity checks and the follow-up of parent keys, for constraints parquet does not enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return table.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values without a parent row, with their number of rows.

    The child is reduced to one row per value first, so a hot value costs one row per task.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count("*").alias("rows"))
    return used.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


def column_violations(
    table: DataFrame, required: Sequence[str] = (), lengths: Mapping[str, int] | None = None
) -> DataFrame:
    """Violations per column and rule ('not null', 'length'), counted in one scan of the table."""
    rules = [(c, "not null", F.col(c).isNull()) for c in required]
    rules += [(c, "length", F.length(c) > limit) for c, limit in (lengths or {}).items()]
    counts = table.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(rules)])
    found = [
        F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"_{i}").alias("violations"))
        for i, (c, rule, _) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*found)))


def retain_children(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose parent still exists, or that name none: the effect of a cascading delete."""
    there = child.join(parent.select(F.col(parent_column).alias(column)), column, "left_semi").select(*child.columns)
    return there.unionByName(child.filter(F.col(column).isNull()))


def rekey_children(child: DataFrame, column: str, renamed: DataFrame) -> DataFrame:
    """Child rows following a parent whose key changed; ``renamed`` holds ``old_key`` and ``new_key``."""
    new = renamed.select(F.col("old_key").alias(column), F.col("new_key").alias("_new"))
    moved = child.join(new, column, "left")
    return moved.withColumn(column, F.coalesce("_new", column)).select(*child.columns)


def renames_to_refuse(keys: DataFrame, key: str, renames: DataFrame, kept: Sequence[DataFrame]) -> DataFrame:
    """The renames (old_key, new_key) of a table that cannot be, each with its first reason.

    ``keys`` is the table, ``kept`` holds, as column ``key``, the keys used by references that do not follow. All renames happen at once and are judged
    on the state before: a key cannot be given away to one that is there, even if that one is renamed as well.
    """
    there = keys.select(F.col(key).alias("_key")).distinct()
    counted = renames.groupBy("old_key", "new_key").agg(F.count(F.lit(1)).alias("_n"))
    again = lambda c: renames.groupBy(F.col(c).alias("_key")).agg(F.count(F.lit(1)).alias("_times"))
    found = counted.join(there.withColumnRenamed("_key", "old_key").withColumn("_known", F.lit(True)), "old_key", "left")
    found = found.join(there.withColumnRenamed("_key", "new_key").withColumn("_taken", F.lit(True)), "new_key", "left")
    for c, name in (("old_key", "_olds"), ("new_key", "_news")):
        found = found.join(again(c).toDF(c, name), c, "left")
    used = F.lit(False)
    for i, references in enumerate(kept):
        found = found.join(references.select(F.col("key").alias("old_key")).distinct().withColumn(f"_used{i}", F.lit(True)), "old_key", "left")
        used = used | F.col(f"_used{i}").isNotNull()
    reason = (
        F.when(F.col("old_key").isNull() | F.col("new_key").isNull(), "no key")
        .when(F.col("_known").isNull(), "not there")
        .when((F.col("_olds") > 1) | (F.col("_news") > 1), "repeated")
        .when(F.col("_taken").isNotNull(), "taken")
        .when(used, "referenced")
    )
    return found.select("old_key", "new_key", reason.alias("reason")).where("reason IS NOT NULL")


def rekey_columns(table: DataFrame, renames: Mapping[str, DataFrame]) -> DataFrame:
    """The table with each named column following its renames (old_key, new_key, at most one of each old key)."""
    out = table
    for i, (column, renamed) in enumerate(renames.items()):
        kind = table.schema[column].dataType
        new = renamed.select(F.col("old_key").cast(kind).alias(column), F.col("new_key").cast(kind).alias(f"_new{i}"))
        out = out.join(new, column, "left").withColumn(column, F.coalesce(f"_new{i}", column))
    return out.select(*table.columns)
