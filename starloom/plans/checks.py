"""Integrity checks over a whole set of tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import column_violations, duplicate_keys, rekey_columns, renames_to_refuse, retain_children
from ..operators.rows import literal_rows
from ..schemas import (
    FOREIGN_KEYS,
    OPERATIONAL,
    OPERATIONAL_LENGTHS,
    PRIMARY_KEYS,
    STAGING,
    STAGING_KEYS,
    UNIQUE_COLUMNS,
    required_columns,
    warehouse_lengths,
)

REFERENCES_SCHEMA = T.StructType(
    [T.StructField("reference", T.IntegerType()), *[T.StructField(n, T.StringType()) for n in ("child", "child_column", "parent")]]
)

# Parents before their children.
TABLE_ORDER = ("stores", "staffs", "categories", "brands", "products", "customers", "order_status", "orders", "order_items", "stocks")


def check_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per primary key and unique column of the operational tables: how many values repeat, in how many rows."""
    unique = [(t, [c]) for t, columns in UNIQUE_COLUMNS.items() for c in columns]
    return _repeated(tables, [*PRIMARY_KEYS.items(), *unique])


def check_staging_keys(staged: Mapping[str, DataFrame]) -> DataFrame:
    """The same for the keys of the staging tables."""
    return _repeated(staged, list(STAGING_KEYS.items()))


def _repeated(tables: Mapping[str, DataFrame], keys: list[tuple[str, list[str]]]) -> DataFrame:
    def check(table: str, columns: list[str]) -> DataFrame:
        found = duplicate_keys(tables[table], columns)
        totals = found.agg(F.count("*").alias("repeated"), F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"))
        return totals.select(
            F.lit(table).alias("table_name"), F.lit(",".join(columns)).alias("key"), "repeated", "rows"
        )

    return reduce(DataFrame.unionByName, [check(t, k) for t, k in keys if t in tables])


def check_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per foreign key: how many values have no parent, and in how many rows.

    Each child is scanned once for all its references and reduced to one row per reference and value before the shuffle, so a hot
    value costs one row per task; the values of all references meet the keys of all parents in one join.
    """
    checked = [(i, *key[:4]) for i, key in enumerate(FOREIGN_KEYS) if key[0] in tables and key[2] in tables]

    def used(child: str) -> DataFrame:
        values = [
            F.struct(F.lit(i).alias("reference"), F.lit(f"{parent}.{parent_column}").alias("parent"), F.col(column).cast("string").alias("key"))
            for i, table, column, parent, parent_column in checked
            if table == child
        ]
        return tables[child].select(F.inline(F.array(*values))).filter(F.col("key").isNotNull())

    def keys(parent: str, column: str) -> DataFrame:
        return tables[parent].select(F.lit(f"{parent}.{column}").alias("parent"), F.col(column).cast("string").alias("key"))

    children, parents = sorted({c[1] for c in checked}), sorted({(c[3], c[4]) for c in checked})
    values = reduce(DataFrame.unionByName, [used(c) for c in children]).groupBy("reference", "parent", "key").agg(F.count("*").alias("rows"))
    orphans = values.join(reduce(DataFrame.unionByName, [keys(*p) for p in parents]), ["parent", "key"], "left_anti")
    totals = orphans.groupBy("reference").agg(F.count("*").alias("orphans"), F.sum("rows").alias("rows"))
    listed = literal_rows(
        next(iter(tables.values())).sparkSession, REFERENCES_SCHEMA, [(i, child, column, parent) for i, child, column, parent, _ in checked]
    )
    met = listed.join(totals, "reference", "left")
    return met.select("child", "child_column", "parent", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("orphans", "rows")])


def follow_deletes(tables: Mapping[str, DataFrame], left: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All tables after some parents are gone: ``left`` holds what remains of those. Children follow where FOREIGN_KEYS says so,
    parents first, so that a delete runs through all levels."""
    out: dict[str, DataFrame] = {}
    for name in TABLE_ORDER:
        kept = left.get(name, tables[name])
        for child, column, parent, parent_column, rule in FOREIGN_KEYS:
            if child == name and rule == "cascade":
                kept = retain_children(kept, column, out[parent], parent_column)
        out[name] = kept
    return out


def refused_renames(tables: Mapping[str, DataFrame], renames: Mapping[str, DataFrame]) -> DataFrame:
    """The renames of keys (by table: old_key, new_key) that are not carried out: table_name, old_key, new_key, reason.

    Reasons, the first that applies: "no key" (a NULL), "not there", "repeated" (the old or the new key occurs in several renames), "taken" (the
    new key is there already), "referenced" (a reference that does not follow uses the old key; FOREIGN_KEYS rule "keep").
    """

    def of(table: str) -> DataFrame:
        key = PRIMARY_KEYS[table][0]
        kept = [tables[child].select(F.col(column).alias("key")) for child, column, parent, _, rule in FOREIGN_KEYS if parent == table and rule == "keep" and child in tables]
        found = renames_to_refuse(tables[table], key, renames[table].select("old_key", "new_key"), kept)
        return found.select(F.lit(table).alias("table_name"), F.col("old_key").cast("string").alias("old_key"), F.col("new_key").cast("string").alias("new_key"), "reason")

    return reduce(DataFrame.unionByName, [of(t) for t in renames])


def follow_renames(tables: Mapping[str, DataFrame], renames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All tables after keys of some tables were renamed (by table: old_key, new_key), all at once.

    A key and every reference to it that FOREIGN_KEYS lets follow change together, each table in one pass over its columns: a product of a renamed
    brand, its order lines, stocks, and a line of a renamed order of a renamed store. Refused renames (see ``refused_renames``) change nothing.
    """
    refused = refused_renames(tables, renames)
    done = {}
    for table, wanted in renames.items():
        key = tables[table].schema[PRIMARY_KEYS[table][0]].dataType
        bad = refused.where(F.col("table_name") == table).select(F.col("old_key").cast(key).alias("old_key"), F.col("new_key").cast(key).alias("new_key"))
        same = wanted["old_key"].eqNullSafe(bad["old_key"]) & wanted["new_key"].eqNullSafe(bad["new_key"])
        done[table] = wanted.join(bad, same, "left_anti").select("old_key", "new_key")
    out = {}
    for name, table in tables.items():
        columns = {PRIMARY_KEYS[name][0]: done[name]} if name in done and len(PRIMARY_KEYS[name]) == 1 else {}
        columns |= {column: done[parent] for child, column, parent, _, rule in FOREIGN_KEYS if child == name and parent in done and rule != "keep"}
        out[name] = rekey_columns(table, columns) if columns else table
    return out


def check_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per operational column: rows that break NOT NULL or the length limit."""
    return _violations(tables, OPERATIONAL, OPERATIONAL_LENGTHS)


def check_staging_columns(staged: Mapping[str, DataFrame]) -> DataFrame:
    """Per staging column: the same against the warehouse's limits, which are narrower in places."""
    return _violations(staged, STAGING, {n: warehouse_lengths(s) for n, s in STAGING.items()})


def _violations(tables: Mapping[str, DataFrame], schemas: Mapping, lengths: Mapping) -> DataFrame:
    def check(table: str) -> DataFrame:
        found = column_violations(tables[table], required_columns(schemas[table]), lengths.get(table))
        return found.withColumn("table_name", F.lit(table))

    return reduce(DataFrame.unionByName, [check(t) for t in schemas if t in tables])


def never_extracted(orders: DataFrame) -> DataFrame:
    """Orders without ``updated_at``, which no window ever reaches: how many, by status."""
    return orders.filter(F.col("updated_at").isNull()).groupBy("order_status_id").agg(F.count("*").alias("orders"))


def run_findings(staged: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]) -> DataFrame:
    """What a daily run checks, in one table. ``strict`` rules are those the warehouse declares; the others are only recorded."""
    keys = check_staging_keys(staged).select("table_name", F.col("key").alias("column_name"), F.lit("unique").alias("rule"), F.col("repeated").alias("violations"))
    columns = check_staging_columns(staged).select("table_name", "column_name", "rule", "violations")
    # The store gives texts longer than the warehouse's narrowest columns; Spark tables keep them whole.
    strict = keys.unionByName(columns.filter("rule <> 'length'")).withColumn("strict", F.lit(True))
    lost = never_extracted(tables["orders"]).agg(F.coalesce(F.sum("orders"), F.lit(0)).cast("long").alias("violations"))
    lost = lost.select(F.lit("orders").alias("table_name"), F.lit("updated_at").alias("column_name"), F.lit("never extracted").alias("rule"), "violations")
    noted = columns.filter("rule = 'length'").unionByName(lost)
    return strict.unionByName(noted.withColumn("strict", F.lit(False)))
