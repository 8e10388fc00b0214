"""Row changes applied to operational tables in one set-based step.

``changes`` holds the key, ``op`` ('I' insert, 'U' update, 'D' delete), ``seq`` (their order)
and the non-audit columns. All changes of a key are folded by aggregation, so a key with very
many changes is reduced in each task before the shuffle. An insert of a key that exists, and an
update or delete of one that does not, has no effect.

Batches may be delivered twice or late. A register holds the last ``seq`` of every key that has had changes,
and a change that is not later than that has no effect (``apply_batch``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ACTIVE, INACTIVE
from .rows import known_keys, unseen

AUDIT_COLUMNS = ("created_at", "updated_at", "is_active")


def _fold(changes: DataFrame, key: str, payload: list[str], after: str | None = None) -> DataFrame:
    """One row per key: its first insert, last update and last delete. Inserts and updates count only if later than ``after``."""
    counts = F.lit(True) if after is None else F.col(after).isNull() | (F.col("seq") > F.col(after)) | (F.col("op") == "D")

    def of(op: str, value: Column) -> Column:
        return F.when((F.col("op") == op) & counts, value)

    row, seq = F.struct(*payload), F.col("seq")
    return changes.groupBy(key).agg(
        F.min(of("I", seq)).alias("i_seq"),
        F.min_by(of("I", row), of("I", seq)).alias("i"),
        F.max(of("U", seq)).alias("u_seq"),
        F.max_by(of("U", row), of("U", seq)).alias("u"),
        F.max(of("D", seq)).alias("d_seq"),
    )


def _payload(table: DataFrame, key: str) -> list[str]:
    return [c for c in table.columns if c != key and c not in AUDIT_COLUMNS]


def apply_changes(current: DataFrame, changes: DataFrame, key: str, run_date: dt.date | str) -> DataFrame:
    """Apply changes to a table with all three audit columns; a delete only marks the row inactive.

    Inserted rows are created, active and updated on ``run_date``; updated and deleted rows are
    updated on ``run_date``. An update does not make an inactive row active again.
    """
    today = F.lit(str(run_date)).cast("date")
    payload = _payload(current, key)
    folded = _fold(changes, key, payload)

    known, updated, deleted = F.col("_known").isNotNull(), F.col("u_seq").isNotNull(), F.col("d_seq").isNotNull()
    later = F.coalesce(F.col("u_seq") > F.col("i_seq"), F.lit(False))
    gone = F.coalesce(F.col("d_seq") > F.col("i_seq"), F.lit(False))
    met = current.withColumn("_known", F.lit(1)).join(folded, key, "full").filter(known | F.col("i_seq").isNotNull())
    return met.select(
        key,
        *[_after(c, known, updated, later) for c in payload],
        F.when(known, F.col("created_at")).otherwise(today).alias("created_at"),
        F.when(known & ~(updated | deleted), F.col("updated_at")).otherwise(today).alias("updated_at"),
        F.when(known, F.when(deleted, F.lit(INACTIVE)).otherwise(F.col("is_active")))
        .otherwise(F.when(gone, F.lit(INACTIVE)).otherwise(F.lit(ACTIVE)))
        .alias("is_active"),
    ).select(*current.columns)


def _after(column: str, known: Column, updated: Column, later: Column) -> Column:
    """A column after the changes: of the last update, the row as it was, or the first insert."""
    old = F.when(updated, F.col(f"u.{column}")).otherwise(F.col(column))
    new = F.when(later, F.col(f"u.{column}")).otherwise(F.col(f"i.{column}"))
    return F.when(known, old).otherwise(new).alias(column)


def later_changes(changes: DataFrame, register: DataFrame, key: str) -> DataFrame:
    """The changes later than what the register (``key``, ``last_seq``) holds of their key. Those without key or number are left out.

    Of the register only the keys in the batch are joined, so while the batch is small it is scanned and not shuffled.
    """
    numbered = changes.filter(F.col(key).isNotNull() & F.col("seq").isNotNull())
    held = register.join(known_keys(register, numbered, key), key, "left_semi")
    met = numbered.join(held.select(key, F.col("last_seq").alias("_held")), key, "left")
    return met.filter("_held IS NULL OR seq > _held").drop("_held")


def register_changes(register: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The register after a batch: one row for every key that has ever had a change, with or without effect."""
    numbered = changes.filter(F.col(key).isNotNull() & F.col("seq").isNotNull())
    newest = numbered.groupBy(key).agg(F.max("seq").alias("_newest"))
    known = register.join(newest, key, "left").select(key, F.greatest("last_seq", "_newest").alias("last_seq"))
    return known.unionByName(unseen(newest, register, key).select(key, F.col("_newest").alias("last_seq")))


def apply_batch(
    current: DataFrame, register: DataFrame, changes: DataFrame, key: str, run_date: dt.date | str
) -> tuple[DataFrame, DataFrame]:
    """Apply a batch that may be a repeated or a late one: table and register after it.

    Changes of a key that are not later than the last one delivered for it have no effect and stamp nothing, so a batch
    applied twice changes nothing. Repeats inside a batch count once.
    """
    return apply_changes(current, later_changes(changes, register, key), key, run_date), register_changes(register, changes, key)


def soft_delete(current: DataFrame, ids: DataFrame, key: str, run_date: dt.date | str) -> DataFrame:
    """Mark the rows with the given keys inactive, as of ``run_date``."""
    hit = F.col("_hit").isNotNull()
    marked = current.join(ids.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    return marked.withColumns(
        {
            "is_active": F.when(hit, F.lit(INACTIVE)).otherwise(F.col("is_active")),
            "updated_at": F.when(hit, F.lit(str(run_date)).cast("date")).otherwise(F.col("updated_at")),
        }
    ).select(*current.columns)


def apply_order_changes(orders: DataFrame, changes: DataFrame, run_date: dt.date | str, key: str = "order_id") -> DataFrame:
    """Apply changes to the orders: only ``updated_at`` is stamped, and a delete removes the row."""
    today = F.lit(str(run_date)).cast("date")
    payload = _payload(orders, key)
    # Only what follows the last delete of a key still matters, and the key starts out absent.
    deletes = changes.filter("op = 'D'").groupBy(key).agg(F.max("seq").alias("_last"))
    folded = _fold(changes.join(deletes, key, "left"), key, payload, after="_last")
    known = F.col("_known").isNotNull() & F.col("d_seq").isNull()
    updated = F.col("u_seq").isNotNull()
    later = F.coalesce(F.col("u_seq") > F.col("i_seq"), F.lit(False))
    met = orders.withColumn("_known", F.lit(1)).join(folded, key, "full").filter(known | F.col("i_seq").isNotNull())
    return met.select(
        key,
        *[_after(c, known, updated, later) for c in payload],
        F.when(known & ~updated, F.col("updated_at")).otherwise(today).alias("updated_at"),
    ).select(*orders.columns)
