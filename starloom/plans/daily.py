"""The daily job: extract, stage, merge dimensions, load the fact, publish."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.bootstrap import order_status_lookup
from ..operators.extract import EXTRACTIONS
from ..operators.fact import (
    FACT_IDENTITY,
    compared_orders,
    keyed_sales,
    lacks_version,
    new_fact_rows,
    offered_lines,
    orders_of,
    rejected_rows,
    settle_early,
    update_fact,
    update_orders,
    waiting_rows,
)
from ..operators.keys import assign_keys
from ..operators.scd2 import append_dates, scd2_rewrite
from ..operators.staging import STAGE, STAGING_ORDER, repeated_lines, stage_date, stage_sales
from ..schemas import ACTIVE, DIMENSION_PARTITIONS, DIMENSIONS, KEY_DIGITS, Dimension
from ..session import run_together
from ..sources.warehouse import Run, Warehouse
from . import checks

HISTORY_SEGMENT = "history"


def extract_all(run: Run, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The five extracts of the run's window, written to its staging area."""

    def job(name: str) -> Callable[[], DataFrame]:
        # Lines of an order side by side take two thirds of the bytes; a sort of what a task writes costs less than it saves.
        sort = ["order_id"] if name == "orders" else []
        return lambda: run.stage(f"extract_{name}", EXTRACTIONS[name](tables, run.previous, run.current), sort=sort)

    return dict(zip(EXTRACTIONS, run_together([job(n) for n in EXTRACTIONS])))


def stage_all(run: Run, extracts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The six staging tables, written to the run's staging area."""
    plans = {name: (lambda n=name, stage=stage: stage(extracts[n])) for name, stage in STAGE.items()}
    plans["date"] = lambda: stage_date(extracts["orders"])
    plans["sales"] = lambda: one_of_repeated(run, extracts["orders"])

    def job(name: str) -> Callable[[], DataFrame]:
        return lambda: run.stage(f"stg_{name}", plans[name](), sort=STAGING_ORDER[name])

    return dict(zip(plans, run_together([job(n) for n in plans])))


def one_of_repeated(run: Run, orders: DataFrame) -> DataFrame:
    """The staged sales, in which only repeated lines are shuffled."""
    return stage_sales(orders, several=run.stage("repeated_lines", repeated_lines(orders)))


def load_dimension(run: Run, staged: DataFrame, dim: Dimension) -> None:
    """Merge one staged dimension. Of the dimension only the partitions of ids in the batch are read and written.

    A dimension is split into the newest version of each id, open or not, by a hash of the id, and the history of versions that were replaced,
    which is only added to. The newest versions tell all that a merge needs to know, so history is not read. Only the versions that this
    batch opens are stored for numbering; the others go straight to the published table.
    """
    touched = [r[0] for r in staged.select(newest_segment(dim)).distinct().collect()]  # bounded: one row per partition
    if not touched:
        return
    newest = run.read(dim.table, touched)
    rewritten = scd2_rewrite(newest, staged, dim)
    opened = run.stage(f"opened_{dim.name}", rewritten.filter(F.col(dim.key).isNull()))
    numbered = assign_keys(opened, dim.key, [dim.id, "eff_date"], run.top_key(dim.table), KEY_DIGITS[dim.table])
    closed = newest.filter(F.col("active_flag") != ACTIVE).select(*dim.schema.names)
    standing = rewritten.filter(F.col(dim.key).isNotNull()).unionByName(closed)
    replaced = standing.join(opened.select(dim.id).distinct().withColumn("_replaced", F.lit(True)), dim.id, "left")
    segment = F.when(F.col("_replaced").isNull(), newest_segment(dim)).otherwise(HISTORY_SEGMENT)
    rows = replaced.unionByName(numbered.withColumn("_replaced", F.lit(None).cast("boolean")))
    run.publish(dim.table, rows, segment, replaces=touched, key=dim.key)


def newest_segment(dim: Dimension) -> Column:
    """The partition that holds the newest version of an id."""
    return F.concat(F.lit("newest-"), F.pmod(F.xxhash64(dim.id), F.lit(DIMENSION_PARTITIONS[dim.table])).cast("string"))


def load_dates(run: Run, staged: DataFrame) -> None:
    run.publish("dim_date", append_dates(run.read("dim_date"), staged), F.lit("all"))


def load_statuses(run: Run) -> None:
    """Add the order statuses the warehouse lacks; nothing on a second run."""
    current = run.read("dim_order_status")
    lacking = order_status_lookup(run.spark).join(current, "order_status_id", "left_anti")
    run.publish("dim_order_status", lacking, F.lit("all"))


def known_orders(run: Run, staged: DataFrame, table: str = "fact_orders") -> DataFrame:
    """What the fact (or another table of orders by month) holds of the staged orders: whole months, those that the staged dates name and few others.

    An order that is not in the month of its staged date is new, unless its order date was changed after it came into the fact. To tell,
    the ids of such orders alone meet the id column of the other months; months with a hit are read as well.
    """
    if not run.segments(table):
        return run.read(table)
    orders = staged.select("order_id", F.substring("order_date", 1, 6).alias("month"))
    named = {r[0] for r in orders.select("month").distinct().collect()}  # bounded: one row per calendar month
    others = [m for m in run.segments(table) if m not in named]
    known = run.read(table, sorted(named))
    if not others:
        return known
    lacking = run.stage(f"lacking_in_{table}", orders.join(known, "order_id", "left_anti").select("order_id").distinct())
    moved = run.read(table, others).join(lacking, "order_id", "left_semi").select(F.substring("order_date", 1, 6)).distinct()
    hits = [r[0] for r in moved.collect()]  # bounded as well
    return known.unionByName(run.read(table, hits)) if hits else known


def load_fact(run: Run, staged: DataFrame, wait: bool = False) -> None:
    """Insert new orders, update moved ones. Of the fact only months with a moved order are read and rewritten.

    Rows without a valid version in every dimension go to the run's ``rejected_sales``. With ``wait``, those that name an id
    without any version are kept in ``pending_sales`` and offered again by each later run, and a line older than the first
    version of an id takes that version. Entering the fact and leaving ``pending_sales`` become visible together, by the run's entry in
    the log, so a line enters once whatever fails between.
    """
    statuses = run.read("dim_order_status")
    dims = {name: run.read(dim.table) for name, dim in DIMENSIONS.items()}
    month = F.substring("order_date", 1, 6)

    offered = run.stage("offered_sales", offered_lines(run.read("pending_sales"), staged)) if wait else None
    known = known_orders(run, staged.unionByName(offered) if wait else staged)
    # The fact holds few of the orders of a daily batch. In a table of their own their size is known, so they are broadcast, and neither the
    # staged lines nor the fact are shuffled to meet them.
    held = run.stage("held_orders", compared_orders(staged, known, statuses).where("known_date IS NOT NULL"))
    moved = held.where("moved").select(F.substring("known_date", 1, 6).alias("month")).distinct()
    months = [row["month"] for row in moved.collect()]  # bounded: one row per calendar month

    keyed = run.stage("keyed_sales", keyed_sales(staged, held, dims, statuses, offered))
    if wait:
        # Lines with a version in every dimension have nothing to settle: they are neither joined nor written once more.
        settled = run.stage("settled_sales", settle_early(keyed.filter(lacks_version()), dims))
        keyed = keyed.filter(~lacks_version()).withColumn("unknown", F.lit("")).unionByName(settled)
        run.publish("pending_sales", waiting_rows(keyed), F.lit("all"), replaces=["all"])
    new = new_fact_rows(keyed)
    numbered = assign_keys(new, "sales_id", FACT_IDENTITY, run.top_key("fact_sales"), KEY_DIGITS["fact_sales"])
    # Of an order that is in the fact already, a line may have waited.
    entered = orders_of(new).join(known, "order_id", "left_anti") if wait else orders_of(new)
    orders = update_orders(run.read("fact_orders", months), held).unionByName(entered)
    run_together(
        [
            lambda: run.stage("rejected_sales", rejected_rows(keyed)),
            # Old rows are read by month and new ones lie evenly in their buckets, so neither is moved to be written by month.
            lambda: run.publish(
                "fact_sales", update_fact(run.read("fact_sales", months), held).unionByName(numbered), month, months, "sales_id", moved=False
            ),
            lambda: run.publish("fact_orders", orders, month, months),
        ]
    )


def run_batch(warehouse: Warehouse, tables: Mapping[str, DataFrame], run_date: dt.date, wait: bool = False) -> Run:
    """One daily run over the window since the last finished run.

    The staging tables are checked before anything is published: repeated keys, missing values and texts that are too
    long end the run, with no trace but its staging area. All that it found is stored as ``quality``.
    ``wait`` keeps sales that name an unknown id for later runs (see ``load_fact``); without it they are only listed.
    """
    run = warehouse.begin(*warehouse.next_window(run_date))
    staged = stage_all(run, extract_all(run, tables))
    check_staging(run, staged, tables)
    dims: list[Callable[[], object]] = [
        lambda dim=dim: load_dimension(run, staged[dim.name], dim) for dim in DIMENSIONS.values()
    ]
    run_together([*dims, lambda: load_dates(run, staged["date"]), lambda: load_statuses(run)])
    load_fact(run, staged["sales"], wait)
    run.commit()
    run.clear_all(keep=["rejected_sales", "quality"])
    return run


def check_staging(run: Run, staged: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]) -> None:
    """Store what the integrity checks find; fail on a rule that the warehouse declares."""
    found = run.stage("quality", checks.run_findings(staged, tables))
    broken = found.where("strict AND violations > 0").limit(20).collect()
    if broken:
        listed = ", ".join(f"{r.table_name}.{r.column_name}: {r.violations} x {r.rule}" for r in broken)
        raise ValueError(f"the staging tables break rules of the warehouse: {listed}")
