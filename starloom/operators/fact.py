"""The sales fact: insert of new orders, status update of known ones, rows left out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import key_to_date
from ..schemas import DIMENSIONS, SERVING, STAGING
from .rows import keep_one
from .versions import version_on

FACT_COLUMNS = SERVING["fact_sales"].names
FACT_IDENTITY = ["order_id", "product_key"]
LINE = ["order_id", "product_id"]
ORDER_COLUMNS = SERVING["fact_orders"].names

KEYS = [*(dim.key for dim in DIMENSIONS.values()), "order_status_id"]


def compared_orders(staged: DataFrame, known: DataFrame, statuses: DataFrame) -> DataFrame:
    """The state of each staged order next to what the fact holds of it: one row per order, one join.

    ``known`` has a narrow row per order in the fact (``fact_orders``). ``known_date`` is NULL for an order the fact does not
    hold; ``moved`` says that its shipping or rejection date differs. What follows needs only orders that the fact holds: store those alone.
    """
    held = known.select("order_id", F.col("order_date").alias("known_date"), F.col("shipped_date").alias("_s"), F.col("rejected_date").alias("_r"))
    same = F.col("shipped_date").eqNullSafe(F.col("_s")) & F.col("rejected_date").eqNullSafe(F.col("_r"))
    met = order_updates(staged, statuses).join(held, "order_id", "left")
    return met.withColumn("moved", F.col("known_date").isNotNull() & F.col("order_status_id").isNotNull() & ~same).drop("_s", "_r")


def keyed_sales(
    staged: DataFrame, compared: DataFrame, dims: Mapping[str, DataFrame], statuses: DataFrame, offered: DataFrame | None = None
) -> DataFrame:
    """Staged rows of orders the fact does not hold yet, with every key; NULL where none is valid.

    ``offered`` lines have waited in earlier runs (see ``offered_lines``). They take part whatever the fact holds of their
    orders, as they have never been in it, and instead of staged rows of the same line.
    """
    held = compared.where("known_date IS NOT NULL").select("order_id")
    rows = staged.join(held, "order_id", "left_anti")
    if offered is not None:
        rows = rows.join(offered, LINE, "left_anti").unionByName(offered)
    rows = rows.withColumn("_ordered_on", key_to_date("order_date"))
    for name, dim in DIMENSIONS.items():
        rows = version_on(rows, dims[name], dim, "_ordered_on", "left")
    return rows.drop("_ordered_on").join(statuses, "order_status", "left")


def offered_lines(pending: DataFrame, staged: DataFrame) -> DataFrame:
    """The lines that wait for a version, as the batch has them where it has them again.

    The batch is first reduced to those, by the ids of the lines that wait: while these are few, the batch is not shuffled.
    """
    row = F.struct(*STAGING["sales"].names)
    again = staged.join(pending.select(*LINE), LINE, "left_semi")
    met = pending.select(*LINE, row.alias("_old")).join(again.select(*LINE, row.alias("_new")), LINE, "left")
    return met.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")


def settle_early(keyed: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Lines older than the first version of an id take that version: it is the earliest known state of an id that came late.

    ``unknown`` lists the keys whose id has no version at all. A line in a gap between or after versions stays without a key,
    but is not unknown. Only ids without a valid version are looked up, so while those are few no dimension is shuffled.
    """
    rows, unknown = keyed.withColumn("_ordered_on", key_to_date("order_date")), []
    for name, dim in DIMENSIONS.items():
        lacking = keyed.filter(F.col(dim.key).isNull()).select(dim.id).distinct()
        firsts = dims[name].join(lacking, dim.id, "left_semi").groupBy(dim.id).agg(
            F.min("eff_date").alias(f"_{name}_from"), F.min_by(dim.key, F.struct("eff_date", dim.key)).alias("_first")
        )
        early = F.col(dim.key).isNull() & (F.col("_ordered_on") < F.col(f"_{name}_from"))
        rows = rows.join(firsts, dim.id, "left").withColumn(dim.key, F.when(early, F.col("_first")).otherwise(F.col(dim.key))).drop("_first")
        unknown.append(F.when(F.col(dim.key).isNull() & F.col(f"_{name}_from").isNull(), F.lit(dim.key)))
    return rows.select(*keyed.columns, _listed(unknown).alias("unknown"))


def lacks_version() -> Column:
    """Whether a keyed line found no valid version in some dimension: all that ``settle_early`` may change."""
    return _lacks([dim.key for dim in DIMENSIONS.values()])


def waiting_rows(settled: DataFrame) -> DataFrame:
    """Lines that lack nothing but versions of unknown ids: a later run may find them."""
    return settled.filter(_lacks(KEYS)).filter(_missing() == F.col("unknown")).select(*STAGING["sales"].names)


def new_fact_rows(keyed: DataFrame) -> DataFrame:
    """Fact rows, still without ``sales_id``. A row that lacks a key is left out.

    An order that is in the fact already gets no further lines (see ``keyed_sales``).
    """
    complete = keyed.dropna(subset=KEYS)
    return complete.withColumn("sales_id", F.lit(None).cast("long")).select(*FACT_COLUMNS)


def rejected_rows(keyed: DataFrame) -> DataFrame:
    """Rows that find no place in the fact, and the look-ups that failed."""
    return keyed.filter(_lacks(KEYS)).select(*STAGING["sales"].names, _missing().alias("missing"))


def _lacks(keys: Sequence[str]) -> Column:
    """Whether a line lacks one of the keys: a test that is cheap on every line, before the keys are listed for those that do."""
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def _missing() -> Column:
    """The keys a line lacks, in the order of ``KEYS``."""
    return _listed([F.when(F.col(k).isNull(), F.lit(k)) for k in KEYS])


def _listed(names: Sequence[Column]) -> Column:
    return F.array_join(F.array_compact(F.array(*names)), ",")


def order_updates(staged: DataFrame, statuses: DataFrame) -> DataFrame:
    """The state of each staged order, one row per order. All lines of an order agree on it."""
    state = staged.select("order_id", "shipped_date", "rejected_date", "order_status")
    return keep_one(state, ["order_id"]).join(statuses, "order_status", "left").drop("order_status")


def update_fact(fact: DataFrame, compared: DataFrame) -> DataFrame:
    """Take over shipping, rejection and status of the orders whose shipping or rejection date has moved."""
    state = ["shipped_date", "rejected_date", "order_status_id"]
    new = compared.where("moved").select("order_id", F.struct(*state).alias("new"))
    joined = fact.join(new, "order_id", "left")
    moved = F.col("new").isNotNull()
    return joined.select(
        *[F.when(moved, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) if c in state else F.col(c) for c in fact.columns]
    )


def update_orders(known: DataFrame, compared: DataFrame) -> DataFrame:
    """The same for the narrow rows of the orders."""
    new = compared.where("moved").select("order_id", F.struct("shipped_date", "rejected_date").alias("new"))
    dates = [F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in ("shipped_date", "rejected_date")]
    return known.join(new, "order_id", "left").select("order_id", "order_date", *dates)


def orders_of(rows: DataFrame) -> DataFrame:
    """The narrow row of each order in some fact rows."""
    return keep_one(rows.select(*ORDER_COLUMNS), ["order_id"])
