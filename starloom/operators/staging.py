"""Staging: cleaned, deduplicated rows at the grain the merge jobs expect.

Extracts of several days may be staged in one job: ``by`` names the columns that tell them apart. They are part of
every key and stay in the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import strip_quotes
from ..functions.dates import calendar_parts, date_key
from ..functions.measures import rejected_on, sales_measures
from ..schemas import STAGING, STAGING_KEYS, required_columns
from .rows import keep_one

# The order in which each staging table is presented and written.
STAGING_ORDER = {
    "customers": ["eff_date", "customer_id"],
    "stores": ["eff_date", "store_id"],
    "staffs": ["eff_date", "staff_id"],
    "products": ["eff_date", "product_id"],
    "date": ["date"],
    "sales": ["order_id", "product_id"],
}


def _stage_entity(extract: DataFrame, table: str, required: Sequence[str], by: Sequence[str]) -> DataFrame:
    versions = extract.withColumnsRenamed({"updated_at": "eff_date", "is_active": "active_flag"})
    return keep_one(versions.dropna(subset=list(required)), [*by, *STAGING_KEYS[table]]).select(*STAGING[table].names, *by)


def stage_customers(extract: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Customer versions; phone, email and street may be missing, nothing else."""
    return _stage_entity(extract, "customers", required_columns(STAGING["customers"]), by)


def stage_stores(extract: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Store versions without any missing value."""
    return _stage_entity(extract, "stores", STAGING["stores"].names, by)


def stage_staffs(extract: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Staff versions without any missing value, the manager included."""
    return _stage_entity(extract, "staffs", STAGING["staffs"].names, by)


def stage_products(extract: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Product versions without any missing value; quotes are removed from the name."""
    staged = _stage_entity(extract, "products", STAGING["products"].names, by)
    return staged.withColumn("product_name", strip_quotes("product_name"))


def stage_date(orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One calendar row for every date an order mentions, in one scan of the orders."""
    roles = F.array("order_date", "required_date", "shipped_date", "updated_at")
    dates = orders.select(F.explode(roles).alias("date"), *by).dropna().distinct()
    return dates.select(*calendar_parts("date"), *by)


def repeated_lines(orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The keys of lines of which ``stage_sales`` has to choose one. Only keys are shuffled; store the result, so that its size is known."""
    keys = [*by, *STAGING_KEYS["sales"]]
    return complete_lines(orders).groupBy(*keys).count().filter("count > 1").select(*keys)


def complete_lines(orders: DataFrame) -> DataFrame:
    """Order lines without a missing value; only the day of shipping may be missing."""
    return orders.dropna(subset=[c for c in orders.columns if c != "shipped_date"])


def stage_sales(orders: DataFrame, repeated: str = "first", by: Sequence[str] = (), several: DataFrame | None = None) -> DataFrame:
    """Order lines with measures and date keys, one row per order and product.

    ``repeated`` says what happens to further lines of the same product in one order:
    ``"first"`` keeps one of them, ``"sum"`` adds up their quantities and amounts. With ``several`` (the stored ``repeated_lines`` of the
    same orders) only lines of those keys are moved and compared: while the keys are few enough to broadcast, the others stay where they are.
    """
    lines = complete_lines(orders)
    keys = [*by, *STAGING_KEYS["sales"]]
    if repeated == "first" and several is not None:
        chosen = keep_one(lines.join(several, keys, "left_semi"), keys)
        lines = chosen.unionByName(lines.join(several, keys, "left_anti"))
    elif repeated == "first":
        lines = keep_one(lines, keys)
    elif repeated != "sum":
        raise ValueError(f"repeated must be 'first' or 'sum', not {repeated!r}")
    lines = lines.withColumns({"rejected_date": rejected_on(), **sales_measures()})
    if repeated == "sum":
        lines = _add_up(lines, by)
    dates = {c: date_key(c) for c in ("order_date", "required_date", "shipped_date", "rejected_date")}
    return lines.withColumns(dates).select(*STAGING["sales"].names, *by)


def _add_up(lines: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per order and product: summed amounts, and the percentage that they come to, rounded.

    An extract holds one state of each order, so the order's columns are part of the grouping and only numbers are aggregated.
    """
    added = ["quantity", "discount_amount", "total_price", "total_price_with_discount"]
    kinds = {f.name: f.dataType for f in STAGING["sales"].fields}
    of_order = ["customer_id", "store_id", "staff_id", "order_date", "required_date", "shipped_date", "rejected_date", "order_status"]
    totals = lines.groupBy(*by, *STAGING_KEYS["sales"], *of_order).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in added])
    # In cents, so that the division is one of whole numbers.
    cents = "CAST(total_price * 100 AS BIGINT)"
    percent = F.expr(f"CAST(CASE WHEN {cents} = 0 THEN 0 ELSE (CAST(discount_amount * 100 AS BIGINT) * 200 + {cents}) DIV (2 * {cents}) END AS INT)")
    return totals.withColumn("discount_percent", percent)


STAGE = {
    "customers": stage_customers,
    "stores": stage_stores,
    "staffs": stage_staffs,
    "products": stage_products,
}
