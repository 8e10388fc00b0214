"""Incremental extraction: rows of the operational tables changed inside a date window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import business_date
from ..schemas import EXTRACT, FIRST_WINDOW_START

Day = dt.date | str


def changed_between(table: DataFrame, previous: Day, current: Day, column: str = "updated_at") -> DataFrame:
    """Rows with ``previous < column <= current``; rows without a date are outside."""
    after, until = F.lit(str(previous)).cast("date"), F.lit(str(current)).cast("date")
    return table.filter((F.col(column) > after) & (F.col(column) <= until))


def extract_orders(tables: Mapping[str, DataFrame], previous: Day, current: Day) -> DataFrame:
    """Changed orders at line grain, with the status as text."""
    orders = changed_between(tables["orders"], previous, current)
    lines = orders.join(tables["order_status"], "order_status_id").join(tables["order_items"], "order_id")
    return lines.select(*EXTRACT["orders"].names)


def extract_products(tables: Mapping[str, DataFrame], previous: Day, current: Day) -> DataFrame:
    """Changed products with brand and category names."""
    products = changed_between(tables["products"], previous, current)
    named = products.join(tables["brands"], "brand_id").join(tables["categories"], "category_id")
    return named.select(*EXTRACT["products"].names)


def _extract(name: str):
    def extract(tables: Mapping[str, DataFrame], previous: Day, current: Day) -> DataFrame:
        return changed_between(tables[name], previous, current).select(*EXTRACT[name].names)

    extract.__doc__ = f"Changed {name}."
    return extract


extract_customers = _extract("customers")
extract_staffs = _extract("staffs")
extract_stores = _extract("stores")

EXTRACTIONS = {
    "orders": extract_orders,
    "products": extract_products,
    "customers": extract_customers,
    "staffs": extract_staffs,
    "stores": extract_stores,
}


def extraction_windows(runs: DataFrame, started: str, succeeded: str, first: str = FIRST_WINDOW_START) -> DataFrame:
    """The window of each business day with a run: from the last day that succeeded to the day itself.

    ``runs`` is reduced to one row per calendar day before the days are put in order.
    """
    return windows_of_days(runs.select(business_date(started).alias("current_date"), F.col(succeeded).alias("succeeded")), first)


def windows_of_days(runs: DataFrame, first: str = FIRST_WINDOW_START) -> DataFrame:
    """The same for runs whose business day (``current_date``) is known; ``succeeded`` is NULL for one still to come."""
    days = runs.groupBy("current_date").agg(F.count("*").alias("runs"), F.max(F.col("succeeded").cast("int")).alias("_ok"))
    # One row per calendar day: small enough for one task.
    earlier = Window.partitionBy(F.lit(0)).orderBy("current_date").rowsBetween(Window.unboundedPreceding, -1)
    last_ok = F.last(F.when(F.col("_ok") == 1, F.col("current_date")), ignorenulls=True).over(earlier)
    previous = F.coalesce(last_ok, F.lit(first).cast("date"))
    return days.select("current_date", previous.alias("previous_date"), "runs", F.coalesce(F.col("_ok") == 1, F.lit(False)).alias("succeeded"))
