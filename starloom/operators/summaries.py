"""Additive summaries of the fact by month of order, and the reports that need no more than them.

A summary has one row per month and version of a customer, product or store that sold in it, so it grows with the versions that sell, not
with the sales. A month's rows follow from the month's part of the fact alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DIMENSIONS, SERVING
from .reports import TOTAL, compared_months, counted_orders, delivered_orders, late_shares

#: The dimensions that reports ask for.
GRAINS = ("customers", "products", "stores")
MONTHS = "months"


def month_of_order() -> Column:
    """The month of a fact row, as ``yyyyMM``."""
    return F.substring("order_date", 1, 6)


def sales_summary(fact: DataFrame) -> DataFrame:
    """Revenue and units by month and surrogate key, for each dimension of GRAINS. One scan; sums are taken in part before the shuffle."""
    keys = {name: DIMENSIONS[name].key for name in GRAINS}
    rows = fact.select(month_of_order().alias("month"), *keys.values(), "total_price_with_discount", "quantity")
    grain = F.coalesce(*[F.when(F.grouping(key) == 0, F.lit(name)) for name, key in keys.items()])
    sums = rows.groupingSets([["month", key] for key in keys.values()], "month", *keys.values()).agg(
        F.sum("total_price_with_discount").cast(TOTAL).alias("revenue"),
        F.sum("quantity").cast("long").alias("units"),
        grain.alias("grain"),
    )
    return sums.withColumn("key", F.coalesce(*keys.values())).select(*SERVING["sales_summary"].names)


def order_summary(fact: DataFrame) -> DataFrame:
    """Orders, shipped and late ones by month and key of the store, and by month alone (no key).

    An order counts once for each month and each version of a store among its lines, and once for the month.
    """
    dated = fact.select(month_of_order().alias("month"), "store_key", "order_id", "shipped_date", "required_date")
    by_store = delivered_orders(dated, "month", "order_id", "store_key")
    by_month = by_store.groupBy("month", "order_id").agg(F.max("shipped").alias("shipped"), F.max("late").alias("late"))
    stores = counted_orders(by_store, "month", "store_key").withColumnRenamed("store_key", "key")
    months = counted_orders(by_month, "month").withColumn("key", F.lit(None).cast("long"))
    both = stores.withColumn("grain", F.lit("stores")).unionByName(months.withColumn("grain", F.lit(MONTHS)))
    return both.select(*SERVING["order_summary"].names)


def as_fact(sales: DataFrame, name: str, months: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``sales_summary`` for one dimension, under the fact's names.

    Reports that add up revenue and units by that dimension alone (``top_products``, ``brand_ranking``, ``unsold_products``,
    ``top_spenders``, ``store_performance``) give the same for it as for the fact. ``months`` restricts it to some months.
    """
    rows = sales.where(F.col("grain") == name)
    if months is not None:
        rows = rows.where(F.col("month").isin(list(months)))
    return rows.select(
        F.col("key").alias(DIMENSIONS[name].key),
        F.col("revenue").alias("total_price_with_discount"),
        F.col("units").alias("quantity"),
    )


def sales_monthly_trend(sales: DataFrame, orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """``reports.sales_monthly_trend`` from the summaries."""
    sums = sales.where(F.col("grain") == "stores").groupBy("month").agg(
        F.sum("revenue").cast(TOTAL).alias("revenue"), F.sum("units").cast("long").alias("units")
    )
    counts = orders.where(F.col("grain") == MONTHS).select("month", "orders")
    names = dim_date.select(F.substring("date_key", 1, 6).alias("yyyymm"), "year", F.col("month").alias("month_number"), "month_name").distinct()
    months = sums.join(counts, "month").join(names, F.col("month") == F.col("yyyymm"))
    return compared_months(months.select("year", F.col("month_number").alias("month"), "month_name", "revenue", "orders", "units"))


def late_delivery_by_store(orders: DataFrame, dim_stores: DataFrame) -> DataFrame:
    """``reports.late_delivery_by_store`` from the summary; an order has one month."""
    counts = orders.where(F.col("grain") == "stores").select(F.col("key").alias("store_key"), "orders", "shipped_orders", "late_orders")
    return late_shares(counts, dim_stores)
