"""First load: audit columns for the raw dataset, and the order status look-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import remap
from ..schemas import ACTIVE, DEFAULT_MANAGER, FIRST_AUDIT_DATE, OPERATIONAL, ORDER_STATUSES, RAW_STATUS_TO_STATUS
from .rows import keep_one, literal_rows


def _audited(df: DataFrame, created_on, table: str) -> DataFrame:
    audit = {"created_at": created_on, "updated_at": created_on, "is_active": F.lit(ACTIVE)}
    return df.withColumns(audit).select(*OPERATIONAL[table].names)


def bootstrap_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers, created on the day of their first order; those without an order are dropped."""
    first = orders.groupBy("customer_id").agg(F.min("order_date").alias("_first"))
    once = keep_one(customers, ["customer_id"])
    return _audited(once.join(first, "customer_id"), F.col("_first"), "customers")


def bootstrap_staffs(staffs: DataFrame) -> DataFrame:
    """Staffs, created on the fixed first day; a missing manager becomes the default manager."""
    manager = F.coalesce(F.col("manager_id"), F.lit(DEFAULT_MANAGER)).cast("int").cast("string")
    return _audited(staffs.drop("active").withColumn("manager_id", manager), _first_day(), "staffs")


def bootstrap_products(products: DataFrame) -> DataFrame:
    """Products, created on the fixed first day."""
    return _audited(products, _first_day(), "products")


def bootstrap_stores(stores: DataFrame) -> DataFrame:
    """Stores, created on the fixed first day."""
    return _audited(stores, _first_day(), "stores")


def _first_day():
    return F.lit(FIRST_AUDIT_DATE).cast("date")


def bootstrap_orders(orders: DataFrame) -> DataFrame:
    """Orders with the merged status and the day they reached it.

    Completed orders were last updated when shipped, rejected ones the day after they were
    due, pending ones when placed. A completed order without shipping date has no update day.
    """
    status = F.col("order_status_id")
    pending, rejected, completed = (s for s, _ in ORDER_STATUSES)
    updated = (
        F.when(status == completed, F.col("shipped_date"))
        .when(status == rejected, F.date_add("required_date", 1))
        .otherwise(F.col("order_date"))
    )
    renamed = orders.withColumnRenamed("order_status", "order_status_id")
    return (
        renamed.withColumn("order_status_id", remap("order_status_id", RAW_STATUS_TO_STATUS))
        .withColumn("updated_at", updated)
        .select(*OPERATIONAL["orders"].names)
    )


def order_status_lookup(spark: SparkSession) -> DataFrame:
    """The three order statuses."""
    return literal_rows(spark, OPERATIONAL["order_status"], ORDER_STATUSES)


def bootstrap_store(spark: SparkSession, raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All operational tables from the raw dataset."""
    items = raw["order_items"].withColumn("discount", F.coalesce("discount", F.lit(0).cast("decimal(4,2)")))
    return {
        "stores": bootstrap_stores(raw["stores"]),
        "staffs": bootstrap_staffs(raw["staffs"]),
        "categories": raw["categories"],
        "brands": raw["brands"],
        "products": bootstrap_products(raw["products"]),
        "customers": bootstrap_customers(raw["customers"], raw["orders"]),
        "order_status": order_status_lookup(spark),
        "orders": bootstrap_orders(raw["orders"]),
        "order_items": items,
        "stocks": raw["stocks"],
    }
