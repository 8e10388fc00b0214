"""Sales, product, customer, store and delivery reports over the star schema.

The fact is aggregated by surrogate key before it meets a dimension, so what is joined is the
number of versions, not the number of sales. Versions of one natural id count as one entity and
show the attributes of the latest version. All sales count, whatever their status; to leave out
e.g. rejected orders pass a filtered fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ACTIVE, DIMENSIONS, Dimension

TOTAL = "decimal(38,2)"


def _revenue(column: str = "total_price_with_discount") -> Column:
    return F.sum(column).cast(TOTAL).alias("revenue")


def _units(column: str = "quantity") -> Column:
    return F.sum(column).cast("long").alias("units")


def _latest(dim: Dimension, versions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per natural id, with the given attributes of its latest version."""
    newest = F.struct("eff_date", "exp_date", dim.key)
    picked = versions.groupBy(dim.id).agg(F.max_by(F.struct(*columns), newest).alias("v"))
    return picked.select(dim.id, *[f"v.{c}" for c in columns])


def _by_id(fact: DataFrame, versions: DataFrame, dim: Dimension) -> DataFrame:
    """Revenue and units per natural id."""
    per_version = fact.groupBy(dim.key).agg(_revenue(), _units())
    joined = per_version.join(versions.select(dim.key, dim.id), dim.key)
    return joined.groupBy(dim.id).agg(_revenue("revenue"), _units("units"))


def _rank(by: str) -> Column:
    """Rank over a report of one row per brand, store or month: a handful of rows."""
    return F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(by)))


def sales_monthly_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue, orders and units per month of order, and the change of revenue to the month before."""
    dates = dim_date.select(F.col("date_key").alias("order_date"), "year", "month", "month_name")
    months = (
        fact.join(dates, "order_date")
        .groupBy("year", "month", "month_name")
        .agg(_revenue(), F.countDistinct("order_id").alias("orders"), _units())
    )
    return compared_months(months)


def compared_months(months: DataFrame) -> DataFrame:
    """Months with their revenue's change to the month before, and its rank."""
    in_order = Window.partitionBy(F.lit(0)).orderBy("year", "month")
    change = F.col("revenue") - F.lag("revenue").over(in_order)
    return months.withColumns(
        {"revenue_change": change.cast(TOTAL), "revenue_rank": _rank("revenue")}
    )


def delivered_orders(fact: DataFrame, *by: str | Column) -> DataFrame:
    """What became of each order, by the columns given: ``shipped`` and ``late``, 1 or 0."""
    late = F.col("shipped_date") > F.col("required_date")
    return fact.groupBy(*by).agg(
        F.max(F.col("shipped_date").isNotNull().cast("int")).alias("shipped"),
        F.max(F.coalesce(late, F.lit(False)).cast("int")).alias("late"),
    )


def counted_orders(orders: DataFrame, *by: str) -> DataFrame:
    """Orders, shipped and late ones of ``delivered_orders``, by the columns given."""
    return orders.groupBy(*by).agg(
        F.count("*").alias("orders"),
        F.sum("shipped").cast("long").alias("shipped_orders"),
        F.sum("late").cast("long").alias("late_orders"),
    )


def late_delivery_by_store(fact: DataFrame, dim_stores: DataFrame) -> DataFrame:
    """Orders, shipped orders and late orders per store; late means shipped after the required date."""
    return late_shares(counted_orders(delivered_orders(fact, "store_key", "order_id"), "store_key"), dim_stores)


def late_shares(per_store: DataFrame, dim_stores: DataFrame) -> DataFrame:
    """Counts of orders by key of the store, added up by store, with the share of late ones."""
    dim = DIMENSIONS["stores"]
    counts = ["orders", "shipped_orders", "late_orders"]
    stores = (
        per_store.join(dim_stores.select(dim.key, dim.id), dim.key)
        .groupBy(dim.id)
        .agg(*[F.sum(c).cast("long").alias(c) for c in counts])
        .join(_latest(dim, dim_stores, ["store_name"]), dim.id)
    )
    share = F.round(F.col("late_orders").cast("double") / F.nullif("shipped_orders", F.lit(0)), 4)
    return stores.select(dim.id, "store_name", *counts, share.alias("late_share"))


def top_products(fact: DataFrame, dim_products: DataFrame, k: int = 10, by: str = "revenue") -> DataFrame:
    """The ``k`` best products by ``"revenue"`` or ``"units"``."""
    dim = DIMENSIONS["products"]
    second = "units" if by == "revenue" else "revenue"
    best = _by_id(fact, dim_products, dim).orderBy(F.desc(by), F.desc(second), dim.id).limit(k)
    names = _latest(dim, dim_products, ["product_name", "brand_name"])
    return best.join(names, dim.id).select(dim.id, "product_name", "brand_name", "revenue", "units")


def brand_ranking(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Brands ranked by revenue and by units sold."""
    per_version = fact.groupBy("product_key").agg(_revenue(), _units())
    brands = (
        per_version.join(dim_products.select("product_key", "brand_name"), "product_key")
        .groupBy("brand_name")
        .agg(_revenue("revenue"), _units("units"))
    )
    return brands.withColumns({"revenue_rank": _rank("revenue"), "units_rank": _rank("units")})


def unsold_products(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Products of which no version was ever sold."""
    dim = DIMENSIONS["products"]
    sold = fact.select(dim.key).distinct().join(dim_products.select(dim.key, dim.id), dim.key).select(dim.id)
    names = _latest(dim, dim_products, ["product_name", "brand_name"])
    return names.join(sold, dim.id, "left_anti")


def customers_by_state(dim_customers: DataFrame) -> DataFrame:
    """Active customers per state."""
    return dim_customers.filter(F.col("active_flag") == ACTIVE).groupBy("state").agg(F.count("*").alias("customers"))


def top_spenders(fact: DataFrame, dim_customers: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` customers who spent most, and where they live."""
    dim = DIMENSIONS["customers"]
    best = _by_id(fact, dim_customers, dim).orderBy(F.desc("revenue"), F.desc("units"), dim.id).limit(k)
    names = _latest(dim, dim_customers, ["first_name", "last_name", "state"])
    return best.join(names, dim.id).select(dim.id, "first_name", "last_name", "state", "revenue", "units")


def store_performance(fact: DataFrame, dim_stores: DataFrame) -> DataFrame:
    """Stores ranked by revenue, best first."""
    dim = DIMENSIONS["stores"]
    stores = _by_id(fact, dim_stores, dim).join(_latest(dim, dim_stores, ["store_name", "state"]), dim.id)
    ranked = stores.withColumn("revenue_rank", _rank("revenue"))
    return ranked.select(dim.id, "store_name", "state", "revenue", "units", "revenue_rank")


def staff_managers(staffs: DataFrame) -> DataFrame:
    """Each member of staff with the manager they report to."""
    managers = staffs.select(
        F.col("staff_id").alias("manager_id"),
        F.col("first_name").alias("manager_first_name"),
        F.col("last_name").alias("manager_last_name"),
    )
    own = staffs.select("staff_id", "first_name", "last_name", "manager_id")
    return own.join(managers, "manager_id", "left").select(*own.columns, "manager_first_name", "manager_last_name")


def staff_chains(staffs: DataFrame) -> DataFrame:
    """Each member of staff with the managers above them at every level: 1 is their own manager, 2 that one's, and so on.

    ``path`` lists the ids from the member of staff up. A chain ends at a member without a manager, at a manager who is not on the
    list, or where it comes back to someone who is in it already: that row says ``is_cycle``. Rows of staff without an id, or without a
    manager, start no chain; of repeated ids every row counts.
    """
    return staffs.sparkSession.sql(
        """
        WITH RECURSIVE above (staff_id, level, manager_id, way, is_cycle) AS (
            SELECT staff_id, 1, manager_id, array(staff_id, manager_id), staff_id = manager_id
            FROM {staffs} WHERE staff_id IS NOT NULL AND manager_id IS NOT NULL
            UNION ALL
            SELECT a.staff_id, a.level + 1, s.manager_id, array_append(a.way, s.manager_id), array_contains(a.way, s.manager_id)
            FROM above a JOIN {staffs} s ON s.staff_id = a.manager_id
            WHERE NOT a.is_cycle AND s.manager_id IS NOT NULL
        )
        SELECT staff_id, level, manager_id, array_join(way, '>') AS path, is_cycle FROM above""",
        staffs=staffs.select("staff_id", "manager_id"),
    )
