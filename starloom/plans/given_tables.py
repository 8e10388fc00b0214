"""The given tables as a retail store: raw dataset, and operational tables as of a day.

The mapping is plain SQL that means the same in Spark and in other engines, because the checks
run it on both sides. ``{name}`` stands for a given table or for another entry of the mapping,
``{day}`` for a date literal.

Orders start in 1995; 7670 days move them to start on 2016-01-01, the fixed first audit date.
Every entity has a day it appears and two later days on which it is changed, deleted or merely
touched, so that a table as of a day holds all kinds of change. Nearly all entities appear in the first window and change in
the second, so that nearly every order finds a version of everything it refers to.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.bootstrap import bootstrap_orders, order_status_lookup

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Two windows: (FIRST_START, FIRST_END] and (FIRST_END, SECOND_END].
FIRST_START, FIRST_END, SECOND_END = dt.date(2015, 12, 31), dt.date(2019, 12, 31), dt.date(2022, 12, 31)
# The end of a window before the first, in which many entities have not appeared yet.
EARLY_END = dt.date(2016, 3, 31)

RAW_SQL = {
    "raw_orders": """
        SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 2
                    WHEN o_orderstatus = 'P' THEN 1 WHEN o_orderstatus = 'O' THEN 3 ELSE 4 END AS order_status,
               CAST(o_orderdate AS DATE) + 7670 AS order_date,
               CAST(o_orderdate AS DATE) + 7675 AS required_date,
               CASE WHEN o_orderstatus = 'F' AND o_totalprice >= 5000
                    THEN CAST(o_orderdate AS DATE) + 7670 + CAST(o_orderkey % 10 AS INT) END AS shipped_date,
               CAST(o_orderkey % 25 AS STRING) AS store_id, CAST(o_custkey % 10 AS STRING) AS staff_id
        FROM {orders}""",
    "raw_order_items": """
        SELECT CAST(l_orderkey AS STRING) AS order_id, l_linenumber AS item_id,
               CAST(l_partkey AS STRING) AS product_id, CAST(l_quantity AS INT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS list_price, CAST(l_discount AS DECIMAL(4,2)) AS discount
        FROM {lineitem}""",
    "raw_customers": """
        SELECT CAST(c_custkey AS STRING) AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_nationkey >= 3 THEN '555-' || CAST(c_custkey AS STRING) END AS phone,
               'c' || CAST(c_custkey AS STRING) || '@mail.example' AS email, c_mktsegment || ' street' AS street,
               CASE WHEN c_acctbal < 5000 OR c_acctbal >= 5200 THEN n_name END AS city,
               r_name AS state, lpad(CAST(c_nationkey AS STRING), 5, '0') AS zip_code
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "raw_products": """
        SELECT CAST(p_partkey AS STRING) AS product_id, p_name || ' "' || CAST(p_size AS STRING) || '"' AS product_name,
               CAST(split_part(p_brand, '#', 2) AS INT) AS brand_id,
               CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                           WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END AS category_id,
               2016 + p_size % 4 AS model_year, CAST(p_retailprice AS DECIMAL(10,2)) AS list_price
        FROM {part}
        UNION ALL
        SELECT CAST(p_partkey AS STRING) || '-N', p_name || ' next', CAST(split_part(p_brand, '#', 2) AS INT), 4,
               2020, CAST(p_retailprice AS DECIMAL(10,2))
        FROM {part} WHERE p_type = 'PROMO'""",
    "raw_brands": """
        SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS INT) AS brand_id, p_brand AS brand_name FROM {part}""",
    "raw_categories": """
        SELECT DISTINCT CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                                    WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END AS category_id,
               p_type AS category_name
        FROM {part}""",
    "raw_staffs": """
        SELECT CAST(s_suppkey AS STRING) AS staff_id, split_part(s_name, '#', 1) AS first_name,
               split_part(s_name, '#', 2) AS last_name,
               's' || CAST(s_suppkey % 90 AS STRING) || '@store.example' AS email,
               '777-' || CAST(s_suppkey AS STRING) AS phone, 1 AS active, CAST(s_nationkey AS STRING) AS store_id,
               CASE WHEN s_suppkey > 0 THEN CAST((s_suppkey - s_suppkey % 10) / 10 AS DOUBLE) END AS manager_id
        FROM {supplier}""",
    "raw_stores": """
        SELECT CAST(n_nationkey AS STRING) AS store_id, n_name AS store_name,
               '888-' || CAST(n_nationkey AS STRING) AS phone,
               CASE WHEN n_nationkey < 24 THEN lower(n_name) || '@store.example' END AS email,
               'Main street ' || CAST(n_nationkey AS STRING) AS street, n_name AS city, r_name AS state,
               lpad(CAST(n_nationkey AS STRING), 5, '0') AS zip_code
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "raw_stocks": """
        SELECT CAST(l_orderkey % 25 AS STRING) AS store_id, CAST(l_partkey AS STRING) AS product_id,
               CAST(sum(CAST(l_quantity AS INT)) AS INT) AS quantity
        FROM {lineitem} GROUP BY l_orderkey % 25, l_partkey""",
}

# Days of change per entity: appeared, first and second change, each with what it does.
_HISTORY_SQL = {
    "customer_days": """
        SELECT c_custkey, first_order AS appeared,
               greatest(first_order + 30, DATE '2021-09-01' + (c_nationkey + 1) * CASE WHEN c_nationkey < 22 THEN 20 ELSE 60 END) AS t1,
               greatest(first_order + 30, DATE '2021-09-01' + (c_nationkey + 1) * CASE WHEN c_nationkey < 22 THEN 20 ELSE 60 END) + 20 AS t2,
               c_acctbal < 3000 AS changed1, c_mktsegment = 'MACHINERY' AND c_acctbal > 8000 AS deleted1,
               c_mktsegment = 'BUILDING' AS changed2, c_mktsegment = 'FURNITURE' AND c_acctbal > 7000 AS deleted2
        FROM {customer}
        JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE) + 7670) AS first_order
              FROM {orders} GROUP BY o_custkey) o ON c_custkey = o_custkey""",
    "product_days": """
        SELECT p_partkey, p_retailprice, p_type, appeared, t1, greatest(t1 + 20, DATE '2021-10-01' + p_size * 9) AS t2
        FROM (SELECT *, CASE WHEN p_size <= 2 THEN appeared + p_size * 30
                             ELSE greatest(appeared + 30, DATE '2021-09-15' + p_size * 9) END AS t1
              FROM (SELECT p_partkey, p_retailprice, p_type, p_size,
                           CASE WHEN p_size <= 48 THEN DATE '2016-01-01' ELSE DATE '2016-01-01' + p_size * 30 END AS appeared
                    FROM {part}) p) q""",
    "staff_days": """
        SELECT s_suppkey, s_nationkey, s_acctbal, appeared, DATE '2022-03-01' + (s_nationkey + 1) * 11 AS t1,
               DATE '2022-03-01' + (s_nationkey + 1) * 11 + 20 AS t2
        FROM (SELECT s_suppkey, s_nationkey, s_acctbal,
                     CASE WHEN s_acctbal < 8000 THEN DATE '2016-01-01'
                          ELSE DATE '2016-01-01' + CAST(s_suppkey % 5 + 1 AS INT) * 15 END AS appeared
              FROM {supplier}) s""",
    "store_days": """
        SELECT n_nationkey, n_regionkey, appeared, DATE '2022-03-01' + (n_nationkey + 1) * 11 AS t1,
               DATE '2022-03-01' + (n_nationkey + 1) * 11 + 20 AS t2
        FROM (SELECT n_nationkey, n_regionkey,
                     CASE WHEN n_regionkey < 4 THEN DATE '2016-01-01'
                          ELSE DATE '2016-01-01' + n_nationkey * 10 END AS appeared
              FROM {nation}) n""",
}

_LAST_CHANGE = "CASE WHEN t2 <= {day} THEN t2 WHEN t1 <= {day} THEN t1 ELSE appeared END"

# Raw orders, and audited entities, as the operational store holds them at the end of {day}.
AS_OF_SQL = {
    "orders_as_of": """
        SELECT order_id, customer_id,
               CASE WHEN order_status = 4 AND shipped_date > {day} THEN 1
                    WHEN order_status = 3 AND required_date + 1 > {day} THEN 1 ELSE order_status END AS order_status,
               order_date, required_date, CASE WHEN shipped_date <= {day} THEN shipped_date END AS shipped_date,
               store_id, staff_id
        FROM {raw_orders} WHERE order_date <= {day}""",
    "customers": f"""
        SELECT customer_id, first_name, last_name,
               CASE WHEN t1 <= {{day}} AND phone IS NULL THEN ''
                    WHEN t1 <= {{day}} AND changed1 THEN '666-' || customer_id ELSE phone END AS phone, email,
               CASE WHEN t2 <= {{day}} AND changed2 THEN street || ' 2' ELSE street END AS street,
               city, state, zip_code, appeared AS created_at, {_LAST_CHANGE} AS updated_at,
               CASE WHEN (t1 <= {{day}} AND deleted1) OR (t2 <= {{day}} AND deleted2) THEN 'N' ELSE 'Y' END AS is_active
        FROM {{raw_customers}} JOIN {{customer_days}} ON customer_id = CAST(c_custkey AS STRING)
        WHERE appeared <= {{day}}""",
    "products": f"""
        SELECT product_id,
               CASE WHEN t2 <= {{day}} AND p_type IN ('LARGE', 'MEDIUM') THEN product_name || ' v2'
                    ELSE product_name END AS product_name,
               brand_id, category_id, model_year,
               CAST(CASE WHEN t1 <= {{day}} AND p_retailprice < 950 THEN list_price + 10.00
                    ELSE list_price END AS DECIMAL(10,2)) AS list_price,
               appeared AS created_at, {_LAST_CHANGE} AS updated_at,
               CASE WHEN (t1 <= {{day}} AND p_type = 'SMALL') OR (t2 <= {{day}} AND p_type = 'STANDARD')
                    THEN 'N' ELSE 'Y' END AS is_active
        FROM {{raw_products}} JOIN {{product_days}} ON split_part(product_id, '-', 1) = CAST(p_partkey AS STRING)
        WHERE appeared <= {{day}}""",
    "staffs": f"""
        SELECT staff_id, first_name,
               CASE WHEN t2 <= {{day}} AND s_acctbal > 6000 THEN last_name || 'b' ELSE last_name END AS last_name,
               email, CASE WHEN t1 <= {{day}} AND s_acctbal < 4000 THEN '999-' || staff_id ELSE phone END AS phone,
               store_id, CAST(CAST(coalesce(manager_id, 1) AS INT) AS STRING) AS manager_id,
               appeared AS created_at, {_LAST_CHANGE} AS updated_at,
               CASE WHEN (t1 <= {{day}} AND s_nationkey IN (1, 13)) OR (t2 <= {{day}} AND s_nationkey IN (5, 15))
                    THEN 'N' ELSE 'Y' END AS is_active
        FROM {{raw_staffs}} JOIN {{staff_days}} ON staff_id = CAST(s_suppkey AS STRING)
        WHERE appeared <= {{day}}""",
    "stores": f"""
        SELECT store_id, store_name,
               CASE WHEN t2 <= {{day}} AND n_regionkey IN (2, 3) THEN '999-' || store_id ELSE phone END AS phone, email,
               CASE WHEN t1 <= {{day}} AND n_regionkey = 1 THEN 'New street' ELSE street END AS street,
               city, state, zip_code, appeared AS created_at, {_LAST_CHANGE} AS updated_at,
               CASE WHEN (t1 <= {{day}} AND n_nationkey = 1) OR (t2 <= {{day}} AND n_nationkey = 13)
                    THEN 'N' ELSE 'Y' END AS is_active
        FROM {{raw_stores}} JOIN {{store_days}} ON store_id = CAST(n_nationkey AS STRING)
        WHERE appeared <= {{day}}""",
}


# Parents that are gone: what is left of each table, for the checks of references and cascades.
LEFT_SQL = {
    **{n: "is_active = 'Y'" for n in ("customers", "products", "staffs", "stores")},
    "orders": "updated_at IS NOT NULL",
    "brands": "brand_name <> 'Brand#11'",
    "categories": "category_name <> 'PROMO'",
    "order_status": "order_status <> 'Rejected'",
}


class RetailStore:
    """The given tables of one folder, seen as raw dataset and as operational tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._frames: dict[str, DataFrame] = {
            name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet") for name in GIVEN
        }

    def __getitem__(self, name: str) -> DataFrame:
        """A given table, an entry of the raw dataset, or the days of change of an entity."""
        if name not in self._frames:
            self._frames[name] = self._sql({**RAW_SQL, **_HISTORY_SQL}[name])
        return self._frames[name]

    def _sql(self, text: str, **literals: str) -> DataFrame:
        names = [n for n in (*GIVEN, *RAW_SQL, *_HISTORY_SQL) if "{" + n + "}" in text]
        for key, value in literals.items():
            text = text.replace("{" + key + "}", value)
        return self.spark.sql(text, **{n: self[n] for n in names})

    def raw(self) -> dict[str, DataFrame]:
        return {name.removeprefix("raw_"): self[name] for name in RAW_SQL}

    def raw_as_of(self, name: str, day: dt.date) -> DataFrame:
        return self._sql(AS_OF_SQL[name], day=f"DATE '{day}'")

    def tables(self, day: dt.date) -> Mapping[str, DataFrame]:
        """The operational tables at the end of ``day``."""
        entities = {n: self.raw_as_of(n, day) for n in ("customers", "products", "staffs", "stores")}
        return {
            **entities,
            "orders": bootstrap_orders(self.raw_as_of("orders_as_of", day)),
            "order_items": self["raw_order_items"],
            "order_status": order_status_lookup(self.spark),
            "brands": self["raw_brands"],
            "categories": self["raw_categories"],
            "stocks": self["raw_stocks"],
        }
