import glob

import pyarrow.parquet as pq
from frames import rows
from pyspark.sql import functions as F

from starloom.operators.extract import extract_orders
from starloom.operators.fact import KEYS, rejected_rows, waiting_rows
from starloom.schemas import STAGING
from starloom.sources.files import read_parquet, write_parquet
from starloom.sources.warehouse import Warehouse


def encodings(path):
    files = glob.glob(f"{path}/**/*.parquet", recursive=True)
    groups = [pq.ParquetFile(f).metadata.row_group(0) for f in files if pq.ParquetFile(f).metadata.num_row_groups]
    return {e for g in groups for c in range(g.num_columns) for e in g.column(c).encodings}


def test_tables_are_written_without_dictionaries(spark, tmp_path):
    sales = spark.range(100).select(*[F.col("id").cast("string").cast(f.dataType).alias(f.name) for f in STAGING["sales"].fields])
    write_parquet(sales, str(tmp_path / "sales"))
    assert read_parquet(spark, str(tmp_path / "sales"), STAGING["sales"]).count() == 100
    run = Warehouse(spark, str(tmp_path / "wh")).begin(None, None, "test", "1")
    run.publish("pending_sales", sales, F.lit("all"))
    assert rows(run.read("pending_sales")) == rows(sales)
    for path in ("sales", "wh/serving"):
        assert not {e for e in encodings(tmp_path / path) if "DICT" in e}


def test_keys_are_listed_only_for_lines_that_lack_one(spark, tmp_path):
    line = {f.name: "1" for f in STAGING["sales"].fields if f.dataType.simpleString() == "string"}
    found = [{**line, **dict.fromkeys(KEYS, 1), "order_id": str(k), **({KEYS[k % 5]: None} if k < 5 else {})} for k in range(20)]
    keyed = spark.createDataFrame(found, ", ".join(f"{c} STRING" for c in line) + "".join(f", {k} BIGINT" for k in KEYS))
    keyed = keyed.withColumns({f.name: F.lit(1).cast(f.dataType) for f in STAGING["sales"].fields if f.name not in line})
    keyed.write.parquet(str(tmp_path / "keyed"))
    keyed = spark.read.parquet(str(tmp_path / "keyed"))
    rejected = rejected_rows(keyed)
    assert rows(rejected, "order_id", "missing") == [(str(k), KEYS[k]) for k in range(5)]
    waiting = waiting_rows(keyed.withColumn("unknown", F.when(F.col("order_id") < 2, KEYS[0]).otherwise("")))
    assert rows(waiting, "order_id") == [("0",)]
    for found in (rejected, waiting):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [Or(Or(Or(Or(IsNull(customer_key)" in plan


def test_lines_are_not_sorted_to_meet_orders(spark, tmp_path):
    orders = spark.range(300).selectExpr(
        "cast(id as string) order_id", "'c' customer_id", "1 order_status_id", "DATE '2016-01-05' order_date", "DATE '2016-01-08' required_date",
        "CAST(NULL AS DATE) shipped_date", "'s' store_id", "'f' staff_id", "DATE '2016-01-05' updated_at")
    items = spark.range(900).selectExpr("cast(id % 400 as string) order_id", "'p' || id product_id", "1 quantity", "CAST(1 AS DECIMAL(10,2)) list_price", "CAST(0 AS DECIMAL(4,2)) discount")
    status = spark.range(1).selectExpr("1 order_status_id", "'Pending' order_status")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are too large for a broadcast
    try:
        lines = extract_orders(dict(orders=orders, order_items=items, order_status=status), "2015-12-31", "2016-02-01")
        assert len(lines.collect()) == 700
        plan = lines._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
