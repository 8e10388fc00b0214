import datetime as dt

from frames import frame, rows
from pyspark.sql import functions as F

from starloom.functions.dates import business_date, date_key, key_to_date, parse_date
from starloom.operators.bootstrap import bootstrap_customers, bootstrap_orders, bootstrap_products, bootstrap_staffs, bootstrap_store, order_status_lookup
from starloom.operators.extract import changed_between, extract_orders, extract_products, extraction_windows
from starloom.schemas import EXTRACT, OPERATIONAL, RAW


def test_window_is_half_open(spark):
    days = ["2016-01-01", "2016-01-02", "2016-01-31", "2016-02-01", None]
    table = frame(spark, OPERATIONAL["orders"], [dict(order_id=str(d), updated_at=d) for d in days])
    assert rows(changed_between(table, "2016-01-01", dt.date(2016, 1, 31)), "order_id") == [("2016-01-02",), ("2016-01-31",)]


def test_extract_orders_and_products(spark):
    order = dict(order_id="1", customer_id="1", order_status_id=3, order_date="2016-01-01", required_date="2016-01-05", store_id="1", staff_id="1", updated_at="2016-01-02")
    item = dict(order_id="1", item_id=1, product_id="p", quantity=1, list_price="1", discount="0")
    tables = {
        "orders": frame(spark, OPERATIONAL["orders"], [order, {**order, "order_id": "no_lines"}]),
        "order_items": frame(spark, OPERATIONAL["order_items"], [item, {**item, "item_id": 2, "product_id": "q"}]),
        "order_status": order_status_lookup(spark),
        "products": frame(spark, OPERATIONAL["products"], [dict(product_id="p", product_name="n", brand_id=1, category_id=1, model_year=2016, list_price="1", updated_at="2016-01-01", is_active="Y")]),
        "brands": frame(spark, OPERATIONAL["brands"], [(1, "b")]),
        "categories": frame(spark, OPERATIONAL["categories"], [(1, "c")]),
    }
    orders = extract_orders(tables, "2015-12-31", "2016-01-31")
    assert orders.columns == EXTRACT["orders"].names
    assert rows(orders, "order_id", "order_status", "product_id") == [("1", "Completed", "p"), ("1", "Completed", "q")]
    assert rows(extract_products(tables, "2015-12-31", "2016-01-31"), "brand_name", "category_name") == [("b", "c")]


def test_filter_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "orders")
    frame(spark, OPERATIONAL["orders"], [dict(order_id="1", updated_at="2016-01-01")]).write.parquet(path)
    plan = changed_between(spark.read.parquet(path), "2015-12-31", "2016-01-31").select("order_id")._jdf.queryExecution().toString()
    assert "GreaterThan(updated_at" in plan and "LessThanOrEqual(updated_at" in plan
    assert "ReadSchema: struct<order_id:string,updated_at:date>" in plan


def test_windows_follow_the_last_success(spark):
    runs = spark.createDataFrame(
        [("2024-10-08 20:00:00", True), ("2024-10-09 20:00:00", False), ("2024-10-10 16:59:59", False), ("2024-10-11 20:00:00", True)], "ts string, ok boolean"
    ).withColumn("ts", F.to_timestamp("ts"))
    windows = extraction_windows(runs, "ts", "ok")
    assert rows(windows, "current_date", "previous_date", "runs", "succeeded") == [
        ("2024-10-09", "2015-12-31", "1", "True"), ("2024-10-10", "2024-10-09", "2", "False"), ("2024-10-12", "2024-10-09", "1", "True"),
    ]


def test_dates(spark):
    row = spark.sql("SELECT DATE '2016-02-29' d, TIMESTAMP '2024-10-08 17:00:00' t, 'junk' j").select(
        date_key("d").alias("k"), key_to_date(date_key("d")).alias("back"), business_date("t").alias("b"), parse_date("j").alias("j")
    ).first()
    assert (row.k, row.back, row.b, row.j) == ("20160229", dt.date(2016, 2, 29), dt.date(2024, 10, 9), None)


ORDER = dict(customer_id="1", order_date="2016-01-05", required_date="2016-01-10", store_id="1", staff_id="1")


def test_bootstrap_orders(spark):
    raw = frame(
        spark, RAW["orders"],
        [{**ORDER, "order_id": str(s), "order_status": s, "shipped_date": "2016-01-07" if s == 4 else None} for s in (1, 2, 3, 4)]
        + [{**ORDER, "order_id": "5", "order_status": 4}],
    )
    assert rows(bootstrap_orders(raw), "order_id", "order_status_id", "updated_at") == [
        ("1", "1", "2016-01-05"), ("2", "1", "2016-01-05"), ("3", "2", "2016-01-11"), ("4", "3", "2016-01-07"), ("5", "3", "None"),
    ]


def test_bootstrap_entities(spark):
    customers = frame(spark, RAW["customers"], [dict(customer_id="1", zip_code="01234"), dict(customer_id="2")])
    orders = frame(spark, RAW["orders"], [{**ORDER, "order_id": "1"}, {**ORDER, "order_id": "2", "order_date": "2016-01-02"}])
    made = bootstrap_customers(customers, orders)
    assert rows(made, "customer_id", "zip_code", "created_at", "updated_at", "is_active") == [("1", "01234", "2016-01-02", "2016-01-02", "Y")]
    staffs = frame(spark, RAW["staffs"], [dict(staff_id="1", active=1), dict(staff_id="2", active=1, manager_id=1.0), dict(staff_id="3", manager_id=7.0)])
    assert rows(bootstrap_staffs(staffs), "staff_id", "manager_id", "created_at") == [("1", "1", "2016-01-01"), ("2", "1", "2016-01-01"), ("3", "7", "2016-01-01")]
    assert bootstrap_staffs(staffs).columns == OPERATIONAL["staffs"].names
    assert bootstrap_products(frame(spark, RAW["products"], [dict(product_id="p")])).columns == OPERATIONAL["products"].names


def test_bootstrap_store_has_every_table(spark):
    raw = {n: frame(spark, s, []) for n, s in RAW.items()}
    raw["order_items"] = frame(spark, RAW["order_items"], [dict(order_id="1", item_id=1)])
    tables = bootstrap_store(spark, raw)
    assert {n: t.columns for n, t in tables.items()} == {n: s.names for n, s in OPERATIONAL.items()}
    assert rows(tables["order_items"], "discount") == [("0.00",)]
