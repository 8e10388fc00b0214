import datetime as dt

from frames import frame, rows
from pyspark.sql import functions as F
from test_daily import ITEM, ORDER, counted_stages, tables

from starloom.operators.extract import EXTRACTIONS
from starloom.operators.staging import STAGE
from starloom.plans.daily import load_dimension, run_batch
from starloom.schemas import DIMENSIONS, EXTRACT, SERVING
from starloom.sources.warehouse import Warehouse
from starloom.streaming.arrivals import latest_changes, order_loader, several_changes, stream_orders

FACT = [c for c in SERVING["fact_sales"].names if c != "sales_id"]
LINE = dict(order_id="1", customer_id="c", order_status="Pending", order_date="2016-01-05", required_date="2016-01-08", store_id="s", staff_id="f",
            product_id="p", quantity=2, list_price="10", discount="0.10", updated_at="2016-01-05")


def with_dimensions(spark, root, given):
    """A warehouse that holds the dimensions, but no sales."""
    warehouse = Warehouse(spark, str(root))
    run = warehouse.begin(dt.date(2015, 12, 31), dt.date(2016, 1, 1), "dimensions")
    for name, dim in DIMENSIONS.items():
        load_dimension(run, STAGE[name](EXTRACTIONS[name](given, dt.date(2015, 12, 31), dt.date(2016, 1, 1))), dim)
    run.commit()
    return warehouse


def lines(spark, *changed):
    return frame(spark, EXTRACT["orders"], [{**LINE, **c} for c in changed])


def test_stream_and_daily_runs_give_the_same_fact(spark, tmp_path):
    orders, items = [], []
    for k in range(40):
        day = dt.date(2016, 1, 2) + dt.timedelta(days=k)
        shipped = day + dt.timedelta(days=2) if k % 3 else None
        changed = shipped or day
        orders.append({**ORDER, "order_id": str(k), "order_status_id": 3 if shipped else 1, "order_date": str(day), "required_date": str(day),
                       "shipped_date": shipped and str(shipped), "updated_at": str(changed)})
        items += [{**ITEM, "order_id": str(k), "item_id": i, "product_id": "p" if i == 1 else "nowhere"} for i in range(1, 2 + k % 2)]
    given = tables(spark, orders=orders, order_items=items)
    batch = Warehouse(spark, str(tmp_path / "batch"))
    for end in (dt.date(2016, 1, 20), dt.date(2016, 3, 1)):
        run_batch(batch, given, end)

    streamed, landing, checkpoint = with_dimensions(spark, tmp_path / "stream", given), str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    start = dt.date(2015, 12, 31)
    for end in (dt.date(2016, 1, 20), dt.date(2016, 3, 1)):
        extract = EXTRACTIONS["orders"](given, start, end)
        extract.coalesce(1).write.mode("append").parquet(landing)
        extract.coalesce(1).write.mode("append").parquet(landing)  # delivered twice
        stream_orders(streamed, landing, checkpoint, files=1).awaitTermination()
        start = end
    assert streamed.read("fact_sales").count() == 40
    assert rows(streamed.read("fact_sales"), *FACT) == rows(batch.read("fact_sales"), *FACT)
    for table in ("fact_orders", "dim_date", "dim_order_status"):
        assert rows(streamed.read(table)) == rows(batch.read(table))
    register = streamed.read("order_register")
    assert rows(register, "order_id", "updated_at") == sorted((o["order_id"], o["updated_at"]) for o in orders)


def test_late_and_repeated_changes_have_no_effect(spark, tmp_path):
    warehouse = with_dimensions(spark, tmp_path / "wh", tables(spark))
    load = order_loader(warehouse)
    shipped = dict(shipped_date="2016-01-09", order_status="Completed", updated_at="2016-01-09")
    load(lines(spark, {}, {"order_id": "2"}), 0)
    load(lines(spark, shipped), 1)
    after = rows(warehouse.read("fact_sales"))
    assert rows(warehouse.read("fact_sales"), "order_id", "shipped_date") == [("1", "20160109"), ("2", "None")]

    # The first state again, beside a new order; then the whole of it again under its own number.
    load(lines(spark, {}, {"order_id": "2"}, {"order_id": "3", "order_date": "2016-01-02", "updated_at": "2016-01-02"}), 2)
    assert rows(warehouse.read("fact_sales"), "order_id", "shipped_date") == [("1", "20160109"), ("2", "None"), ("3", "None")]
    assert set(after) <= set(rows(warehouse.read("fact_sales")))
    number = warehouse.entries()[0]
    load(lines(spark, shipped), 1)
    assert warehouse.entries()[0] == number
    folder = [r.folder for r in warehouse.log().where("job = 'stream-orders' AND run_id = '2'").select("folder").distinct().collect()]
    assert folder  # the run is in the log
    late = spark.read.parquet(*[str(p) for p in (tmp_path / "wh" / "staging").glob("run=stream-orders-2-*/late_orders")])
    assert rows(late, "order_id", "updated_at") == [("1", "2016-01-05"), ("2", "2016-01-05")]


def test_a_change_that_names_another_month_meets_the_register(spark, tmp_path):
    warehouse = with_dimensions(spark, tmp_path / "wh", tables(spark))
    load = order_loader(warehouse)
    load(lines(spark, dict(shipped_date="2016-01-09", updated_at="2016-01-09")), 0)
    load(lines(spark, dict(order_date="2016-03-05", shipped_date=None, updated_at="2016-01-07")), 1)
    assert rows(warehouse.read("fact_sales"), "order_id", "order_date", "shipped_date") == [("1", "20160105", "20160109")]


def test_the_last_change_in_a_micro_batch_counts(spark, tmp_path):
    both = lines(
        spark, {}, {"product_id": "q"}, dict(shipped_date="2016-01-07", updated_at="2016-01-07"),
        dict(order_id=None), dict(order_id="2", updated_at=None), dict(order_id="3"), dict(order_id="3"),
    )
    found = rows(latest_changes(both), "order_id", "product_id", "updated_at")
    assert found == [("1", "p", "2016-01-07"), ("3", "p", "2016-01-05"), ("3", "p", "2016-01-05")]
    warehouse = with_dimensions(spark, tmp_path / "wh", tables(spark))
    load = order_loader(warehouse)
    load(both.limit(0), 0)
    load(lines(spark, dict(updated_at=None)), 1)
    assert warehouse.entries()[0] == 1  # nothing to load, no run
    load(both, 2)
    assert rows(warehouse.read("fact_sales"), "order_id", "product_key", "shipped_date") == [("1", "1", "20160107"), ("3", "1", "None")]


def test_orders_wait_for_what_they_name(spark, tmp_path):
    given = tables(spark)
    warehouse = with_dimensions(spark, tmp_path / "wh", {**given, "products": given["products"].limit(0)})
    load = order_loader(warehouse, wait=True)
    load(lines(spark, {}), 0)
    assert warehouse.read("fact_sales").count() == 0 and warehouse.read("pending_sales").count() == 1
    run = warehouse.begin(dt.date(2016, 1, 9), dt.date(2016, 1, 10), "dimensions")
    load_dimension(run, STAGE["products"](EXTRACTIONS["products"](given, "2015-12-31", "2016-01-10")), DIMENSIONS["products"])
    run.commit()
    load(lines(spark, {"order_id": "2", "updated_at": "2016-01-10"}), 1)
    assert rows(warehouse.read("fact_sales"), "order_id") == [("1",), ("2",)]
    assert warehouse.read("pending_sales").count() == 0


def test_a_micro_batch_is_computed_once(spark, tmp_path, monkeypatch):
    warehouse = with_dimensions(spark, tmp_path / "wh", tables(spark))
    counts, seen = counted_stages(monkeypatch), spark.sparkContext.accumulator(0)
    given = lines(spark, *[dict(order_id=str(k)) for k in range(20)], dict(shipped_date="2016-01-07", updated_at="2016-01-07"))

    def looked_at(row):
        seen.add(1)
        return row

    order_loader(warehouse)(spark.createDataFrame(given.rdd.map(looked_at), given.schema), 0)
    assert seen.value == 21
    assert counts["several_changes"] == 1 and counts["changes"] == 20
    assert rows(warehouse.read("fact_sales").where("shipped_date IS NOT NULL"), "order_id", "shipped_date") == [("1", "20160107")]


def test_lines_of_orders_with_one_change_are_not_moved(spark, tmp_path):
    several_changes(lines(spark, {}, dict(updated_at="2016-01-07"), dict(order_id="2"))).write.parquet(str(tmp_path / "several"))
    several = spark.read.parquet(str(tmp_path / "several"))
    assert rows(several) == [("1", "2016-01-07")]
    many = spark.range(1000).select(*[(F.lit("2016-01-05") if f.name.endswith(("date", "_at")) else F.col("id")).cast(f.dataType).alias(f.name) for f in EXTRACT["orders"].fields])
    found = latest_changes(many, several)
    assert found.count() == 999  # order 1 has a later change elsewhere
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def test_what_arrives_again_within_the_time_is_dropped_without_state(spark, tmp_path):
    warehouse = with_dimensions(spark, tmp_path / "wh", tables(spark))
    landing, checkpoint = str(tmp_path / "landing"), tmp_path / "checkpoint"

    def arrive(*changed, again="1 day"):
        lines(spark, *changed).coalesce(1).write.mode("append").parquet(landing)
        stream_orders(warehouse, landing, str(checkpoint), again).awaitTermination()
        return warehouse.log().where("job = 'stream-orders'").agg(F.max("run_id")).first()[0]

    def late(number):
        found = [str(p) for p in (tmp_path / "wh" / "staging").glob(f"run=stream-orders-{number}-*/late_orders")]
        return rows(spark.read.parquet(*found), "order_id", "quantity", "updated_at")

    shipped = dict(shipped_date="2016-01-09", updated_at="2016-01-09")
    assert arrive({}, {}, dict(order_id="2"), dict(order_id="2", staff_id=None)) == "0"
    assert rows(warehouse.read("recent_arrivals"), "order_id", "staff_id") == [("1", "f"), ("2", "None"), ("2", "f")]
    assert arrive({}, dict(order_id="2", staff_id=None)) == "0"  # nothing else came: no run
    # Beside news, a row that came before is dropped, and one with another value is late.
    assert arrive({}, dict(quantity=3), dict(order_id="2", staff_id=None), dict(order_id="3"), dict(order_id="2", **shipped)) == "2"
    assert late(2) == [("1", "3", "2016-01-05")]
    assert rows(warehouse.read("fact_sales"), "order_id", "shipped_date") == [("1", "None"), ("2", "20160109"), ("3", "None")]
    # After the time the register alone tells, and what came before it is forgotten.
    spark.conf.set("spark.sql.session.timeZone", "+10:00")  # ten hours later by the clock of the minutes
    try:
        assert arrive({}, dict(order_id="4"), again="2 hours") == "3"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert late(3) == [("1", "2", "2016-01-05")]
    assert rows(warehouse.read("recent_arrivals"), "order_id") == [("1",), ("4",)]
    assert not (checkpoint / "state").exists()
