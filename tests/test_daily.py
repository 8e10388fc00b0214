import datetime as dt

import pytest
from frames import frame, rows
from pyspark.sql import functions as F

from starloom.operators.bootstrap import order_status_lookup
from starloom.operators.fact import offered_lines
from starloom.plans.daily import extract_all, known_orders, newest_segment, run_batch, stage_all
from starloom.schemas import DIMENSION_PARTITIONS, DIMENSIONS, EXTRACT, OPERATIONAL, SERVING, STAGING
from starloom.sources.files import read_parquet
from starloom.sources.warehouse import Run, Warehouse
from starloom.streaming.arrivals import dimension_loader, stream_dimension

AUDIT = dict(created_at="2016-01-01", updated_at="2016-01-01", is_active="Y")
CUSTOMER = dict(customer_id="c", first_name="f", last_name="l", email="e", city="c", state="NY", zip_code="1", **AUDIT)
STORE = dict(store_id="s", store_name="n", phone="p", email="e", street="s", city="c", state="NY", zip_code="1", **AUDIT)
STAFF = dict(staff_id="f", first_name="f", last_name="l", email="e", phone="p", store_id="s", manager_id="f", **AUDIT)
PRODUCT = dict(product_id="p", product_name="n", brand_id=1, category_id=1, model_year=2016, list_price="10", **AUDIT)
ORDER = dict(order_id="1", customer_id="c", order_status_id=1, order_date="2016-01-05", required_date="2016-01-08", store_id="s", staff_id="f", updated_at="2016-01-05")
ITEM = dict(order_id="1", item_id=1, product_id="p", quantity=2, list_price="10", discount="0.10")


def tables(spark, **changed):
    made = dict(customers=[CUSTOMER], stores=[STORE], staffs=[STAFF], products=[PRODUCT], orders=[ORDER], order_items=[ITEM],
                brands=[(1, "b")], categories=[(1, "c")])
    made.update(changed)
    return {n: frame(spark, OPERATIONAL[n], r) for n, r in made.items()} | {"order_status": order_status_lookup(spark)}


def test_three_days(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    run_batch(warehouse, tables(spark), dt.date(2016, 1, 6))
    fact = ["sales_id", "order_id", "product_key", "shipped_date", "order_status_id", "total_price_with_discount"]
    assert rows(warehouse.read("fact_sales"), *fact) == [("1", "1", "1", "None", "1", "18.00")]

    # Day two: the order ships and gets a line too late, the price changes, a new order is placed.
    shipped = {**ORDER, "order_status_id": 3, "shipped_date": "2016-01-09", "updated_at": "2016-01-09"}
    placed = {**ORDER, "order_id": "2", "order_date": "2016-01-10", "updated_at": "2016-01-10"}
    early = {**ORDER, "order_id": "3", "order_date": "2015-12-30", "updated_at": "2016-01-10"}
    day_two = tables(
        spark,
        products=[{**PRODUCT, "list_price": "12", "updated_at": "2016-01-10"}],
        orders=[shipped, placed, early],
        order_items=[ITEM, {**ITEM, "item_id": 2, "product_id": "q"}, {**ITEM, "order_id": "2"}, {**ITEM, "order_id": "3"}],
    )
    run = run_batch(warehouse, day_two, dt.date(2016, 1, 10))
    assert run.previous == dt.date(2016, 1, 6)
    assert rows(warehouse.read("fact_sales"), *fact) == [
        ("1", "1", "1", "20160109", "3", "18.00"), ("2", "2", "2", "None", "1", "18.00"),
    ]
    assert rows(warehouse.read("dim_products"), "product_key", "list_price", "eff_date", "exp_date", "active_flag") == [
        ("1", "10.00", "2016-01-01", "2016-01-09", "N"), ("2", "12.00", "2016-01-10", "9999-12-31", "Y"),
    ]
    assert warehouse.read("dim_order_status").count() == 3
    rejected = spark.read.parquet(run._staging("rejected_sales"))
    assert rows(rejected, "order_id", "missing") == [("3", "customer_key,store_key,staff_key,product_key")]

    # Day three: nothing changed, nothing changes. Earlier states stay readable.
    before = {t: rows(warehouse.read(t)) for t in SERVING}
    run_batch(warehouse, day_two, dt.date(2016, 1, 11))
    assert {t: rows(warehouse.read(t)) for t in SERVING} == before
    assert warehouse.read("fact_sales", seq=1).count() == 1
    assert {r.run_id for r in warehouse.log().select("run_id").collect()} == {"20160106", "20160110", "20160111"}


def test_only_months_with_a_moved_order_are_rewritten(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    feb = {**ORDER, "order_id": "2", "order_date": "2016-02-05", "updated_at": "2016-02-05"}
    items = [ITEM, {**ITEM, "order_id": "2"}, {**ITEM, "order_id": "3"}]
    run_batch(warehouse, tables(spark, orders=[ORDER, feb], order_items=items), dt.date(2016, 2, 6))

    def folders():
        _, entries = warehouse.entries()
        return {(e.segment, e.folder) for e in entries if e.table == "fact_sales"}

    first = folders()
    shipped = {**feb, "order_status_id": 3, "shipped_date": "2016-02-07", "updated_at": "2016-02-07"}
    late = {**ORDER, "order_id": "3", "order_date": "2016-01-31", "updated_at": "2016-02-07"}
    run_batch(warehouse, tables(spark, orders=[ORDER, shipped, late], order_items=items), dt.date(2016, 2, 8))
    second = folders()
    assert sorted(s for s, _ in first & second) == ["201601"]  # kept, and added to
    assert sorted(s for s, _ in second - first) == ["201601", "201602"]
    assert rows(warehouse.read("fact_sales"), "order_id", "shipped_date") == [("1", "None"), ("2", "20160207"), ("3", "None")]


def counted_stages(monkeypatch):
    """The rows of each intermediate table, as they are written."""
    counts, stage = {}, Run.stage

    def counting(run, name, *rest, **options):
        table = stage(run, name, *rest, **options)
        counts[name] = table.count()
        return table

    monkeypatch.setattr(Run, "stage", counting)
    return counts


def test_only_orders_that_the_fact_holds_are_stored_to_meet_the_lines(spark, tmp_path, monkeypatch):
    warehouse, counts = Warehouse(spark, str(tmp_path / "wh")), counted_stages(monkeypatch)
    items = [ITEM, *[{**ITEM, "order_id": str(k)} for k in range(2, 30)]]
    run_batch(warehouse, tables(spark, order_items=items), dt.date(2016, 1, 6))
    assert counts["held_orders"] == 0
    shipped = {**ORDER, "order_status_id": 3, "shipped_date": "2016-01-09", "updated_at": "2016-01-09"}
    later = [{**ORDER, "order_id": str(k), "order_date": "2016-01-08", "updated_at": "2016-01-09"} for k in range(2, 30)]
    run_batch(warehouse, tables(spark, orders=[shipped, *later], order_items=items), dt.date(2016, 1, 10))
    assert counts["held_orders"] == 1 and counts["stg_sales"] == 29
    fact = warehouse.read("fact_sales")
    assert fact.count() == 29
    assert rows(fact.where("shipped_date IS NOT NULL"), "order_id", "shipped_date", "order_status_id") == [("1", "20160109", "3")]


def test_a_merge_reads_and_writes_only_the_partitions_of_its_ids(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    many = [{**PRODUCT, "product_id": f"p{k}"} for k in range(200)]
    run_batch(warehouse, tables(spark, products=[PRODUCT, *many]), dt.date(2016, 1, 6))

    def folders():
        return {(e.segment, e.folder) for e in warehouse.entries()[1] if e.table == "dim_products"}

    first = folders()
    assert len(first) == DIMENSION_PARTITIONS["dim_products"]
    changed = [{**many[3], "list_price": "11", "updated_at": "2016-01-08"}, {**many[4], "is_active": "N", "updated_at": "2016-01-08"}]
    kept = [p for k, p in enumerate(many) if k not in (3, 4)]
    run_batch(warehouse, tables(spark, products=[PRODUCT, *kept, *changed]), dt.date(2016, 1, 8))
    second = folders()
    ids = spark.createDataFrame([("p3",), ("p4",)], "product_id string")
    hit = {r[0] for r in ids.select(newest_segment(DIMENSIONS["products"])).collect()}
    assert {s for s, _ in second - first} == {*hit, "history"} and {s for s, _ in first - second} == hit
    old = spark.read.parquet(*[f for s, f in second if s == "history"])
    assert rows(old, "product_id", "list_price", "active_flag") == [("p3", "10.00", "N")]
    # What was closed stays closed, though history is not read.
    again = [{**many[4], "updated_at": "2016-01-10"}, {**many[3], "list_price": "12", "updated_at": "2016-01-10"}]
    run_batch(warehouse, tables(spark, products=[PRODUCT, *kept, *again]), dt.date(2016, 1, 10))
    found = rows(warehouse.read("dim_products").where("product_id IN ('p3', 'p4')"), "product_id", "list_price", "eff_date", "exp_date", "active_flag")
    assert found == [
        ("p3", "10.00", "2016-01-01", "2016-01-07", "N"), ("p3", "11.00", "2016-01-08", "2016-01-09", "N"), ("p3", "12.00", "2016-01-10", "9999-12-31", "Y"),
        ("p4", "10.00", "2016-01-01", "2016-01-08", "N"),
    ]
    assert warehouse.read("dim_products").count() == 203


def test_known_orders_come_from_few_months(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    orders = [{**ORDER, "order_id": str(m), "order_date": f"2016-{m:02}-05", "updated_at": f"2016-{m:02}-05"} for m in range(1, 7)]
    items = [{**ITEM, "order_id": str(m)} for m in range(1, 9)]
    run_batch(warehouse, tables(spark, orders=orders, order_items=items), dt.date(2016, 6, 30))
    # One order of June ships, one of February has got another order date, one is new.
    shipped = {**orders[5], "order_status_id": 3, "shipped_date": "2016-07-01", "updated_at": "2016-07-01"}
    moved = {**orders[1], "order_date": "2016-07-01", "order_status_id": 3, "shipped_date": "2016-07-02", "updated_at": "2016-07-02"}
    placed = {**ORDER, "order_id": "8", "order_date": "2016-07-01", "updated_at": "2016-07-01"}
    run = warehouse.begin(dt.date(2016, 6, 30), dt.date(2016, 7, 2))
    staged = stage_all(run, extract_all(run, tables(spark, orders=[*orders[2:5], orders[0], shipped, moved, placed], order_items=items)))
    known = known_orders(run, staged["sales"])
    assert rows(known, "order_id") == [("2",), ("6",)]
    assert len({f.split("segment=")[1][:6] for f in known.inputFiles()}) == 2
    run_batch(warehouse, tables(spark, orders=[shipped, moved, placed], order_items=items), dt.date(2016, 7, 2))
    assert rows(warehouse.read("fact_sales"), "order_id", "order_date", "shipped_date") == [
        ("1", "20160105", "None"), ("2", "20160205", "20160702"), ("3", "20160305", "None"), ("4", "20160405", "None"), ("5", "20160505", "None"),
        ("6", "20160605", "20160701"), ("8", "20160701", "None"),
    ]


def test_sales_wait_for_the_ids_they_name(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    items = [ITEM, {**ITEM, "item_id": 2, "product_id": "late"}, {**ITEM, "item_id": 3, "product_id": "never"}]
    fact = ["sales_id", "order_id", "product_key", "shipped_date", "order_status_id"]

    def run(day, **changed):
        run_batch(warehouse, tables(spark, order_items=items, **changed), dt.date(2016, 1, day), wait=True)

    run(6)
    assert rows(warehouse.read("fact_sales"), *fact) == [("1", "1", "1", "None", "1")]
    assert rows(warehouse.read("pending_sales"), "order_id", "product_id") == [("1", "late"), ("1", "never")]
    # The order ships while two of its lines still wait; one of them is of a product that comes with this run.
    shipped = {**ORDER, "order_status_id": 3, "shipped_date": "2016-01-09", "updated_at": "2016-01-09"}
    late = {**PRODUCT, "product_id": "late", "updated_at": "2016-01-08"}
    run(10, orders=[shipped], products=[PRODUCT, late])
    both = [("1", "1", "1", "20160109", "3"), ("2", "1", "2", "20160109", "3")]
    assert rows(warehouse.read("fact_sales"), *fact) == both
    assert rows(warehouse.read("pending_sales"), "product_id", "shipped_date") == [("never", "20160109")]
    assert rows(warehouse.read("fact_orders")) == [("1", "20160105", "20160109", "None")]
    # Runs without news of the order, and with the same order once more, add nothing.
    run(11, orders=[shipped], products=[PRODUCT, late])
    run(12, orders=[{**shipped, "updated_at": "2016-01-12"}], products=[PRODUCT, late])
    assert rows(warehouse.read("fact_sales"), *fact) == both
    # The last line enters long after its order was last seen.
    run(20, orders=[shipped], products=[PRODUCT, late, {**late, "product_id": "never", "updated_at": "2016-01-20"}])
    assert rows(warehouse.read("fact_sales"), "order_id", "product_key", "shipped_date") == [
        ("1", "1", "20160109"), ("1", "2", "20160109"), ("1", "3", "20160109"),
    ]
    assert warehouse.read("pending_sales").count() == 0 and warehouse.read("fact_orders").count() == 1


def test_lines_with_all_versions_are_not_settled_again(spark, tmp_path, monkeypatch):
    warehouse, counts = Warehouse(spark, str(tmp_path / "wh")), counted_stages(monkeypatch)
    items = [{**ITEM, "order_id": str(k)} for k in range(1, 9)] + [{**ITEM, "product_id": "late"}]
    orders = [{**ORDER, "order_id": str(k)} for k in range(1, 9)]
    run_batch(warehouse, tables(spark, orders=orders, order_items=items), dt.date(2016, 1, 6), wait=True)
    assert counts["keyed_sales"] == 9 and counts["settled_sales"] == 1
    assert warehouse.read("fact_sales").count() == 8
    assert rows(warehouse.read("pending_sales"), "order_id", "product_id") == [("1", "late")]
    # The batch meets few waiting lines without a shuffle of its own rows.
    batch = spark.range(1000).select(*[F.col("id").cast(f.dataType).alias(f.name) if f.name in ("order_id", "product_id") else F.lit(None).cast(f.dataType).alias(f.name) for f in STAGING["sales"].fields])
    plan = offered_lines(warehouse.read("pending_sales"), batch)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and plan.index("LeftSemi") > plan.index("LeftOuter")


def test_sales_in_a_gap_between_versions_do_not_wait(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    gone = {**PRODUCT, "product_id": "gone", "updated_at": "2016-01-03", "is_active": "N"}
    placed = {**ORDER, "order_id": "2", "order_date": "2016-01-02", "updated_at": "2016-01-05"}
    items = [{**ITEM, "product_id": "gone"}, {**ITEM, "order_id": "2", "product_id": "gone"}]
    run = run_batch(warehouse, tables(spark, products=[gone], orders=[ORDER, placed], order_items=items), dt.date(2016, 1, 6), wait=True)
    # Order 1 is later than the only version, order 2 earlier: that one takes it.
    assert rows(warehouse.read("fact_sales"), "order_id") == [("2",)]
    assert warehouse.read("pending_sales").count() == 0
    assert rows(spark.read.parquet(run._staging("rejected_sales")), "order_id", "missing") == [("1", "product_key")]


def test_a_run_without_commit_and_a_late_commit_leave_no_trace(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    dates = frame(spark, SERVING["dim_date"], [dict(date_key="20160101", date="2016-01-01", year=2016)])
    one, two = (warehouse.begin(dt.date(2015, 12, 31), dt.date(2016, 1, 1)) for _ in range(2))
    one.publish("dim_date", dates, F.lit("all"))
    two.publish("dim_date", dates, F.lit("all"))
    assert one.read("dim_date").count() == 1
    assert warehouse.read("dim_date").count() == 0
    one.commit()
    with pytest.raises(Exception, match="(?i)exists"):
        two.commit()
    assert warehouse.read("dim_date").count() == 1


def test_two_commits_at_the_same_time_are_found(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    dates = frame(spark, SERVING["dim_date"], [dict(date_key="20160101", date="2016-01-01", year=2016)])
    one, two = (warehouse.begin(dt.date(2015, 12, 31), dt.date(2016, 1, 1)) for _ in range(2))
    for run in (one, two):
        run.publish("dim_date", dates, F.lit("all"))
    one.commit()
    # What a store does that lets two writers see an empty place: both entries stand side by side.
    entry = spark.read.parquet(f"{tmp_path}/wh/run_log/seq=1")
    entry.withColumn("writer", F.lit("other")).write.mode("append").parquet(f"{tmp_path}/wh/run_log/seq=1")
    with pytest.raises(RuntimeError, match="two runs"):
        warehouse.read("dim_date")


def test_folders_stay_few_and_staging_is_emptied(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    for day in range(1, 11):
        run = warehouse.begin(dt.date(2016, 1, day), dt.date(2016, 1, day + 1))
        dates = frame(spark, SERVING["dim_date"], [dict(date_key=f"201601{day:02}", date=f"2016-01-{day:02}", year=2016)])
        run.publish("dim_date", run.stage("dates", dates), F.lit("all"))
        run.commit()
        run.clear_all()
        assert run.staged("dates", dates.schema).count() == 0
    assert warehouse.read("dim_date").count() == 10
    assert len(warehouse.entries()[1]) <= 8


def test_a_day_not_after_the_last_run_is_refused(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    run_batch(warehouse, tables(spark), dt.date(2016, 1, 10))
    assert warehouse.next_window(dt.date(2016, 1, 12)) == (dt.date(2016, 1, 10), dt.date(2016, 1, 12))
    for day in (5, 10):
        with pytest.raises(ValueError, match="is not after"):
            run_batch(warehouse, tables(spark), dt.date(2016, 1, day))


def test_quality_of_a_run_is_stored(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    lost = {**ORDER, "order_id": "9", "updated_at": None}
    run = run_batch(warehouse, tables(spark, orders=[ORDER, lost]), dt.date(2016, 1, 10))
    found = spark.read.parquet(run._staging("quality"))
    assert rows(found.where("violations > 0"), "table_name", "rule", "violations", "strict") == [("orders", "never extracted", "1", "False")]


def test_late_rows_of_a_stream_are_listed_not_merged(spark, tmp_path):
    product = dict(product_id="p", product_name="n", brand_name="b", category_name="c", model_year=2016, list_price="10", updated_at="2016-01-11", is_active="Y")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    load = dimension_loader(warehouse, "products")
    load(frame(spark, EXTRACT["products"], [product]), 0)
    load(frame(spark, EXTRACT["products"], [{**product, "list_price": "12", "updated_at": "2016-01-05"}]), 1)
    assert rows(warehouse.read("dim_products"), "list_price", "eff_date", "exp_date") == [("10.00", "2016-01-11", "9999-12-31")]


def test_stage_read_back_and_clear(spark, tmp_path):
    run = Warehouse(spark, str(tmp_path / "wh")).begin(dt.date(2015, 12, 31), dt.date(2016, 1, 1))
    dates = frame(spark, STAGING["date"], [dict(date_key="20160101", date="2016-01-01", year=2016)])
    assert rows(run.stage("stg_date", dates)) == rows(dates)
    assert run.stage("empty", dates.limit(0)).count() == 0
    run.clear("stg_date", STAGING["date"])
    assert run.staged("stg_date", STAGING["date"]).count() == 0
    path = run._staging("stg_date")
    assert read_parquet(spark, path, STAGING["date"]).columns == STAGING["date"].names


def test_stream_of_extracts_equals_the_days_in_order(spark, tmp_path):
    product = dict(product_id="p", product_name="n", brand_name="b", category_name="c", model_year=2016, list_price="10", updated_at="2016-01-01", is_active="Y")
    landing, warehouse = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "wh"))
    # A backlog of two days in one micro-batch, then one more day.
    days = [product, {**product, "list_price": "11", "updated_at": "2016-01-02"}]
    frame(spark, EXTRACT["products"], days).write.parquet(landing)
    stream_dimension(warehouse, landing, "products", str(tmp_path / "cp")).awaitTermination()
    last = frame(spark, EXTRACT["products"], [{**product, "list_price": "11", "updated_at": "2016-01-03", "is_active": "N"}])
    last.write.mode("append").parquet(landing)
    stream_dimension(warehouse, landing, "products", str(tmp_path / "cp")).awaitTermination()
    expected = [("1", "10.00", "2016-01-01", "2016-01-01", "N"), ("2", "11.00", "2016-01-02", "2016-01-03", "N")]
    columns = ["product_key", "list_price", "eff_date", "exp_date", "active_flag"]
    assert rows(warehouse.read("dim_products"), *columns) == expected
    # The same micro-batch delivered again is left out.
    dimension_loader(warehouse, "products")(frame(spark, EXTRACT["products"], days), 0)
    assert rows(warehouse.read("dim_products"), *columns) == expected


def test_rows_that_lie_evenly_are_not_moved_to_be_written_by_segment(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    run = warehouse.begin(dt.date(2015, 12, 31), dt.date(2016, 1, 1))
    numbers = spark.range(0, 8, 1, 4)
    dates = numbers.select(*[(F.col("id") if f.name == "date_key" else F.lit(None)).cast(f.dataType).alias(f.name) for f in SERVING["dim_date"].fields])
    run.publish("dim_date", dates, (F.col("date_key").cast("int") % 2).cast("string"), moved=False)
    assert run.segments("dim_date") == ["0", "1"] and rows(run.read("dim_date"), "date_key") == [(str(k),) for k in range(8)]
    assert len(list((tmp_path / "wh").glob("serving/dim_date/*/segment=*/*.parquet"))) == 8  # of each of four tasks, one per segment

    published, publish = {}, Run.publish

    def recording(run, table, *rest, **options):
        published[table] = options.get("moved", True)
        publish(run, table, *rest, **options)

    monkeypatch.setattr(Run, "publish", recording)
    run_batch(warehouse, tables(spark), dt.date(2016, 1, 6))
    assert published["fact_sales"] is False and published["fact_orders"] is True
    assert rows(warehouse.read("fact_sales"), "sales_id", "order_id") == [("1", "1")]
