from decimal import Decimal

import pytest
from frames import day, frame, rows
from pyspark.sql import functions as F

from starloom.operators.staging import repeated_lines, stage_customers, stage_date, stage_products, stage_sales, stage_staffs, stage_stores
from starloom.schemas import EXTRACT, STAGING

CUSTOMER = dict(
    customer_id="1", first_name="A", last_name="B", phone="1", email="e", street="s", city="c", state="NY",
    zip_code="01234", updated_at="2016-01-01", is_active="Y",
)
ORDER = dict(
    order_id="1", customer_id="1", order_status="Completed", order_date="2016-01-01", required_date="2016-01-05",
    shipped_date="2016-01-04", store_id="1", staff_id="1", product_id="1", quantity=3, list_price="3.33",
    discount="0.07", updated_at="2016-01-04",
)


def test_customer_may_lack_contact_but_not_city(spark):
    extract = frame(
        spark,
        EXTRACT["customers"],
        [{**CUSTOMER, "phone": None, "email": None, "street": None}, {**CUSTOMER, "customer_id": "2", "city": None}],
    )
    staged = stage_customers(extract)
    assert staged.columns == STAGING["customers"].names
    assert rows(staged, "customer_id", "phone", "zip_code") == [("1", "None", "01234")]


def test_store_and_staff_need_every_value(spark):
    store = dict(store_id="1", store_name="n", phone="p", email="e", street="s", city="c", state="NY", zip_code="1",
                 updated_at="2016-01-01", is_active="Y")
    stores = frame(spark, EXTRACT["stores"], [store, {**store, "store_id": "2", "email": None}])
    assert rows(stage_stores(stores), "store_id") == [("1",)]
    staff = dict(staff_id="1", first_name="f", last_name="l", email="e", phone="p", manager_id="1",
                 updated_at="2016-01-01", is_active="Y")
    staffs = frame(spark, EXTRACT["staffs"], [staff, {**staff, "staff_id": "2", "manager_id": None}])
    assert rows(stage_staffs(staffs), "staff_id") == [("1",)]


def test_product_quotes_and_repeats(spark):
    product = dict(product_id="1", product_name='A 24" bike', brand_name="b", category_name="c", model_year=2016,
                   list_price="10", updated_at="2016-01-01", is_active="Y")
    extract = frame(
        spark,
        EXTRACT["products"],
        [product, {**product, "list_price": "9"}, {**product, "updated_at": "2016-01-02"}],
    )
    staged = stage_products(extract.repartition(3))
    assert rows(staged, "eff_date", "product_name", "list_price") == [
        ("2016-01-01", "A 24 bike", "9.00"), ("2016-01-02", "A 24 bike", "10.00"),
    ]


def test_measures_round_step_by_step(spark):
    staged = stage_sales(frame(spark, EXTRACT["orders"], [ORDER])).first()
    assert (staged.total_price, staged.discount_amount) == (Decimal("9.99"), Decimal("0.70"))
    assert (staged.total_price_with_discount, staged.discount_percent) == (Decimal("9.29"), 7)
    assert (staged.order_date, staged.shipped_date, staged.rejected_date) == ("20160101", "20160104", None)


def test_rejected_date_and_null_rules(spark):
    orders = frame(
        spark,
        EXTRACT["orders"],
        [
            {**ORDER, "order_id": "1", "order_status": "Rejected", "shipped_date": None, "updated_at": "2016-01-06"},
            {**ORDER, "order_id": "2", "order_status": "Pending", "shipped_date": None},
            {**ORDER, "order_id": "3", "discount": None},
        ],
    )
    assert rows(stage_sales(orders), "order_id", "rejected_date") == [("1", "20160106"), ("2", "None")]


def test_repeated_product_first_or_sum(spark):
    lines = [ORDER, {**ORDER, "quantity": 1}, {**ORDER, "product_id": "2"}]
    orders = frame(spark, EXTRACT["orders"], lines).repartition(3)
    assert rows(stage_sales(orders), "product_id", "quantity") == [("1", "1"), ("2", "3")]
    summed = stage_sales(orders, repeated="sum")
    assert summed.schema.names == STAGING["sales"].names
    assert rows(summed, "product_id", "quantity", "total_price", "discount_percent") == [
        ("1", "4", "13.32", "7"), ("2", "3", "9.99", "7"),
    ]
    with pytest.raises(ValueError):
        stage_sales(orders, repeated="last")


def test_only_repeated_lines_are_compared(spark, tmp_path):
    lines = [{**ORDER, "order_id": str(k)} for k in range(50)]
    lines += [{**ORDER, "order_id": "7", "quantity": 1}, {**ORDER, "order_id": "7", "quantity": 2}, {**ORDER, "order_id": "8", "discount": None}]
    lines += [{**ORDER, "order_id": None}, {**ORDER, "order_id": None}, ORDER | {"order_id": "9"}]
    orders = frame(spark, EXTRACT["orders"], lines).repartition(3)
    repeated_lines(orders).write.parquet(str(tmp_path / "several"))
    several = spark.read.parquet(str(tmp_path / "several"))
    # A line that is left out for a missing value repeats nothing.
    assert rows(several, "order_id") == [("7",), ("9",)]
    staged = stage_sales(orders, several=several)
    assert staged.schema.names == STAGING["sales"].names and rows(staged) == rows(stage_sales(orders))
    assert staged.count() == 50 and rows(staged.filter("order_id = '7'"), "quantity") == [("1",)]
    by_day = orders.withColumn("run_date", F.when(F.col("quantity") == 1, F.lit("2016-01-02")).otherwise(F.lit("2016-01-01")).cast("date"))
    days = repeated_lines(by_day, ["run_date"])
    assert rows(stage_sales(by_day, by=["run_date"], several=days)) == rows(stage_sales(by_day, by=["run_date"]))


def test_dates(spark):
    orders = frame(
        spark,
        EXTRACT["orders"],
        [
            {**ORDER, "order_date": "2016-01-01", "required_date": "2016-02-29", "shipped_date": None, "updated_at": "2016-01-01"},
            {**ORDER, "order_date": "2018-12-31", "required_date": "2018-12-31", "shipped_date": "2018-12-31", "updated_at": "2018-12-31"},
        ],
    )
    staged = stage_date(orders)
    assert staged.columns == STAGING["date"].names
    assert [tuple(r) for r in staged.orderBy("date").collect()] == [
        ("20160101", day("2016-01-01"), 2016, 1, 1, 1, "Friday", "January", 53),
        ("20160229", day("2016-02-29"), 2016, 2, 29, 1, "Monday", "February", 9),
        ("20181231", day("2018-12-31"), 2018, 12, 31, 4, "Monday", "December", 1),
    ]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    made = {
        "order_id": F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.col("id").cast("string")),
        "quantity": (F.col("id") % 50 + 1).cast("int"),
    }
    orders = spark.range(100_000).select(
        *[made.get(f.name, F.lit(ORDER.get(f.name))).cast(f.dataType).alias(f.name) for f in EXTRACT["orders"].fields]
    )
    staged = stage_sales(orders)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning"))
    assert "Partial" in plan[partial:].splitlines()[0]
    assert staged.count() == 10_001
    assert rows(staged.filter("order_id = 'hot'"), "quantity") == [("1",)]
