from frames import frame, rows
from pyspark.sql import functions as F

from starloom.operators.fact import compared_orders, keyed_sales, new_fact_rows, orders_of, rejected_rows, update_fact, update_orders
from starloom.operators.rows import literal_rows
from starloom.operators.versions import version_on
from starloom.schemas import DIMENSIONS, OPERATIONAL, ORDER_STATUSES, SERVING, STAGING

SALE = dict(
    order_id="1", product_id="p", customer_id="c", store_id="s", staff_id="f", order_date="20160601",
    required_date="20160605", shipped_date=None, rejected_date=None, order_status="Pending", quantity=1,
    discount_percent=5, discount_amount="0.50", total_price="10.00", total_price_with_discount="9.50",
)


def versions(spark, name, *spans):
    dim = DIMENSIONS[name]
    made = [{dim.id: i, dim.key: k, "eff_date": a, "exp_date": b, "active_flag": "Y"} for i, k, a, b in spans]
    return frame(spark, dim.schema, made)


def star(spark, **overrides):
    ever = ("2016-01-01", "9999-12-31")
    ids = dict(customers="c", stores="s", staffs="f", products="p")
    return {n: overrides.get(n) or versions(spark, n, (i, 1, *ever)) for n, i in ids.items()}


def statuses(spark):
    return frame(spark, OPERATIONAL["order_status"], ORDER_STATUSES)


def compared(spark, staged, known=None):
    known = literal_rows(spark, SERVING["fact_orders"]) if known is None else known
    return compared_orders(staged, known, statuses(spark))


def test_version_bounds_are_inclusive(spark):
    dims = star(spark, customers=versions(spark, "customers", ("c", 1, "2016-01-10", "2016-01-19"), ("c", 2, "2016-01-20", "2016-01-20")))
    dates = ["20160109", "20160110", "20160119", "20160120", "20160121"]
    staged = frame(spark, STAGING["sales"], [{**SALE, "order_id": d, "order_date": d} for d in dates])
    keyed = keyed_sales(staged, compared(spark, staged), dims, statuses(spark))
    assert rows(new_fact_rows(keyed), "order_id", "customer_key") == [
        ("20160110", "1"), ("20160119", "1"), ("20160120", "2"),
    ]
    assert rows(rejected_rows(keyed), "order_id", "missing") == [
        ("20160109", "customer_key"), ("20160121", "customer_key"),
    ]


def test_known_orders_get_no_further_lines(spark):
    dims = star(spark, products=versions(spark, "products", ("p", 1, "2016-01-01", "9999-12-31"), ("q", 2, "2016-01-01", "9999-12-31")))
    sale = frame(spark, STAGING["sales"], [SALE])
    first = new_fact_rows(keyed_sales(sale, compared(spark, sale), dims, statuses(spark)))
    staged = frame(spark, STAGING["sales"], [SALE, {**SALE, "product_id": "q"}, {**SALE, "order_id": "2"}])
    again = new_fact_rows(keyed_sales(staged, compared(spark, staged, orders_of(first)), dims, statuses(spark)))
    assert rows(again, "order_id", "product_key") == [("2", "1")]


def fact_row(order, status=1, shipped=None, rejected=None, product=1):
    return dict(sales_id=product, order_id=order, product_key=product, customer_key=1, store_key=1, staff_key=1,
                order_date="20160601", required_date="20160605", shipped_date=shipped, rejected_date=rejected,
                order_status_id=status, quantity=1, discount_percent=0, discount_amount="0", total_price="1",
                total_price_with_discount="1")


def test_update_needs_a_moved_date(spark):
    fact = frame(
        spark, SERVING["fact_sales"],
        [fact_row("shipped"), fact_row("shipped", product=2), fact_row("status"), fact_row("back", 3, "20160603"), fact_row("other")],
    )
    staged = frame(
        spark, STAGING["sales"],
        [
            {**SALE, "order_id": "shipped", "order_status": "Completed", "shipped_date": "20160604"},
            {**SALE, "order_id": "shipped", "product_id": "q", "order_status": "Completed", "shipped_date": "20160604"},
            {**SALE, "order_id": "status", "order_status": "Completed"},
            {**SALE, "order_id": "back"},
        ],
    )
    known = orders_of(fact)
    assert known.count() == 4
    updates = compared(spark, staged, known)
    assert updates.count() == 3
    assert rows(update_fact(fact, updates), "order_id", "product_key", "shipped_date", "order_status_id") == [
        ("back", "1", "None", "1"), ("other", "1", "None", "1"), ("shipped", "1", "20160604", "3"),
        ("shipped", "2", "20160604", "3"), ("status", "1", "None", "1"),
    ]
    assert rows(updates.where("moved"), "order_id", "known_date") == [("back", "20160601"), ("shipped", "20160601")]
    assert rows(update_orders(known, updates), "order_id", "shipped_date") == [
        ("back", "None"), ("other", "None"), ("shipped", "20160604"), ("status", "None"),
    ]


def test_a_hot_id_is_split_and_no_row_is_lost(spark):
    dim = DIMENSIONS["customers"]
    dims = versions(spark, "customers", *[(str(i), i * 10 + j, f"201{j}-01-01", f"201{j}-12-31") for i in range(20) for j in range(3)])
    facts = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 25).cast("string")).alias("customer_id"),
        F.date_add(F.lit("2010-01-01").cast("date"), (F.col("id") % 1200).cast("int")).alias("on"),
    )
    broadcast = version_on(facts, dims, dim, "on", "left").groupBy(dim.key).count()
    expected = rows(broadcast)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(version_on(facts, dims, dim, "on", "left").groupBy(dim.key).count()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
