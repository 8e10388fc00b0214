from decimal import Decimal

from frames import frame, rows

from starloom.operators import reports
from starloom.operators.quality import column_violations, duplicate_keys, orphan_keys, rekey_children, retain_children
from starloom.operators.reports import staff_chains
from starloom.plans.checks import follow_renames, refused_renames
from starloom.schemas import OPERATIONAL, SERVING, STAGING, warehouse_lengths


def sale(order, product=1, store=1, shipped=None, required="20160605", revenue="10", units=1, date="20160601"):
    return dict(sales_id=1, order_id=order, product_key=product, customer_key=1, store_key=store, staff_key=1, order_date=date,
                required_date=required, shipped_date=shipped, order_status_id=1, quantity=units, total_price_with_discount=revenue)


def test_versions_of_one_product_count_as_one(spark):
    product = dict(product_id="p", brand_name="b", eff_date="2016-01-01", exp_date="2016-01-31", active_flag="N")
    products = frame(
        spark, SERVING["dim_products"],
        [
            {**product, "product_key": 1, "product_name": "old"},
            {**product, "product_key": 2, "product_name": "new", "eff_date": "2016-02-01", "brand_name": "c"},
            {**product, "product_key": 3, "product_id": "q", "product_name": "q"},
            {**product, "product_key": 4, "product_id": "unsold", "product_name": "u"},
        ],
    )
    fact = frame(spark, SERVING["fact_sales"], [sale("1", 1), sale("1", 2, revenue="5", units=9), sale("2", 3, revenue="12")])
    assert [tuple(r) for r in reports.top_products(fact, products, 1).collect()] == [("p", "new", "c", Decimal("15.00"), 10)]
    assert [r.product_id for r in reports.top_products(fact, products, 1, by="units").collect()] == ["p"]
    assert rows(reports.unsold_products(fact, products), "product_id") == [("unsold",)]
    assert rows(reports.brand_ranking(fact, products), "brand_name", "revenue", "revenue_rank", "units_rank") == [
        ("b", "22.00", "1", "2"), ("c", "5.00", "2", "1"),
    ]


def test_late_orders_count_once(spark):
    stores = frame(spark, SERVING["dim_stores"], [dict(store_key=k, store_id="s", store_name=f"n{k}", eff_date=f"2016-0{k}-01", exp_date="2016-12-31") for k in (1, 2)])
    fact = frame(
        spark, SERVING["fact_sales"],
        [sale("1", shipped="20160606"), sale("1", 2, shipped="20160606"), sale("2", shipped="20160605"), sale("3"), sale("4", store=2, shipped="20160604")],
    )
    assert [tuple(r) for r in reports.late_delivery_by_store(fact, stores).collect()] == [("s", "n2", 4, 3, 1, 0.3333)]


def test_monthly_trend(spark):
    date = dict(date="2016-06-01", day=1, quarter=2, day_of_week="x", week_of_year=1)
    dates = frame(spark, SERVING["dim_date"], [{**date, "date_key": f"20160{m}01", "year": 2016, "month": m, "month_name": str(m)} for m in (6, 7)])
    fact = frame(spark, SERVING["fact_sales"], [sale("1"), sale("1", 2), sale("2", date="20160701", revenue="4")])
    trend = reports.sales_monthly_trend(fact, dates)
    assert rows(trend, "month", "revenue", "orders", "units", "revenue_change", "revenue_rank") == [
        ("6", "20.00", "1", "2", "None", "1"), ("7", "4.00", "1", "1", "-16.00", "2"),
    ]


def test_quality(spark):
    staff = dict(staff_id="1", first_name="f", last_name="l", email="e", store_id="s", manager_id="9")
    staffs = frame(spark, OPERATIONAL["staffs"], [staff, {**staff, "staff_id": "2", "manager_id": None, "phone": "1" * 26}, {**staff, "staff_id": "2"}])
    assert rows(duplicate_keys(staffs, ["staff_id"])) == [("2", "2")]
    assert rows(duplicate_keys(staffs, ["email"])) == [("e", "3")]
    assert rows(orphan_keys(staffs, "manager_id", staffs, "staff_id")) == [("9", "2")]
    assert rows(column_violations(staffs, ["staff_id", "manager_id"], {"phone": 25, "email": 255})) == [
        ("email", "length", "0"), ("manager_id", "not null", "1"), ("phone", "length", "1"), ("staff_id", "not null", "0"),
    ]
    assert warehouse_lengths(STAGING["customers"])["phone"] == 15


def test_cascades(spark):
    items = frame(spark, OPERATIONAL["order_items"], [("1", 1, "p", 1, "1", "0"), ("2", 1, "q", 1, "1", "0")])
    orders = frame(spark, OPERATIONAL["orders"], [dict(order_id="1")])
    assert rows(retain_children(items, "order_id", orders, "order_id"), "order_id") == [("1",)]
    renamed = spark.createDataFrame([("p", "pp")], "old_key string, new_key string")
    assert rows(rekey_children(items, "product_id", renamed), "product_id") == [("pp",), ("q",)]


def test_staff_managers(spark):
    staffs = frame(spark, OPERATIONAL["staffs"], [dict(staff_id=i, first_name=f"n{i}", manager_id=m) for i, m in (("1", "1"), ("2", "1"), ("3", "9"))])
    assert rows(reports.staff_managers(staffs), "staff_id", "manager_first_name") == [("1", "n1"), ("2", "n1"), ("3", "None")]


def test_chains_of_managers_with_a_cycle_and_loose_ends(spark):
    staff = [("a", "b"), ("b", "c"), ("c", "b"), ("d", "gone"), ("e", None), (None, "a"), ("f", "f"), ("g", "d")]
    table = spark.createDataFrame(staff, "staff_id string, manager_id string")
    found = rows(staff_chains(table), "staff_id", "level", "manager_id", "path", "is_cycle")
    wanted = []
    for start, first in staff:
        way, manager, level = [start], first, 1
        while start and manager:
            wanted.append((start, str(level), manager, ">".join([*way, manager]), str(manager in way)))
            if manager in way:
                break
            way.append(manager)
            manager, level = dict(staff).get(manager), level + 1
    assert found == sorted(wanted)


def renamed_tables(spark):
    make = lambda schema, *data: spark.createDataFrame(list(data), schema)
    audit = "is_active string"
    return {
        "stores": make(f"store_id string, {audit}", ("s1", "Y"), ("s2", "Y"), ("s3", "Y")),
        "staffs": make("staff_id string, store_id string, manager_id string", ("f1", "s1", None), ("f2", "s2", "f1")),
        "products": make("product_id string, brand_id int, category_id int", ("p1", 1, 1), ("p2", 2, 1)),
        "brands": make("brand_id int", (1,), (2,)),
        "orders": make("order_id string, customer_id string, order_status_id int, store_id string, staff_id string", ("1", "c", 3, "s1", "f2"), ("2", "c", 1, "s3", "f2"), ("3", "c", 1, None, "f2")),
        "order_items": make("order_id string, item_id int, product_id string", ("1", 1, "p1"), ("1", 2, "p2"), ("2", 1, "p1")),
        "stocks": make("store_id string, product_id string", ("s1", "p1"), ("s2", "p2")),
    }


def test_renamed_keys_reach_all_references_at_once(spark):
    tables = renamed_tables(spark)
    renames = lambda kind, *pairs: spark.createDataFrame(list(pairs), f"old_key {kind}, new_key {kind}")
    wanted = {
        "stores": renames("string", ("s1", "s2"), ("s2", "S2"), ("s3", "S3"), (None, "x"), ("s9", "y")),
        "products": renames("string", ("p1", "P1"), ("p2", "Q"), ("p2", "R"), ("p1", "P1")),
        "brands": renames("int", (1, 10), (2, 10)),
        "orders": renames("string", ("1", "one")),
        "staffs": renames("string", ("f1", "F1"), ("f2", "F2")),
    }
    refused = rows(refused_renames(tables, wanted), "table_name", "old_key", "new_key", "reason")
    assert refused == sorted([
        ("stores", "s1", "s2", "taken"), ("stores", "None", "x", "no key"), ("stores", "s9", "y", "not there"), ("products", "p1", "P1", "repeated"),
        ("products", "p2", "Q", "repeated"), ("products", "p2", "R", "repeated"), ("brands", "1", "10", "repeated"), ("brands", "2", "10", "repeated"),
        ("staffs", "f1", "F1", "referenced"), ("staffs", "f2", "F2", "referenced"),
    ])
    out = follow_renames(tables, {**wanted, "products": renames("string", ("p1", "P1"))})
    assert rows(out["stores"], "store_id") == [("S2",), ("S3",), ("s1",)]
    assert rows(out["staffs"], "staff_id", "store_id", "manager_id") == [("f1", "s1", "None"), ("f2", "S2", "f1")]
    assert rows(out["products"], "product_id", "brand_id") == [("P1", "1"), ("p2", "2")]
    assert rows(out["orders"], "order_id", "store_id") == [("2", "S3"), ("3", "None"), ("one", "s1")]
    assert rows(out["order_items"]) == [("2", "1", "P1"), ("one", "1", "P1"), ("one", "2", "p2")]
    assert rows(out["stocks"]) == [("S2", "p2"), ("s1", "P1")]
    assert {n: t.columns for n, t in out.items()} == {n: t.columns for n, t in tables.items()}
