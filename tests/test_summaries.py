import datetime as dt

import pytest
from frames import frame, rows
from test_daily import ITEM, ORDER, PRODUCT, STORE, tables
from test_reports import sale

from starloom.operators import reports, summaries
from starloom.plans.daily import run_batch
from starloom.plans.summaries import refresh_summaries, summarised_entry, touched_months
from starloom.schemas import SERVING
from starloom.sources.warehouse import Warehouse


def facts(spark):
    return frame(
        spark, SERVING["fact_sales"],
        [
            sale("1", 1), sale("1", 2, revenue="5", units=9), sale("1", 2, revenue="5", units=9), sale("2", 2, 2, shipped="20160606"),
            sale("3", 1, 1, date="20160701", required="20160705", shipped="20160705"), sale("4", 3, 1, date="20160701", required="20160705", shipped="20160706"),
        ],
    )


def test_summaries_by_hand(spark):
    found = rows(summaries.sales_summary(facts(spark)), "grain", "key", "month", "revenue", "units")
    assert found == sorted([
        ("products", "1", "201606", "10.00", "1"), ("products", "2", "201606", "20.00", "19"), ("products", "1", "201607", "10.00", "1"),
        ("products", "3", "201607", "10.00", "1"), ("customers", "1", "201606", "30.00", "20"), ("customers", "1", "201607", "20.00", "2"),
        ("stores", "1", "201606", "20.00", "19"), ("stores", "2", "201606", "10.00", "1"), ("stores", "1", "201607", "20.00", "2"),
    ])
    counted = rows(summaries.order_summary(facts(spark)), "grain", "key", "month", "orders", "shipped_orders", "late_orders")
    assert counted == sorted([
        ("stores", "1", "201606", "1", "0", "0"), ("stores", "2", "201606", "1", "1", "1"), ("stores", "1", "201607", "2", "2", "1"),
        ("months", "None", "201606", "2", "1", "1"), ("months", "None", "201607", "2", "2", "1"),
    ])


def test_an_order_in_two_versions_of_a_store_is_one_of_its_month(spark):
    fact = frame(spark, SERVING["fact_sales"], [sale("1", store=1), sale("1", 2, store=2)])
    found = rows(summaries.order_summary(fact), "grain", "key", "orders")
    assert found == [("months", "None", "1"), ("stores", "1", "1"), ("stores", "2", "1")]


def test_empty_fact(spark):
    none = facts(spark).limit(0)
    assert summaries.sales_summary(none).schema.names == SERVING["sales_summary"].names and summaries.sales_summary(none).count() == 0
    assert summaries.order_summary(none).schema.names == SERVING["order_summary"].names and summaries.order_summary(none).count() == 0


@pytest.mark.parametrize("report", [reports.top_products, reports.brand_ranking, reports.unsold_products])
def test_reports_take_a_summary_for_the_fact(spark, report):
    product = dict(brand_name="b", eff_date="2016-01-01", exp_date="9999-12-31", active_flag="Y")
    products = frame(spark, SERVING["dim_products"], [{**product, "product_key": k, "product_id": f"p{k}", "product_name": f"n{k}"} for k in (1, 2, 3, 4)])
    fact = facts(spark)
    summed = summaries.as_fact(summaries.sales_summary(fact), "products")
    assert rows(report(summed, products)) == rows(report(fact, products))
    june = summaries.as_fact(summaries.sales_summary(fact), "products", ["201606"])
    assert rows(report(june, products)) == rows(report(fact.where("order_date < '20160701'"), products))


def test_only_touched_months_are_computed_anew(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    feb = {**ORDER, "order_id": "2", "order_date": "2016-02-05", "required_date": "2016-02-08", "updated_at": "2016-02-05"}
    items = [ITEM, {**ITEM, "order_id": "2"}, {**ITEM, "order_id": "3"}]
    run_batch(warehouse, tables(spark, orders=[ORDER, feb], order_items=items), dt.date(2016, 2, 6))
    assert summarised_entry(warehouse) == 0
    assert refresh_summaries(warehouse) == ["201601", "201602"]
    assert refresh_summaries(warehouse) == []  # nothing to do, and no new entry in the log
    assert warehouse.entries()[0] == 2 and summarised_entry(warehouse) == 1

    def folders(table):
        return {(e.segment, e.folder) for e in warehouse.entries()[1] if e.table == table}

    first = {t: folders(t) for t in ("sales_summary", "order_summary")}
    # The order of February ships late, one of March comes; January stays.
    shipped = {**feb, "order_status_id": 3, "shipped_date": "2016-02-09", "updated_at": "2016-02-09"}
    march = {**ORDER, "order_id": "3", "order_date": "2016-03-01", "updated_at": "2016-03-01"}
    changed = [{**STORE, "store_name": "renamed", "updated_at": "2016-02-10"}]
    run_batch(warehouse, tables(spark, orders=[ORDER, shipped, march], order_items=items, stores=changed), dt.date(2016, 3, 2))
    assert touched_months(warehouse, 1, 3) == ["201602", "201603"]
    # Daily runs carry the summaries along, and they still show the state before.
    assert {t: folders(t) for t in first} == first
    assert refresh_summaries(warehouse) == ["201602", "201603"]
    for table, before in first.items():
        assert sorted(s for s, _ in before & folders(table)) == ["201601"]
        assert sorted(s for s, _ in folders(table) - before) == ["201602", "201603"]

    fact, sales, orders = (warehouse.read(t) for t in ("fact_sales", "sales_summary", "order_summary"))
    assert rows(sales) == rows(summaries.sales_summary(fact))
    assert rows(orders) == rows(summaries.order_summary(fact))
    dates, stores, products = (warehouse.read(t) for t in ("dim_date", "dim_stores", "dim_products"))
    assert rows(summaries.sales_monthly_trend(sales, orders, dates)) == rows(reports.sales_monthly_trend(fact, dates))
    late = summaries.late_delivery_by_store(orders, stores)
    assert rows(late) == rows(reports.late_delivery_by_store(fact, stores))
    assert rows(late, "store_name", "orders", "shipped_orders", "late_orders") == [("renamed", "3", "1", "1")]
    best = summaries.as_fact(sales, "stores")
    assert rows(reports.store_performance(best, stores)) == rows(reports.store_performance(fact, stores))
    # Earlier states can be summarised again, and the next daily run starts from its own last one.
    assert refresh_summaries(warehouse, seq=1) == ["201602", "201603"]
    assert rows(warehouse.read("sales_summary")) == rows(summaries.sales_summary(warehouse.read("fact_sales", seq=1)))
    run = run_batch(warehouse, tables(spark, products=[{**PRODUCT, "updated_at": "2016-03-03"}], orders=[ORDER, shipped, march], order_items=items), dt.date(2016, 3, 4))
    assert run.previous == dt.date(2016, 3, 2)
