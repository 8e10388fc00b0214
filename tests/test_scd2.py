"""The merge against a row-by-row model of its three steps: insert, expire, delete."""

import datetime as dt

import pytest
from frames import day, frame, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starloom.operators.keys import assign_keys
from starloom.operators.scd2 import append_dates, scd2_merge, scd2_rewrite
from starloom.schemas import DIMENSIONS, SERVING, STAGING

END = dt.date(9999, 12, 31)
CUSTOMERS, PRODUCTS = DIMENSIONS["customers"], DIMENSIONS["products"]


def model(current, batch, dim, reactivate=False):
    """One statement after the other, on dicts. ``batch`` holds one row per id."""

    def differs(d, s):
        for c in dim.tracked:
            a, b = d[c], s[c]
            if c in dim.null_as_empty:
                a, b = a or "", b or ""
            if a is not None and b is not None and a != b:
                return True
        return False

    after = [dict(d) for d in current]
    for s in batch:
        mine = [d for d in current if d[dim.id] == s[dim.id]]
        open_ones = [d for d in mine if d["active_flag"] == "Y"]
        fresh = not (open_ones if reactivate else mine)
        if fresh or any(differs(d, s) for d in open_ones):
            after.append({**{c: s[c] for c in (dim.id, *dim.tracked, "eff_date")}, "exp_date": END, "active_flag": "Y"})
    for s in batch:
        for d in after:
            if d[dim.id] == s[dim.id] and d["active_flag"] == "Y" and differs(d, s):
                d["exp_date"], d["active_flag"] = s["eff_date"] - dt.timedelta(1), "N"
    for s in batch:
        for d in after:
            if d[dim.id] == s[dim.id] and d["active_flag"] == "Y" and s["active_flag"] == "N":
                d["exp_date"], d["active_flag"] = s["eff_date"], "N"
    return after


def as_rows(dicts, columns):
    return sorted(tuple(str(d[c]) for c in columns) for d in dicts)


BASE = dict(first_name="A", last_name="B", phone="1", email="e", street="s", city="c", state="NY", zip_code="1")


def version(i, eff="2016-01-01", exp="9999-12-31", flag="Y", **changed):
    return {**BASE, "customer_id": i, "customer_key": None, "eff_date": eff, "exp_date": exp, "active_flag": flag, **changed}


def staged(i, flag="Y", eff="2016-06-01", **changed):
    return {**BASE, "customer_id": i, "eff_date": eff, "active_flag": flag, **changed}


def test_every_case(spark):
    current = [version(i) for i in ("same", "changed", "deleted", "both", "none")]
    current += [version("closed", exp="2016-03-01", flag="N"), version("closed_none", exp="2016-03-01", flag="N")]
    current += [version("null_empty", phone=None), version("null_city", city=None)]
    batch = [
        staged("same"), staged("changed", city="d"), staged("deleted", "N"), staged("both", "N", city="d"),
        staged("closed", city="d"), staged("new"), staged("new_deleted", "N"),
        staged("null_empty", phone=""), staged("null_city", city="d"),
    ]
    merged = scd2_merge(frame(spark, CUSTOMERS.schema, current), frame(spark, STAGING["customers"], batch), CUSTOMERS)
    assert rows(merged, "customer_id", "eff_date", "exp_date", "active_flag") == sorted(
        [
            ("same", "2016-01-01", "9999-12-31", "Y"),
            ("changed", "2016-01-01", "2016-05-31", "N"),
            ("changed", "2016-06-01", "9999-12-31", "Y"),
            ("deleted", "2016-01-01", "2016-06-01", "N"),
            ("both", "2016-01-01", "2016-05-31", "N"),
            ("both", "2016-06-01", "2016-06-01", "N"),
            ("none", "2016-01-01", "9999-12-31", "Y"),
            ("closed", "2016-01-01", "2016-03-01", "N"),
            ("closed_none", "2016-01-01", "2016-03-01", "N"),
            ("new", "2016-06-01", "9999-12-31", "Y"),
            ("new_deleted", "2016-06-01", "2016-06-01", "N"),
            ("null_empty", "2016-01-01", "9999-12-31", "Y"),
            ("null_city", "2016-01-01", "9999-12-31", "Y"),
        ]
    )


def test_latest_of_two_versions_and_same_day_update(spark):
    current = frame(spark, CUSTOMERS.schema, [version("a"), version("b", eff="2016-06-01")])
    batch = [staged("a", city="d", eff="2016-05-01"), staged("a", city="e", eff="2016-06-01"), staged("b", city="d")]
    merged = scd2_merge(current, frame(spark, STAGING["customers"], batch), CUSTOMERS)
    assert rows(merged, "customer_id", "city", "eff_date", "exp_date") == [
        ("a", "c", "2016-01-01", "2016-05-31"), ("a", "e", "2016-06-01", "9999-12-31"),
        ("b", "c", "2016-06-01", "2016-05-31"), ("b", "d", "2016-06-01", "9999-12-31"),
    ]


def test_reactivate(spark):
    current = frame(spark, CUSTOMERS.schema, [version("closed", exp="2016-03-01", flag="N")])
    batch = frame(spark, STAGING["customers"], [staged("closed")])
    assert scd2_merge(current, batch, CUSTOMERS).count() == 1
    assert scd2_merge(current, batch, CUSTOMERS, reactivate=True).filter("active_flag = 'Y'").count() == 1


names = st.sampled_from(["x", "y", None, ""])
history = st.lists(
    st.tuples(
        st.sampled_from(["none", "open", "closed", "closed+open"]),  # what the dimension holds
        names, names, names, names,  # phone and city, there and in the batch
        st.sampled_from([None, "Y", "N"]),  # the batch row's flag, if there is one
    ),
    min_size=1,
    max_size=120,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(history=history, reactivate=st.booleans())
def test_against_model(spark, history, reactivate):
    current, batch = [], []
    for i, (held, phone, city, new_phone, new_city, flag) in enumerate(history):
        if "closed" in held:
            current.append(version(str(i), eff="2015-01-01", exp="2015-12-31", flag="N", phone=phone, city=city))
        if "open" in held:
            current.append(version(str(i), phone=phone, city=city))
        if flag:
            batch.append(staged(str(i), flag, phone=new_phone, city=new_city))
    columns = ["customer_id", *CUSTOMERS.tracked, "eff_date", "exp_date", "active_flag"]
    dim, stg = frame(spark, CUSTOMERS.schema, current), frame(spark, STAGING["customers"], batch)
    merged = scd2_merge(dim, stg, CUSTOMERS, reactivate)
    dated = [{**d, "eff_date": day(d["eff_date"]), "exp_date": day(d["exp_date"])} for d in current]
    expected = model(dated, [{**s, "eff_date": day(s["eff_date"])} for s in batch], CUSTOMERS, reactivate)
    got = rows(merged, *columns)
    assert got == as_rows(expected, columns)
    open_ids = [r[0] for r in got if r[-1] == "Y"]
    assert len(open_ids) == len(set(open_ids))
    if not reactivate:  # the same batch again changes nothing
        assert rows(scd2_merge(merged, stg, CUSTOMERS), *columns) == got


def test_keys_are_dense_stable_and_follow_the_ones_in_use(spark):
    current = frame(spark, CUSTOMERS.schema, [{**version("a"), "customer_key": 7}, {**version("b"), "customer_key": 9}])
    batch = frame(spark, STAGING["customers"], [staged(f"n{i}") for i in range(500)] + [staged("a", city="d")])
    merged = scd2_rewrite(current, batch, CUSTOMERS)
    keys = [assign_keys(merged.repartition(n), "customer_key", ["customer_id", "eff_date"], 9) for n in (1, 7)]
    first, second = (rows(k, "customer_id", "eff_date", "customer_key") for k in keys)
    assert first == second
    numbers = sorted(int(r[2]) for r in first)
    assert numbers == [7, 9, *range(10, 10 + 501)]


def test_keys_of_an_empty_and_a_first_batch(spark):
    rows_ = frame(spark, CUSTOMERS.schema, [version("a"), version("b")])
    assert sorted(r.customer_key for r in assign_keys(rows_, "customer_key", ["customer_id"]).collect()) == [1, 2]
    none = rows_.limit(0)
    assert assign_keys(none, "customer_key", ["customer_id"], 5).count() == 0


def test_append_dates(spark):
    one = dict(date_key="20160101", date="2016-01-01", year=2016, month=1, day=1, quarter=1, day_of_week="Friday",
               month_name="January", week_of_year=53)
    have = frame(spark, SERVING["dim_date"], [one])
    stg = frame(spark, STAGING["date"], [one, {**one, "date_key": "20160102", "date": "2016-01-02"}])
    assert rows(append_dates(have, stg), "date_key") == [("20160102",)]


@pytest.mark.parametrize("size", ["0", "100MB"])
def test_broadcast_and_shuffle_give_the_same(spark, size):
    current = frame(spark, CUSTOMERS.schema, [version(str(i)) for i in range(50)])
    batch = frame(spark, STAGING["customers"], [staged(str(i), city="cd"[i % 2]) for i in range(20, 80)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    try:
        merged = scd2_merge(current, batch, CUSTOMERS)
        assert merged.count() == 50 + 30 + 15
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
