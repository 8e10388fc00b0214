"""Set-based changes against a replay one change at a time."""

import random

from frames import frame, rows
from pyspark.sql import types as T

from starloom.operators.cdc import apply_batch, apply_changes, apply_order_changes, later_changes, register_changes, soft_delete
from starloom.operators.rows import literal_rows
from starloom.schemas import OPERATIONAL

TODAY = "2020-05-05"
CATEGORY_LIKE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("customer_id", "city")]
    + [T.StructField("created_at", T.DateType()), T.StructField("updated_at", T.DateType()), T.StructField("is_active", T.StringType())]
)
CHANGE = T.StructType(
    [T.StructField("customer_id", T.StringType()), T.StructField("op", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("city", T.StringType())]
)


def replay(current, changes):
    """Insert, update and delete with audit stamps, in the order of ``seq``."""
    table = {r["customer_id"]: dict(r) for r in current}
    for key, op, _, city in sorted(changes, key=lambda c: c[2]):
        if op == "I" and key not in table:
            table[key] = dict(customer_id=key, city=city, created_at=TODAY, updated_at=TODAY, is_active="Y")
        elif op == "U" and key in table:
            table[key].update(city=city, updated_at=TODAY)
        elif op == "D" and key in table:
            table[key].update(is_active="N", updated_at=TODAY)
    return table


def test_changes_equal_a_replay(spark):
    pick = random.Random(7)
    current = [
        dict(customer_id=str(i), city=f"c{i}", created_at="2016-01-01", updated_at="2016-01-01", is_active=pick.choice("YN"))
        for i in range(60)
    ]
    # Few ids, many changes; one id has a third of them.
    changes = [
        ("5" if pick.random() < 0.33 else str(pick.randrange(120)), pick.choice("IUUD"), n, pick.choice(["x", "y", None]))
        for n in range(400)
    ]
    got = apply_changes(frame(spark, CATEGORY_LIKE, current), frame(spark, CHANGE, changes).repartition(5), "customer_id", TODAY)
    expected = replay(current, changes)
    assert rows(got) == sorted(tuple(str(r[c]) for c in CATEGORY_LIKE.names) for r in expected.values())


def test_soft_delete(spark):
    current = [dict(customer_id=i, city="c", created_at="2016-01-01", updated_at="2016-01-01", is_active="Y") for i in "ab"]
    gone = frame(spark, CHANGE, [("a", "D", 1, None), ("a", "D", 2, None), ("z", "D", 3, None)])
    got = soft_delete(frame(spark, CATEGORY_LIKE, current), gone, "customer_id", TODAY)
    assert rows(got, "customer_id", "updated_at", "is_active") == [("a", TODAY, "N"), ("b", "2016-01-01", "Y")]


def test_order_changes_equal_a_replay(spark):
    pick = random.Random(11)
    schema = OPERATIONAL["orders"]
    order = dict(customer_id="1", order_status_id=1, order_date="2016-01-01", required_date="2016-01-05", store_id="1", staff_id="1")
    current = [{**order, "order_id": str(i), "updated_at": "2016-01-01"} for i in range(40)]
    changes = [
        {**order, "order_id": "3" if pick.random() < 0.33 else str(pick.randrange(80)), "op": pick.choice("IUUD"), "seq": n, "order_status_id": pick.randrange(1, 4)}
        for n in range(300)
    ]
    table = {o["order_id"]: (o["order_status_id"], o["updated_at"]) for o in current}
    for c in changes:
        key = c["order_id"]
        if c["op"] == "D":
            table.pop(key, None)
        elif (c["op"] == "I") != (key in table):
            table[key] = (c["order_status_id"], TODAY)
    change_schema = T.StructType(
        [f for f in schema.fields if f.name != "updated_at"] + [T.StructField("op", T.StringType()), T.StructField("seq", T.LongType())]
    )
    got = apply_order_changes(frame(spark, schema, current), frame(spark, change_schema, changes), TODAY)
    assert rows(got, "order_id", "order_status_id", "updated_at") == sorted((k, str(a), b) for k, (a, b) in table.items())


REGISTER = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("last_seq", T.LongType())])


def test_repeated_and_late_batches(spark):
    pick = random.Random(11)
    current = [dict(customer_id=str(i), city=f"c{i}", created_at="2016-01-01", updated_at="2016-01-01", is_active="Y") for i in range(20)]
    changes = [
        ("5" if pick.random() < 0.33 else str(pick.randrange(40)), pick.choice("IUUD"), n, pick.choice(["x", "y", None])) for n in range(300)
    ]
    # Out of order, some twice, one of nothing; and the whole once more at the end.
    batches = [changes[100:200] + changes[150:200], changes[:120], [], changes[100:200], changes[50:], changes]
    table, register = frame(spark, CATEGORY_LIKE, current), literal_rows(spark, REGISTER)
    state, last = {r["customer_id"]: dict(r) for r in current}, {}
    for n, batch in enumerate(batches):
        day = f"2020-05-{n + 1:02}"
        table, register = apply_batch(table, register, frame(spark, CHANGE, batch).repartition(3), "customer_id", day)
        register = frame(spark, REGISTER, [tuple(r) for r in register.collect()])
        table = frame(spark, CATEGORY_LIKE, [tuple(r) for r in table.collect()])
        counted = {c for c in batch if c[2] > last.get(c[0], -1)}
        for key, op, seq, city in sorted(counted, key=lambda c: c[2]):
            if op == "I" and key not in state:
                state[key] = dict(customer_id=key, city=city, created_at=day, updated_at=day, is_active="Y")
            elif op != "I" and key in state:
                state[key].update(dict(city=city) if op == "U" else dict(is_active="N"), updated_at=day)
        for key, _, seq, _ in batch:
            last[key] = max(seq, last.get(key, -1))
        assert rows(table) == sorted(tuple(str(v) for v in r.values()) for r in state.values())
        assert rows(register) == sorted((k, str(s)) for k, s in last.items())
    assert not any(r["updated_at"] == f"2020-05-{len(batches):02}" for r in state.values())


def test_changes_without_key_or_number_and_an_empty_register(spark):
    changes = frame(spark, CHANGE, [("1", "U", 3, "x"), ("1", "U", None, "y"), (None, "I", 4, "z"), ("2", "I", 1, "w")])
    none = literal_rows(spark, REGISTER)
    assert rows(later_changes(changes, none, "customer_id"), "customer_id", "seq") == [("1", "3"), ("2", "1")]
    register = register_changes(none, changes, "customer_id")
    assert rows(register) == [("1", "3"), ("2", "1")]
    later = frame(spark, CHANGE, [("1", "U", 2, "late"), ("2", "U", 1, "same"), ("2", "U", 2, "new")])
    assert rows(later_changes(later, register, "customer_id"), "customer_id", "city") == [("2", "new")]
