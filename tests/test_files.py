import datetime as dt

import pytest
from frames import frame, rows

from starloom.schemas import EXTRACT, OPERATIONAL, RAW
from starloom.session import shared_folder
from starloom.sources.database import create_tables, drop_tables, read_database_table
from starloom.plans.queries import Stored
from starloom.plans.transform import read_staged_days, staging_path, transform_day, transform_days
from starloom.sources.files import (
    WRONG_NUMBER,
    export_csv,
    extract_path,
    import_csv,
    read_csv,
    read_csv_checked,
    read_parquet,
    split_misfits,
    write_csv,
    write_parquet,
)

STORES = EXTRACT["stores"]
HEADER = ",".join(STORES.names)


def csv(tmp_path, *lines):
    path = tmp_path / "stores.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_extract_path():
    assert extract_path("root/", "20241009", "orders") == "root/2024/10/09/20241009-orders.csv"
    assert extract_path("root", dt.date(2024, 10, 9), "orders", "parquet") == "root/2024/10/09/20241009-orders.parquet"


def test_csv_quotes_empties_and_bad_cells(spark, tmp_path):
    path = csv(tmp_path, HEADER, '1,"a, ""b""",,"",s,c,NY,01234,no date,Y', "2,n,p,e,s,c,NY,1,2016-01-01,Y")
    read = read_csv(spark, path, STORES)
    assert rows(read, "store_id", "store_name", "phone", "email", "zip_code", "updated_at") == [
        ("1", 'a, "b"', "None", "None", "01234", "None"), ("2", "n", "p", "e", "1", "2016-01-01"),
    ]


def test_csv_header_is_checked_unless_told_otherwise(spark, tmp_path):
    swapped = ",".join(["store_name", "store_id", *STORES.names[2:]])
    path = csv(tmp_path, swapped, "1,n,p,e,s,c,NY,1,2016-01-01,Y")
    with pytest.raises(Exception, match="header|schema"):
        read_csv(spark, path, STORES).collect()
    assert rows(read_csv(spark, path, STORES, strict_header=False), "store_id", "store_name") == [("1", "n")]


def test_misfits_are_split_off_with_their_reason(spark, tmp_path):
    lines = {
        "good": '1,"a, ""b""",,"",s,c,NY,01234,,Y',
        "date": '2,"x, y",p,e,s,c,NY,1,no date,Y',
        "few": "3,n,p,e",
        "many": "4,n,p,e,s,c,NY,1,2016-01-01,Y,more",
        "both": "5,n,p,e,s,c,NY,1,2016-02-30,Y,more",
        "blank": '6,n,p,e,s,c,NY,1,"",Y',
    }
    path = csv(tmp_path, HEADER, *lines.values())
    good, bad = split_misfits(read_csv_checked(spark, path, STORES))
    assert good.columns == STORES.names
    assert rows(good, "store_id", "store_name", "phone", "updated_at") == [("1", 'a, "b"', "None", "None"), ("6", "n", "p", "None")]
    # Whatever columns are asked for, the same rows fit.
    assert rows(good.select("store_id")) == [("1",), ("6",)] and good.count() == 2
    assert rows(bad.select("misfit", "line")) == sorted(
        [("updated_at", lines["date"]), (WRONG_NUMBER, lines["few"]), (WRONG_NUMBER, lines["many"]), ("updated_at", lines["both"])]
    )
    assert {r.file.rsplit("/", 1)[1] for r in bad.collect()} == {"stores.csv"}
    # The rows are those that the unchecked reader gives.
    assert rows(read_csv_checked(spark, path, STORES).select(*STORES.names)) == rows(read_csv(spark, path, STORES))


def test_misfits_of_files_without_any_and_of_empty_files(spark, tmp_path):
    good, bad = split_misfits(read_csv_checked(spark, csv(tmp_path, HEADER), STORES))
    assert good.count() == bad.count() == 0
    good, bad = split_misfits(read_csv_checked(spark, csv(tmp_path, HEADER, "2,n,p,e,s,c,NY,1,2016-01-01,Y"), STORES))
    assert (good.count(), bad.count()) == (1, 0)


def test_a_day_can_be_transformed_without_its_misfits(spark, tmp_path):
    raw, made = str(tmp_path / "raw"), str(tmp_path / "made")
    for name, schema in EXTRACT.items():
        write_csv(frame(spark, schema, []), extract_path(raw, "20160102", name))
    stores = [f"{k},n,p,e,s,c,NY,1,{day},Y" for k, day in ((1, "2016-01-01"), (2, "none"), (3, "2016-01-02"))]
    spark.createDataFrame([(line,) for line in [HEADER, *stores]], "value string").coalesce(1).write.mode("overwrite").text(extract_path(raw, "20160102", "stores"))
    transform_day(spark, raw, "20160102", made, reject=True)
    assert rows(spark.read.parquet(staging_path(made, "20160102", "stores")), "store_id") == [("1",), ("3",)]
    assert rows(spark.read.parquet(staging_path(made, "20160102", "rejected")), "extract", "line", "misfit") == [("stores", stores[1], "updated_at")]


def test_many_days_in_one_job_equal_the_days_alone(spark, tmp_path):
    raw, made, alone = (str(tmp_path / n) for n in ("raw", "made", "alone"))
    days = [dt.date(2016, 1, d) for d in (1, 2, 3)]
    store = dict(store_id="1", store_name="n", phone="p", email="e", street="s", city="c", state="NY", zip_code="1", is_active="Y")
    line = dict(order_id="1", customer_id="c", order_status="Pending", order_date="2016-01-01", required_date="2016-01-05", store_id="1", staff_id="f",
                product_id="p", quantity=1, list_price="2", discount="0.10")

    def export(day, **given):
        for name, schema in EXTRACT.items():
            write_csv(frame(spark, schema, given.get(name, [])), extract_path(raw, day, name))

    # The same order on two days, twice on one of them; a day without stores.
    export(days[0], orders=[{**line, "updated_at": "2016-01-01"}] * 2, stores=[{**store, "updated_at": "2016-01-01"}])
    export(days[1], orders=[{**line, "shipped_date": "2016-01-02", "updated_at": "2016-01-02"}])
    export(days[2], stores=[{**store, "updated_at": "2016-01-03"}])
    transform_days(spark, raw, days, made)
    for day in days:
        transform_day(spark, raw, f"{day:%Y%m%d}", alone)
        for name in ("sales", "date", "stores", "products"):
            expected = rows(spark.read.parquet(staging_path(alone, f"{day:%Y%m%d}", name)))
            assert rows(read_staged_days(spark, made, name, day, day).drop("run_date")) == expected
    few = read_staged_days(spark, made, "sales", days[1], days[1])
    assert {f.split("run_date=")[1][:10] for f in few.inputFiles()} <= {str(d) for d in days}
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "run_date" in plan.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: []" in plan
    # One day again, now with nothing: its rows go, the others stay.
    export(days[0])
    transform_days(spark, raw, days[:1], made)
    assert rows(read_staged_days(spark, made, "sales", days[0], days[2]), "order_id", "run_date") == [("1", "2016-01-02")]
    assert rows(read_staged_days(spark, made, "stores", days[0], days[2]), "run_date") == [("2016-01-03",)]


def test_csv_round_trip_import_export(spark, tmp_path):
    product = dict(product_id="p", product_name='24" "x", y', brand_id=1, category_id=2, model_year=2016, list_price="10.50")
    tables = {"products": frame(spark, RAW["products"], [product]), "brands": frame(spark, RAW["brands"], [(1, "b")])}
    write_csv(tables["products"], str(tmp_path / "p.csv"))
    assert rows(read_csv(spark, str(tmp_path / "p.csv"), RAW["products"])) == rows(tables["products"])
    export_csv(tables, str(tmp_path / "csv"))
    back = import_csv(spark, str(tmp_path / "csv"), {n: RAW[n] for n in tables}, str(tmp_path / "tables"))
    assert {n: rows(t) for n, t in back.items()} == {n: rows(t) for n, t in tables.items()}


def test_parquet_files_are_bounded_sorted_and_checked(spark, tmp_path):
    path = str(tmp_path / "ids")
    ids = spark.range(1000).selectExpr("cast(999 - id as string) AS order_id", "cast(id as int) AS item_id")
    write_parquet(ids, path, sort=["item_id"], records_per_file=300)
    assert len(list((tmp_path / "ids").glob("part-*"))) >= 4
    assert read_parquet(spark, path, ids.schema).count() == 1000
    with pytest.raises(ValueError, match="item_id"):
        read_parquet(spark, path, ids.drop("item_id").schema)


def test_catalog_tables(spark):
    create_tables(spark, "starloom_test", {"orders": OPERATIONAL["orders"], "brands": OPERATIONAL["brands"]})
    create_tables(spark, "starloom_test", {"brands": OPERATIONAL["brands"]})
    assert spark.table("starloom_test.orders").columns == OPERATIONAL["orders"].names
    drop_tables(spark, "starloom_test", ["orders", "brands", "never_there"])
    assert not spark.catalog.tableExists("starloom_test.brands")
    spark.sql("DROP DATABASE starloom_test")


def test_database_table_needs_a_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        read_database_table(spark, "jdbc:nothing://host/db", "orders", ["updated_at < DATE '2016-01-01'"])


def test_shared_folder_is_read_from_the_session(spark):
    named = spark.newSession()
    assert shared_folder(named)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(named.conf), "get", lambda self, name, default=None: "/shared/x/" if name == "spark.checkpoint.dir" else default)
        assert shared_folder(named) == "/shared/x"


def test_stored_tables_are_written_when_asked_for_and_all_for_those_who_ask_for_all():
    written = []
    stored = Stored({"a": 1, "b": 2, "c": 3}, lambda name, plan: written.append(name) or plan)
    assert "a" in stored and "d" not in stored and len(stored) == 3 and written == []
    assert stored["b"] == 2 and written == ["b"]
    assert dict(stored) == {"a": 1, "b": 2, "c": 3} == {**stored} and set(written) == {"a", "b", "c"}


def test_parquet_is_written_with_zstd(spark, tmp_path):
    write_parquet(spark.range(10), str(tmp_path / "t"))
    assert all(f.endswith(".zstd.parquet") for f in spark.read.parquet(str(tmp_path / "t")).inputFiles())
