"""The registered queries: every operator, run over the whole given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping
from functools import cached_property, reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..operators import bootstrap, cdc, extract, quality, reports, summaries
from ..operators.fact import FACT_IDENTITY, compared_orders, keyed_sales, new_fact_rows, rejected_rows, update_fact
from ..operators.keys import assign_keys
from ..operators.rows import literal_rows
from ..operators.scd2 import append_dates, scd2_merge, scd2_rewrite
from ..operators.staging import STAGE, stage_date, stage_sales
from ..schemas import DIMENSIONS, EXTRACT, KEY_DIGITS, OPERATIONAL, RAW, STAGING
from ..session import run_together, scratch_path, tune
from ..sources.database import create_tables, drop_tables
from ..sources.files import (
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
from ..sources.warehouse import Warehouse
from ..streaming.arrivals import stream_orders
from . import checks
from .daily import load_dimension, run_batch
from .given_tables import EARLY_END, FIRST_END, FIRST_START, LEFT_SQL, SECOND_END, RetailStore
from .setup import load_operational_tables, prepare_dataset
from .summaries import refresh_summaries
from .transform import export_extracts, read_staged_days, staging_path, transform_day, transform_days

CHANGE_DAY = dt.date(2022, 12, 1)

# Row changes taken from the event stream: portable SQL, used by the checks as well.
CHANGES_SQL = {
    "customer_changes": """
        SELECT CASE WHEN event_type = 'signup' OR value > 60 THEN 'U' ELSE '' END || CAST(user_id AS STRING) AS customer_id,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' AND value > 50 THEN 'D' ELSE 'U' END AS op,
               event_id AS seq, 'User' AS first_name, CAST(user_id AS STRING) AS last_name,
               '444-' || CAST(event_id AS STRING) AS phone, event_type || '@mail.example' AS email, props AS street,
               event_type AS city, 'WEB' AS state, '00000' AS zip_code
        FROM {events}""",
    "order_changes": """
        SELECT CASE WHEN value > 60 THEN 'E' ELSE '' END || CAST(CAST((event_id - event_id % 3) / 3 AS BIGINT) AS STRING) AS order_id,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
               event_id AS seq, CAST(user_id AS STRING) AS customer_id, 3 AS order_status_id,
               CAST(ts AS DATE) AS order_date, CAST(ts AS DATE) + 5 AS required_date, CAST(ts AS DATE) + 2 AS shipped_date,
               '1' AS store_id, '1' AS staff_id
        FROM {events}""",
    "store_changes": """
        SELECT CASE WHEN value > 60 THEN 'N' ELSE '' END || CAST(user_id % 25 AS STRING) AS store_id,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' AND value > 50 THEN 'D' ELSE 'U' END AS op,
               event_id AS seq, 'Store ' || CAST(user_id AS STRING) AS store_name, '444-' || CAST(event_id AS STRING) AS phone,
               event_type || '@store.example' AS email, props AS street, event_type AS city, 'WEB' AS state, '00000' AS zip_code
        FROM {events}""",
    "staff_changes": """
        SELECT CASE WHEN value > 60 THEN 'N' ELSE '' END || CAST(user_id AS STRING) AS staff_id,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' AND value > 50 THEN 'D' ELSE 'U' END AS op,
               event_id AS seq, 'Staff' AS first_name, CAST(event_id AS STRING) AS last_name, event_type || '@store.example' AS email,
               '777-' || CAST(event_id AS STRING) AS phone, CAST(user_id % 25 AS STRING) AS store_id, '1' AS manager_id
        FROM {events}""",
    "product_changes": """
        SELECT CASE WHEN value > 60 THEN 'N' ELSE '' END || CAST(user_id AS STRING) AS product_id,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' AND value > 50 THEN 'D' ELSE 'U' END AS op,
               event_id AS seq, event_type || ' ' || CAST(event_id AS STRING) AS product_name, 11 AS brand_id, 6 AS category_id,
               2022 AS model_year, CAST(event_id % 1000 AS DECIMAL(10,2)) AS list_price
        FROM {events}""",
    "renamed_products": """
        SELECT CAST(p_partkey AS STRING) AS old_key, 'P' || CAST(p_partkey AS STRING) AS new_key
        FROM {part} WHERE p_type = 'SMALL'""",
}

# Keys to rename, by table: some follow through all references, some cannot be (taken, repeated, unknown, used by references that stay).
RENAMES_SQL = {
    "stores": """
        SELECT store_id AS old_key, 'S' || store_id AS new_key FROM {stores} WHERE state <> 'ASIA'
        UNION ALL SELECT 'none', 'S-none' UNION ALL SELECT '2', NULL""",
    "products": """
        SELECT product_id AS old_key, 'P' || product_id AS new_key FROM {products} WHERE list_price > 1000
        UNION ALL SELECT product_id, 'P' || product_id || '+' FROM {products} WHERE list_price > 1400""",
    "customers": """
        SELECT customer_id AS old_key, CASE WHEN zip_code < '00020' THEN 'C' || customer_id ELSE customer_id || '0' END AS new_key
        FROM {customers}""",
    "orders": "SELECT order_id AS old_key, 'O' || order_id AS new_key FROM {orders} WHERE order_status_id = 1",
    "order_status": "SELECT 3 AS old_key, 30 AS new_key UNION ALL SELECT 1, 2",
    "brands": "SELECT brand_id AS old_key, brand_id + 100 AS new_key FROM {brands}",
    "categories": "SELECT category_id AS old_key, category_id + 1 AS new_key FROM {categories}",
    "staffs": "SELECT staff_id AS old_key, 'F' || staff_id AS new_key FROM {staffs}",
}

# Rows of the other audited tables that the store deletes, taken from the event stream.
GONE_SQL = {
    "stores": "SELECT CAST(user_id % 25 AS STRING) AS store_id FROM {events} WHERE event_type = 'error' AND value > 95 GROUP BY user_id % 25",
    "staffs": "SELECT CAST(user_id AS STRING) AS staff_id FROM {events} WHERE event_type = 'error' AND value > 20",
    "products": "SELECT CAST(event_id AS STRING) AS product_id FROM {events} WHERE event_type = 'error'",
}

# Batches of changes as they are delivered: day, and the events of the batch. The second repeats the first in part and is late
# in part, the third has everything, the fourth repeats it.
DELIVERIES = (
    (dt.date(2022, 12, 1), "value <= 10 OR value > 150"),
    (dt.date(2022, 12, 2), "value <= 40"),
    (dt.date(2022, 12, 3), "value >= 0"),
    (dt.date(2022, 12, 4), "value >= 0"),
)

# Changes of each audited table, from CHANGES_SQL.
CHANGED = {"customers": "customer_changes", "stores": "store_changes", "staffs": "staff_changes", "products": "product_changes"}

# Order extracts with cells that do not fit their types.
SPOILED_SQL = """
    SELECT order_id, customer_id, order_status, CASE WHEN store_id = '3' THEN '2020-13-45' ELSE CAST(order_date AS STRING) END AS order_date,
           required_date, shipped_date, store_id, staff_id, product_id,
           CASE WHEN discount = 0.05 THEN 'x' ELSE '' END || CAST(quantity AS STRING) AS quantity,
           CASE WHEN quantity = 7 THEN 'n/a' ELSE CAST(list_price AS STRING) END AS list_price, discount, updated_at
    FROM {extract}"""


class Stored(Mapping):
    """Tables that are written when they are first asked for; all at the same time for those who ask for all."""

    def __init__(self, plans: Mapping[str, DataFrame], write: Callable[[str, DataFrame], DataFrame]):
        self._plans, self._write = plans, write

    def __getitem__(self, name: str) -> DataFrame:
        return self._write(name, self._plans[name])

    def __contains__(self, name: object) -> bool:
        return name in self._plans

    def __iter__(self):
        run_together([lambda n=n: self[n] for n in self._plans])
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)


class Star:
    """Inputs shared by the queries on one folder, written once per session to the shared folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.store = spark, RetailStore(spark, folder)
        self._kept: dict[str, DataFrame] = {}
        self._writing: defaultdict[str, Lock] = defaultdict(Lock)

    def _written(self, name: str, rows: DataFrame) -> DataFrame:
        """The rows, written and read back under a name used once."""
        with self._writing[name]:
            if name not in self._kept:
                path = scratch_path(self.spark, name)
                write_parquet(rows, path)
                self._kept[name] = read_parquet(self.spark, path, rows.schema)
        return self._kept[name]

    def _operational(self, day: dt.date) -> Mapping[str, DataFrame]:
        """The operational tables at the end of a day, as stored tables: extraction starts from these. A table that nobody reads is not made."""
        dated = {"customers", "products", "staffs", "stores", "orders"}

        def stored(name: str, rows: DataFrame) -> DataFrame:
            return rows if name == "order_status" else self._written(f"{name}-{day}" if name in dated else name, rows)

        return Stored(self.store.tables(day), stored)

    @cached_property
    def first(self) -> Mapping[str, DataFrame]:
        """Operational tables at the end of the first window."""
        return self._operational(FIRST_END)

    @cached_property
    def second(self) -> Mapping[str, DataFrame]:
        """Operational tables at the end of the second window."""
        return self._operational(SECOND_END)

    @cached_property
    def first_run(self) -> Warehouse:
        """The star schema after the daily run over the first window."""
        warehouse = Warehouse(self.spark, scratch_path(self.spark, "star"))
        run_batch(warehouse, self.first, FIRST_END)
        return warehouse

    @cached_property
    def second_run(self) -> Warehouse:
        """The same after the daily run over the second window."""
        run_batch(self.first_run, self.second, SECOND_END)
        return self.first_run

    @cached_property
    def summarised(self) -> tuple[Warehouse, list[str]]:
        """The star with summaries of its state after the first run, brought to the second's; and the months that this took."""
        refresh_summaries(self.second_run, seq=1)
        return self.second_run, refresh_summaries(self.second_run, seq=2)

    @cached_property
    def late_run(self) -> Warehouse:
        """A star of three daily runs whose sales wait for the ids they name."""
        warehouse = Warehouse(self.spark, scratch_path(self.spark, "late-star"))
        for tables, day in ((self._operational(EARLY_END), EARLY_END), (self.first, FIRST_END), (self.second, SECOND_END)):
            run_batch(warehouse, tables, day, wait=True)
        return warehouse

    @cached_property
    def replayed_changes(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        """The audited tables, and their registers, after all deliveries of changes. Each register is written before the next."""

        def after(name: str) -> tuple[DataFrame, DataFrame]:
            key = DIMENSIONS[name].id
            rows = _bootstrap_customers(self) if name == "customers" else _bootstrap(name)(self)
            register = self.changes(CHANGED[name]).select(key, F.col("seq").alias("last_seq")).limit(0)
            for step, (day, part) in enumerate(DELIVERIES):
                batch = self.spark.sql(CHANGES_SQL[CHANGED[name]], events=self.store["events"].filter(part))
                rows, register = cdc.apply_batch(rows, register, batch, key, day)
                register = self._written(f"register-{name}-{step}", register)
            return rows, register

        return dict(zip(CHANGED, run_together([lambda n=n: after(n) for n in CHANGED])))

    @cached_property
    def checked_csv(self) -> DataFrame:
        """The order extracts of both windows with spoiled cells, written as CSV and read with their misfits."""
        root = scratch_path(self.spark, "spoiled")
        extracts = {
            FIRST_END: extract.extract_orders(self.first, FIRST_START, FIRST_END), SECOND_END: self.extracted("orders"),
        }
        paths = [extract_path(root, day, "orders") for day in extracts]
        for path, rows in zip(paths, extracts.values()):
            write_csv(self.spark.sql(SPOILED_SQL, extract=rows), path)
        read = read_csv_checked(self.spark, paths, EXTRACT["orders"])
        # The day's file, whatever parts it was written in.
        return read.withColumn("file", F.regexp_extract("file", r"(\d{8}-orders\.csv)", 1))

    def before(self, table: str) -> DataFrame:
        return self.first_run.read(table, seq=1)

    def after(self, table: str) -> DataFrame:
        return self.second_run.read(table, seq=2)

    @cached_property
    def streamed(self) -> Warehouse:
        """A star whose dimensions are merged by window and whose orders come as a stream of files, each delivered twice."""
        warehouse, landing = Warehouse(self.spark, scratch_path(self.spark, "streamed-star")), scratch_path(self.spark, "landing")
        checkpoint = scratch_path(self.spark, "stream")
        for tables, start, end in ((self.first, FIRST_START, FIRST_END), (self.second, FIRST_END, SECOND_END)):
            run = warehouse.begin(start, end, "dimensions")
            for name, dim in DIMENSIONS.items():
                load_dimension(run, run.stage(f"stg_{name}", STAGE[name](extract.EXTRACTIONS[name](tables, start, end))), dim)
            run.commit()
            orders = self._written(f"arriving-{end}", extract.extract_orders(tables, start, end))
            for _ in range(2):
                orders.write.mode("append").parquet(landing)
            stream_orders(warehouse, landing, checkpoint).awaitTermination()
        return warehouse

    def summary(self, table: str) -> DataFrame:
        return self.summarised[0].read(table)

    def dims(self) -> dict[str, DataFrame]:
        return {name: self.after(dim.table) for name, dim in DIMENSIONS.items()}

    def extracted(self, name: str) -> DataFrame:
        """What the second window extracts."""
        return extract.EXTRACTIONS[name](self.second, FIRST_END, SECOND_END)

    def replayed(self, name: str) -> DataFrame:
        """The first window's extract followed by one of both windows: with every kind of repetition."""
        both = extract.EXTRACTIONS[name](self.second, FIRST_START, SECOND_END)
        return extract.EXTRACTIONS[name](self.first, FIRST_START, FIRST_END).unionByName(both)

    def staged(self, name: str) -> DataFrame:
        """The second window's staging tables, written and read back as in the daily run."""
        if name == "sales":
            rows = stage_sales(self.extracted("orders"))
        elif name == "date":
            rows = stage_date(self.extracted("orders"))
        else:
            rows = STAGE[name](self.extracted(name))
        return self._written(f"stg-{name}", rows)

    def changes(self, name: str) -> DataFrame:
        text = CHANGES_SQL[name]
        given = [t for t in ("events", "part") if "{" + t + "}" in text]
        return self.spark.sql(text, **{t: self.store[t] for t in given})


_stars: dict[tuple[str, str], Star] = {}


def star(spark: SparkSession, folder: str) -> Star:
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _stars:
        _stars[key] = Star(tune(spark), folder)
    return _stars[key]


# --- extraction, bootstrap, staging -----------------------------------------------------


def _extract(name: str):
    return lambda s: s.extracted(name)


def _bootstrap(name: str):
    return lambda s: getattr(bootstrap, f"bootstrap_{name}")(s.store[f"raw_{name}"])


def _bootstrap_customers(s: Star) -> DataFrame:
    return bootstrap.bootstrap_customers(s.store["raw_customers"], s.store["raw_orders"])


def _order_status_lookup(s: Star) -> DataFrame:
    orders = bootstrap.bootstrap_orders(s.store["raw_orders"]).groupBy("order_status_id").agg(F.count("*").alias("orders"))
    return bootstrap.order_status_lookup(s.spark).join(orders, "order_status_id", "left")


def _all_orders(s: Star) -> DataFrame:
    return extract.extract_orders(s.second, FIRST_START, SECOND_END)


# --- warehouse --------------------------------------------------------------------------


def _natural(name: str) -> list[str]:
    dim = DIMENSIONS[name]
    return [c for c in dim.schema.names if c != dim.key]


def _scd2(name: str):
    dim = DIMENSIONS[name]
    return lambda s: scd2_merge(s.before(dim.table), s.staged(name), dim).select(*_natural(name))


def _scd2_twice(s: Star) -> DataFrame:
    dim, batch = DIMENSIONS["products"], s.staged("products")
    once = scd2_merge(s.before(dim.table), batch, dim)
    return scd2_merge(once, batch, dim).select(*_natural("products"))


def _scd2_reactivated(s: Star) -> DataFrame:
    dim = DIMENSIONS["products"]
    merged = scd2_merge(s.before(dim.table), s.staged("products"), dim, reactivate=True)
    return merged.select(*_natural("products"))


def _customer_keys(s: Star) -> DataFrame:
    dim = DIMENSIONS["customers"]
    before = s.before(dim.table)
    rewritten = scd2_rewrite(before, s.staged("customers"), dim)
    opened = s._written("opened-customers", rewritten.filter(F.col(dim.key).isNull()))
    numbered = assign_keys(opened, dim.key, [dim.id, "eff_date"], s.second_run.top_key(dim.table, seq=1), KEY_DIGITS[dim.table])
    numbered = rewritten.filter(F.col(dim.key).isNotNull()).unionByName(numbered)
    return numbered.select(dim.key, dim.id, "eff_date", "exp_date", "active_flag")


def _held(s: Star) -> DataFrame:
    """The staged orders that the fact holds, in a table of their own as in the daily run. The first run has stored all statuses."""
    compared = compared_orders(s.staged("sales"), s.before("fact_orders"), s.before("dim_order_status"))
    return s._written("held", compared.where("known_date IS NOT NULL"))


def _keyed(s: Star) -> DataFrame:
    return s._written("keyed", keyed_sales(s.staged("sales"), _held(s), s.dims(), s.after("dim_order_status")))


def _fact_insert(s: Star) -> DataFrame:
    top = s.second_run.top_key("fact_sales", seq=1)
    return assign_keys(new_fact_rows(_keyed(s)), "sales_id", FACT_IDENTITY, top, KEY_DIGITS["fact_sales"])


def _fact_update(s: Star) -> DataFrame:
    return update_fact(s.before("fact_sales"), _held(s))


# --- change capture, checks, files ------------------------------------------------------


def _apply_changes(s: Star) -> DataFrame:
    return cdc.apply_changes(_bootstrap_customers(s), s.changes("customer_changes"), "customer_id", CHANGE_DAY)


def _soft_delete(s: Star) -> DataFrame:
    gone = s.changes("customer_changes").filter("op = 'D'")
    return cdc.soft_delete(_bootstrap_customers(s), gone, "customer_id", CHANGE_DAY)


def _order_changes(s: Star) -> DataFrame:
    orders = bootstrap.bootstrap_orders(s.store["raw_orders"])
    return cdc.apply_order_changes(orders, s.changes("order_changes"), CHANGE_DAY)


def _replayed_changes(name: str):
    return lambda s: s.replayed_changes[name][0]


def _change_register(s: Star) -> DataFrame:
    registers = {n: register for n, (_, register) in s.replayed_changes.items()}
    return reduce(
        DataFrame.unionByName,
        [r.select(F.lit(n).alias("table_name"), F.col(DIMENSIONS[n].id).alias("key"), "last_seq") for n, r in registers.items()],
    )


def _late_arrivals(s: Star) -> DataFrame:
    """The fact with the ids and the versions that its keys stand for."""
    fact = s.late_run.read("fact_sales")
    for name, dim in DIMENSIONS.items():
        fact = fact.join(s.late_run.read(dim.table).select(dim.key, dim.id, F.col("eff_date").alias(f"{name}_since")), dim.key)
    return fact.drop("sales_id", *[dim.key for dim in DIMENSIONS.values()])


def _etl_windows(s: Star) -> DataFrame:
    runs = s.store["events"].select("ts", (F.col("value") > 300).alias("ok"))
    return extract.extraction_windows(runs, "ts", "ok")


def _left(s: Star) -> dict[str, DataFrame]:
    second = dict(s.second)
    return {n: second[n].filter(what) for n, what in LEFT_SQL.items()}


def _cascade_all(s: Star) -> DataFrame:
    return _digests(checks.follow_deletes(s.second, _left(s)))


def _renames(s: Star) -> dict[str, DataFrame]:
    second = dict(s.second)
    return {n: s.spark.sql(text, **{n: second[n]}) for n, text in RENAMES_SQL.items()}


def _cascade_update(s: Star) -> DataFrame:
    return _digests(checks.follow_renames(s.second, _renames(s)))


def _soft_delete_of(name: str):
    def query(s: Star) -> DataFrame:
        gone = s.spark.sql(GONE_SQL[name], events=s.store["events"])
        return cdc.soft_delete(_bootstrap(name)(s), gone, DIMENSIONS[name].id, CHANGE_DAY)

    return query


def _digests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every row of every table, as number, smallest and largest digest and sum of digests (of their next eight digits) of the rows in each of 256 buckets."""

    def of(name: str) -> DataFrame:
        table = tables[name]
        row = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in sorted(table.columns)]))
        rows = table.select(row.alias("row"))
        found = rows.groupBy(F.substring("row", 1, 2).alias("bucket")).agg(F.count("*").alias("rows"), F.min("row").alias("low"), F.max("row").alias("high"), F.sum(F.conv(F.substring("row", 3, 8), 16, 10).cast("bigint")).alias("total"))
        return found.select(F.lit(name).alias("table_name"), "bucket", "rows", "low", "high", "total")

    return reduce(DataFrame.unionByName, [of(n) for n in tables])


def _cascade_retain(s: Star) -> DataFrame:
    return quality.retain_children(s.store["raw_order_items"], "order_id", s.first["orders"], "order_id")


def _cascade_rekey(s: Star) -> DataFrame:
    return quality.rekey_children(s.store["raw_order_items"], "product_id", s.changes("renamed_products"))


def _csv_roundtrip(s: Star) -> DataFrame:
    path = extract_path(scratch_path(s.spark, "raw"), SECOND_END, "orders")
    write_csv(s.extracted("orders"), path)
    return read_csv(s.spark, path, EXTRACT["orders"])


def _csv_fitting_rows(s: Star) -> DataFrame:
    return s.checked_csv.filter("misfit = ''").drop("line", "misfit")


def _parsed_dates(s: Star) -> DataFrame:
    """The order dates of the spoiled extracts, from text."""
    rows = s.spark.sql(SPOILED_SQL, extract=_all_orders(s))
    return rows.select("order_id", "product_id", "quantity", F.col("order_date").alias("text"), parse_date("order_date").alias("order_date"))


def _catalog_tables(s: Star) -> DataFrame:
    """The operational tables in catalog tables that are created, filled, read and dropped; and how many are left after that."""
    database = f"starloom_{uuid.uuid4().hex}"
    create_tables(s.spark, database, OPERATIONAL)
    try:
        create_tables(s.spark, database, OPERATIONAL)  # those that exist stay
        run_together([lambda n=n: s.second[n].select(*OPERATIONAL[n].names).write.insertInto(f"{database}.{n}") for n in OPERATIONAL])
        path = scratch_path(s.spark, "catalog")
        write_parquet(_digests({n: s.spark.table(f"{database}.{n}") for n in OPERATIONAL}), path)
    finally:
        drop_tables(s.spark, database, [*OPERATIONAL, "never_there"])
        left = len(s.spark.catalog.listTables(database))
        s.spark.sql(f"DROP DATABASE {database}")
    return s.spark.read.parquet(path).withColumn("tables_left", F.lit(left))


def _csv_import(s: Star) -> DataFrame:
    raw = s.store.raw()
    folder = scratch_path(s.spark, "dataset")
    export_csv(raw, f"{folder}/csv")
    return _digests(import_csv(s.spark, f"{folder}/csv", {n: RAW[n] for n in raw}, f"{folder}/tables"))


def _dataset_setup(s: Star) -> DataFrame:
    folder = scratch_path(s.spark, "setup")
    export_csv(s.store.raw(), f"{folder}/dataset")
    prepare_dataset(s.spark, f"{folder}/dataset", f"{folder}/prepared")
    return _digests(load_operational_tables(s.spark, f"{folder}/prepared", f"{folder}/tables"))


def _transform_files(s: Star) -> DataFrame:
    folder = scratch_path(s.spark, "transform")
    export_extracts(s.second, FIRST_START, SECOND_END, f"{folder}/raw", SECOND_END)
    transform_day(s.spark, f"{folder}/raw", SECOND_END, f"{folder}/processed")
    return _digests({n: read_parquet(s.spark, staging_path(f"{folder}/processed", SECOND_END, n), STAGING[n]) for n in STAGING})


def _transform_days(s: Star) -> DataFrame:
    folder = scratch_path(s.spark, "transform-days")
    export_extracts(s.first, FIRST_START, FIRST_END, f"{folder}/raw", FIRST_END)
    export_extracts(s.second, FIRST_END, SECOND_END, f"{folder}/raw", SECOND_END)
    transform_days(s.spark, f"{folder}/raw", [FIRST_END, SECOND_END], f"{folder}/processed")
    return _digests({n: read_staged_days(s.spark, f"{folder}/processed", n, FIRST_END, SECOND_END) for n in STAGING})


def _parquet_roundtrip(s: Star) -> DataFrame:
    path = scratch_path(s.spark, "sales")
    write_parquet(stage_sales(s.extracted("orders")), path, sort=["order_id", "product_id"])
    return read_parquet(s.spark, path, STAGING["sales"])


def _publish_and_clear(s: Star) -> DataFrame:
    warehouse = Warehouse(s.spark, scratch_path(s.spark, "publish"))
    run = warehouse.begin(FIRST_START, SECOND_END)
    staged = run.stage("stg_date", stage_date(_all_orders(s)))
    run.publish("dim_date", staged, F.col("year").cast("string"))
    run.commit()
    run.clear("stg_date", STAGING["date"])
    left = run.staged("stg_date", STAGING["date"]).count()
    return warehouse.read("dim_date").withColumn("left_in_staging", F.lit(left).cast("long"))


def _report(report: Callable[..., DataFrame], *tables: str):
    return lambda s: report(*[s.after(t) for t in tables])


def _summed_report(report: Callable[..., DataFrame], name: str):
    """A report over the summary of the one dimension that it needs."""
    return lambda s: report(summaries.as_fact(s.summary("sales_summary"), name), s.after(DIMENSIONS[name].table))


def _touched_months(s: Star) -> DataFrame:
    months = s.summarised[1]
    return literal_rows(s.spark, s.summary("sales_summary").select("month").schema, [(m,) for m in months])


QUERIES: dict[str, Callable[[Star], DataFrame]] = {
    **{f"extract_{n}_window": _extract(n) for n in extract.EXTRACTIONS},
    "bootstrap_customers": _bootstrap_customers,
    **{f"bootstrap_{n}": _bootstrap(n) for n in ("staffs", "products", "stores", "orders")},
    "order_status_lookup": _order_status_lookup,
    **{f"stg_{n}": (lambda s, n=n: STAGE[n](s.replayed(n))) for n in STAGE},
    "stg_date": lambda s: stage_date(_all_orders(s)),
    "stg_sales": lambda s: stage_sales(_all_orders(s)),
    "stg_sales_summed": lambda s: stage_sales(_all_orders(s), repeated="sum"),
    **{f"scd2_{n}": _scd2(n) for n in DIMENSIONS},
    "scd2_second_batch": _scd2_twice,
    "scd2_reactivated": _scd2_reactivated,
    "dim_date_append": lambda s: append_dates(s.before("dim_date"), s.staged("date")),
    "dim_customer_keys": _customer_keys,
    "fact_insert": _fact_insert,
    "fact_rejected_rows": lambda s: rejected_rows(_keyed(s)),
    "fact_update": _fact_update,
    "end_to_end_star": lambda s: s.after("fact_sales"),
    "end_to_end_late_arrivals": _late_arrivals,
    "end_to_end_streamed_orders": lambda s: s.streamed.read("fact_sales").drop("sales_id"),
    "stream_order_register": lambda s: s.streamed.read("order_register").groupBy("order_id").agg(F.max("updated_at").alias("updated_at")),
    "pending_sales": lambda s: s.late_run.read("pending_sales"),
    "cdc_apply_changes": _apply_changes,
    **{f"cdc_replayed_{n}": _replayed_changes(n) for n in CHANGED},
    "cdc_change_register": _change_register,
    "cdc_soft_delete": _soft_delete,
    **{f"cdc_soft_delete_{n}": _soft_delete_of(n) for n in GONE_SQL},
    "cdc_order_changes": _order_changes,
    "etl_window_dates": _etl_windows,
    "dq_keys": lambda s: checks.check_keys(dict(s.second)),
    "dq_references": lambda s: checks.check_references({**s.second, **_left(s)}),
    "dq_never_extracted": lambda s: checks.never_extracted(s.second["orders"]),
    "dq_columns": lambda s: checks.check_columns(dict(s.second)),
    "dq_staging_keys": lambda s: checks.check_staging_keys({n: s.staged(n) for n in STAGING}),
    "dq_staging_columns": lambda s: checks.check_staging_columns({n: s.staged(n) for n in STAGING}),
    "cascade_all": _cascade_all,
    "cascade_retain": _cascade_retain,
    "cascade_rekey": _cascade_rekey,
    "cascade_update": _cascade_update,
    "cascade_update_refused": lambda s: checks.refused_renames(s.second, _renames(s)),
    "csv_roundtrip": _csv_roundtrip,
    "csv_fitting_rows": _csv_fitting_rows,
    "csv_misfits": lambda s: split_misfits(s.checked_csv)[1],
    "parsed_dates": _parsed_dates,
    "catalog_tables": _catalog_tables,
    "csv_import": _csv_import,
    "dataset_setup": _dataset_setup,
    "transform_files": _transform_files,
    "transform_days": _transform_days,
    "parquet_roundtrip": _parquet_roundtrip,
    "staging_publish_and_clear": _publish_and_clear,
    "sales_monthly_trend": _report(reports.sales_monthly_trend, "fact_sales", "dim_date"),
    "late_delivery_by_store": _report(reports.late_delivery_by_store, "fact_sales", "dim_stores"),
    "top_products": _report(reports.top_products, "fact_sales", "dim_products"),
    "brand_ranking": _report(reports.brand_ranking, "fact_sales", "dim_products"),
    "unsold_products": _report(reports.unsold_products, "fact_sales", "dim_products"),
    "customers_by_state": _report(reports.customers_by_state, "dim_customers"),
    "top_spenders": _report(reports.top_spenders, "fact_sales", "dim_customers"),
    "store_performance": _report(reports.store_performance, "fact_sales", "dim_stores"),
    "summary_of_sales": lambda s: s.summary("sales_summary"),
    "summary_of_orders": lambda s: s.summary("order_summary"),
    "summary_touched_months": _touched_months,
    "summary_sales_monthly_trend": lambda s: summaries.sales_monthly_trend(
        s.summary("sales_summary"), s.summary("order_summary"), s.after("dim_date")
    ),
    "summary_late_delivery_by_store": lambda s: summaries.late_delivery_by_store(s.summary("order_summary"), s.after("dim_stores")),
    "summary_top_products": _summed_report(reports.top_products, "products"),
    "summary_brand_ranking": _summed_report(reports.brand_ranking, "products"),
    "summary_unsold_products": _summed_report(reports.unsold_products, "products"),
    "summary_top_spenders": _summed_report(reports.top_spenders, "customers"),
    "summary_store_performance": _summed_report(reports.store_performance, "stores"),
    "staff_hierarchy": lambda s: reports.staff_managers(s.second["staffs"]),
    "staff_chains": lambda s: reports.staff_chains(s.second["staffs"]),
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query as a function of the session and the folder of the given tables."""
    return {name: (lambda spark, folder, q=query: q(star(spark, folder))) for name, query in QUERIES.items()}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly revenue straight from the operational tables: extract, stage, measure, report."""
    s = star(spark, folder)
    sales = stage_sales(_all_orders(s))
    return reports.sales_monthly_trend(sales, stage_date(_all_orders(s)))

