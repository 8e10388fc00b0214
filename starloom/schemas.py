"""Table schemas, keys and limits: raw, operational, extract, staging and serving tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------
OPEN_END = "9999-12-31"
ACTIVE, INACTIVE = "Y", "N"
FIRST_AUDIT_DATE = "2016-01-01"
FIRST_WINDOW_START = "2015-12-31"
BUSINESS_ZONE = "Asia/Bangkok"
DEFAULT_MANAGER = 1
ORDER_STATUSES = [(1, "Pending"), (2, "Rejected"), (3, "Completed")]
RAW_STATUS_TO_STATUS = {2: 1, 3: 2, 4: 3}
STAGING_RECORDS_PER_FILE = 200_000
# ----------------------------------------------------------------------------------------

STRING, INT, LONG, DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
PRICE, RATE, MONEY, TOTAL = T.DecimalType(10, 2), T.DecimalType(4, 2), T.DecimalType(15, 2), T.DecimalType(38, 2)


def _table(required: str = "", **columns: T.DataType) -> T.StructType:
    """Columns in the given order; those listed in ``required`` are NOT NULL."""
    names = set(required.split())
    return T.StructType([T.StructField(n, t, n not in names) for n, t in columns.items()])


def _all_required(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, False) for n, t in columns.items()])


# Raw dataset, before audit columns are added.
RAW = {
    "customers": _table(
        customer_id=STRING, first_name=STRING, last_name=STRING, phone=STRING, email=STRING,
        street=STRING, city=STRING, state=STRING, zip_code=STRING,
    ),
    "orders": _table(
        order_id=STRING, customer_id=STRING, order_status=INT, order_date=DATE,
        required_date=DATE, shipped_date=DATE, store_id=STRING, staff_id=STRING,
    ),
    "order_items": _table(
        order_id=STRING, item_id=INT, product_id=STRING, quantity=INT, list_price=PRICE, discount=RATE,
    ),
    "products": _table(
        product_id=STRING, product_name=STRING, brand_id=INT, category_id=INT, model_year=INT, list_price=PRICE,
    ),
    "staffs": _table(
        staff_id=STRING, first_name=STRING, last_name=STRING, email=STRING, phone=STRING,
        active=INT, store_id=STRING, manager_id=T.DoubleType(),
    ),
    "stores": _table(
        store_id=STRING, store_name=STRING, phone=STRING, email=STRING, street=STRING,
        city=STRING, state=STRING, zip_code=STRING,
    ),
    "brands": _table(brand_id=INT, brand_name=STRING),
    "categories": _table(category_id=INT, category_name=STRING),
    "stocks": _table(store_id=STRING, product_id=STRING, quantity=INT),
}

_AUDIT = {"created_at": DATE, "updated_at": DATE, "is_active": STRING}

# Operational tables, as loaded after the bootstrap.
OPERATIONAL = {
    "stores": _table(
        "store_id store_name",
        store_id=STRING, store_name=STRING, phone=STRING, email=STRING, street=STRING,
        city=STRING, state=STRING, zip_code=STRING, **_AUDIT,
    ),
    "staffs": _table(
        "staff_id first_name last_name email store_id",
        staff_id=STRING, first_name=STRING, last_name=STRING, email=STRING, phone=STRING,
        store_id=STRING, manager_id=STRING, **_AUDIT,
    ),
    "categories": _all_required(category_id=INT, category_name=STRING),
    "brands": _all_required(brand_id=INT, brand_name=STRING),
    "products": _table(
        "product_id product_name brand_id category_id model_year list_price",
        product_id=STRING, product_name=STRING, brand_id=INT, category_id=INT,
        model_year=INT, list_price=PRICE, **_AUDIT,
    ),
    "customers": _table(
        "customer_id first_name last_name email",
        customer_id=STRING, first_name=STRING, last_name=STRING, phone=STRING, email=STRING,
        street=STRING, city=STRING, state=STRING, zip_code=STRING, **_AUDIT,
    ),
    "order_status": _all_required(order_status_id=INT, order_status=STRING),
    "orders": _table(
        "order_id customer_id order_status_id order_date required_date store_id staff_id",
        order_id=STRING, customer_id=STRING, order_status_id=INT, order_date=DATE,
        required_date=DATE, shipped_date=DATE, store_id=STRING, staff_id=STRING, updated_at=DATE,
    ),
    "order_items": _all_required(
        order_id=STRING, item_id=INT, product_id=STRING, quantity=INT, list_price=PRICE, discount=RATE,
    ),
    "stocks": _table(
        "store_id product_id", store_id=STRING, product_id=STRING, quantity=INT,
    ),
}

# Extracts: what one incremental extraction hands to staging. Everything may be NULL on read.
EXTRACT = {
    "customers": _table(
        customer_id=STRING, first_name=STRING, last_name=STRING, phone=STRING, email=STRING,
        street=STRING, city=STRING, state=STRING, zip_code=STRING, updated_at=DATE, is_active=STRING,
    ),
    "orders": _table(
        order_id=STRING, customer_id=STRING, order_status=STRING, order_date=DATE,
        required_date=DATE, shipped_date=DATE, store_id=STRING, staff_id=STRING,
        product_id=STRING, quantity=INT, list_price=PRICE, discount=RATE, updated_at=DATE,
    ),
    "products": _table(
        product_id=STRING, product_name=STRING, brand_name=STRING, category_name=STRING,
        model_year=INT, list_price=PRICE, updated_at=DATE, is_active=STRING,
    ),
    "staffs": _table(
        staff_id=STRING, first_name=STRING, last_name=STRING, email=STRING, phone=STRING,
        manager_id=STRING, updated_at=DATE, is_active=STRING,
    ),
    "stores": _table(
        store_id=STRING, store_name=STRING, phone=STRING, email=STRING, street=STRING,
        city=STRING, state=STRING, zip_code=STRING, updated_at=DATE, is_active=STRING,
    ),
}

_CALENDAR = dict(
    date_key=STRING, date=DATE, year=INT, month=INT, day=INT, quarter=INT,
    day_of_week=STRING, month_name=STRING, week_of_year=INT,
)

STAGING = {
    "customers": _table(
        "customer_id eff_date first_name last_name city state zip_code active_flag",
        customer_id=STRING, eff_date=DATE, first_name=STRING, last_name=STRING, phone=STRING,
        email=STRING, street=STRING, city=STRING, state=STRING, zip_code=STRING, active_flag=STRING,
    ),
    "stores": _all_required(
        store_id=STRING, eff_date=DATE, store_name=STRING, phone=STRING, email=STRING,
        street=STRING, city=STRING, state=STRING, zip_code=STRING, active_flag=STRING,
    ),
    "staffs": _all_required(
        staff_id=STRING, eff_date=DATE, first_name=STRING, last_name=STRING, email=STRING,
        phone=STRING, manager_id=STRING, active_flag=STRING,
    ),
    "products": _all_required(
        product_id=STRING, eff_date=DATE, product_name=STRING, brand_name=STRING,
        category_name=STRING, model_year=INT, list_price=PRICE, active_flag=STRING,
    ),
    "date": _all_required(**_CALENDAR),
    "sales": _table(
        "order_id product_id customer_id store_id staff_id order_date required_date order_status "
        "quantity discount_percent discount_amount total_price total_price_with_discount",
        order_id=STRING, product_id=STRING, customer_id=STRING, store_id=STRING, staff_id=STRING,
        order_date=STRING, required_date=STRING, shipped_date=STRING, rejected_date=STRING,
        order_status=STRING, quantity=INT, discount_percent=INT, discount_amount=MONEY,
        total_price=MONEY, total_price_with_discount=MONEY,
    ),
}

_VALIDITY = {"eff_date": DATE, "exp_date": DATE, "active_flag": STRING}

SERVING = {
    "dim_customers": _table(
        "customer_key customer_id first_name last_name city state zip_code eff_date exp_date active_flag",
        customer_key=LONG, customer_id=STRING, first_name=STRING, last_name=STRING, phone=STRING,
        email=STRING, street=STRING, city=STRING, state=STRING, zip_code=STRING, **_VALIDITY,
    ),
    "dim_stores": _all_required(
        store_key=LONG, store_id=STRING, store_name=STRING, phone=STRING, email=STRING,
        street=STRING, city=STRING, state=STRING, zip_code=STRING, **_VALIDITY,
    ),
    "dim_staffs": _all_required(
        staff_key=LONG, staff_id=STRING, first_name=STRING, last_name=STRING, email=STRING,
        phone=STRING, manager_id=STRING, **_VALIDITY,
    ),
    "dim_products": _all_required(
        product_key=LONG, product_id=STRING, product_name=STRING, brand_name=STRING,
        category_name=STRING, model_year=INT, list_price=PRICE, **_VALIDITY,
    ),
    "dim_date": _all_required(**_CALENDAR),
    "dim_order_status": _all_required(order_status_id=INT, order_status=STRING),
    "fact_sales": _table(
        "sales_id order_id product_key customer_key store_key staff_key order_date required_date "
        "order_status_id quantity discount_percent discount_amount total_price total_price_with_discount",
        sales_id=LONG, order_id=STRING, product_key=LONG, customer_key=LONG, store_key=LONG,
        staff_key=LONG, order_date=STRING, required_date=STRING, shipped_date=STRING,
        rejected_date=STRING, order_status_id=INT, quantity=INT, discount_percent=INT,
        discount_amount=MONEY, total_price=MONEY, total_price_with_discount=MONEY,
    ),
    # One narrow row per order in the fact, so that a run need not read the fact to know its orders.
    "fact_orders": _table(
        "order_id order_date", order_id=STRING, order_date=STRING, shipped_date=STRING, rejected_date=STRING,
    ),
    # Staged lines that name an id without any version yet.
    "pending_sales": STAGING["sales"],
    # The last change of each order that came as a stream, in the month of its order date.
    "order_register": _all_required(order_id=STRING, order_date=STRING, updated_at=DATE),
    # The order lines that have come as a stream in the last time, by minute of arrival.
    "recent_arrivals": EXTRACT["orders"],
    # The fact by month of order and surrogate key of one dimension (``grain``), and its orders by month and store, or by month alone.
    "sales_summary": _table("month grain key", month=STRING, grain=STRING, key=LONG, revenue=TOTAL, units=LONG),
    "order_summary": _table(
        "month grain orders shipped_orders late_orders",
        month=STRING, grain=STRING, key=LONG, orders=LONG, shipped_orders=LONG, late_orders=LONG,
    ),
}


@dataclass(frozen=True)
class Dimension:
    """One type-2 dimension: its natural key, surrogate key and the columns whose change opens a version."""

    name: str
    id: str
    key: str
    tracked: tuple[str, ...]
    null_as_empty: tuple[str, ...] = ()

    @property
    def table(self) -> str:
        return f"dim_{self.name}"

    @property
    def schema(self) -> T.StructType:
        return SERVING[self.table]


DIMENSIONS = {
    "customers": Dimension(
        "customers", "customer_id", "customer_key",
        ("first_name", "last_name", "phone", "email", "street", "city", "state", "zip_code"),
        null_as_empty=("phone", "email", "street"),
    ),
    "stores": Dimension(
        "stores", "store_id", "store_key",
        ("store_name", "phone", "email", "street", "city", "state", "zip_code"),
    ),
    "staffs": Dimension(
        "staffs", "staff_id", "staff_key",
        ("first_name", "last_name", "email", "phone", "manager_id"),
    ),
    "products": Dimension(
        "products", "product_id", "product_key",
        ("product_name", "brand_name", "category_name", "model_year", "list_price"),
    ),
}

# Hex digits of the buckets in which new rows of a table are numbered: 16**3 tasks at most. For batches beyond some ten
# billion rows give the table 4; its numbering depends on it, so it stays as it is once chosen.
KEY_DIGITS = {**{d.table: 3 for d in DIMENSIONS.values()}, "fact_sales": 3}

# Partitions by a hash of the id that a dimension's newest versions are split into: a run writes those that its batch touches. Aim at some
# hundred MB each; a table's layout depends on it, so it stays as it is once chosen.
DIMENSION_PARTITIONS = {d.table: 16 for d in DIMENSIONS.values()}

# Constraints, checked by jobs in operators.quality because parquet enforces none of them.
PRIMARY_KEYS = {
    "stores": ["store_id"], "staffs": ["staff_id"], "categories": ["category_id"],
    "brands": ["brand_id"], "products": ["product_id"], "customers": ["customer_id"],
    "order_status": ["order_status_id"], "orders": ["order_id"],
    "order_items": ["order_id", "item_id"], "stocks": ["store_id", "product_id"],
}

STAGING_KEYS = {
    "customers": ["customer_id", "eff_date"], "stores": ["store_id", "eff_date"],
    "staffs": ["staff_id", "eff_date"], "products": ["product_id", "eff_date"],
    "date": ["date_key"], "sales": ["order_id", "product_id"],
}

UNIQUE_COLUMNS = {"staffs": ["email"]}

# (child table, child column, parent table, parent column, what follows the parent key)
FOREIGN_KEYS = [
    ("staffs", "store_id", "stores", "store_id", "cascade"),
    ("staffs", "manager_id", "staffs", "staff_id", "keep"),
    ("products", "category_id", "categories", "category_id", "cascade"),
    ("products", "brand_id", "brands", "brand_id", "cascade"),
    ("orders", "customer_id", "customers", "customer_id", "cascade"),
    ("orders", "order_status_id", "order_status", "order_status_id", "rekey"),
    ("orders", "store_id", "stores", "store_id", "cascade"),
    ("orders", "staff_id", "staffs", "staff_id", "keep"),
    ("order_items", "order_id", "orders", "order_id", "cascade"),
    ("order_items", "product_id", "products", "product_id", "cascade"),
    ("stocks", "store_id", "stores", "store_id", "cascade"),
    ("stocks", "product_id", "products", "product_id", "cascade"),
]

# Text lengths, operational and (narrower) warehouse.
OPERATIONAL_LENGTHS = {
    "stores": {"store_id": 15, "store_name": 255, "phone": 25, "email": 255, "street": 255, "city": 255, "state": 10, "zip_code": 5, "is_active": 1},
    "staffs": {"staff_id": 15, "first_name": 50, "last_name": 50, "email": 255, "phone": 25, "store_id": 15, "manager_id": 15, "is_active": 1},
    "categories": {"category_name": 255},
    "brands": {"brand_name": 255},
    "products": {"product_id": 15, "product_name": 255, "is_active": 1},
    "customers": {"customer_id": 15, "first_name": 255, "last_name": 255, "phone": 25, "email": 255, "street": 255, "city": 50, "state": 25, "zip_code": 5, "is_active": 1},
    "order_status": {"order_status": 15},
    "orders": {"order_id": 15, "customer_id": 15, "store_id": 15, "staff_id": 15},
    "order_items": {"order_id": 15, "product_id": 15},
    "stocks": {"store_id": 15, "product_id": 15},
}

# Text lengths in the staging and serving layers, by column name; 255 otherwise.
_WAREHOUSE_LENGTH = {
    "customer_id": 15, "store_id": 15, "staff_id": 15, "product_id": 15, "order_id": 15,
    "manager_id": 15, "phone": 15, "order_status": 15, "state": 2, "zip_code": 5, "active_flag": 1,
    "date_key": 8, "order_date": 8, "required_date": 8, "shipped_date": 8, "rejected_date": 8,
    "day_of_week": 9, "month_name": 9,
}


def warehouse_lengths(table: T.StructType) -> dict[str, int]:
    """The length limit of every text column of a staging or serving table."""
    return {f.name: _WAREHOUSE_LENGTH.get(f.name, 255) for f in table.fields if f.dataType == STRING}


def required_columns(table: T.StructType) -> list[str]:
    return [f.name for f in table.fields if not f.nullable]
