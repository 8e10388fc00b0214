"""The registered queries as plain SQL over the given tables, written apart from the operators.

Shared with the Spark side are the mapping of the given tables (``given_tables``) and, from ``schemas``, column names, keys and lengths.
References are written out here.
"""

from __future__ import annotations

import re

from ..schemas import (
    EXTRACT,
    RAW,
    OPERATIONAL,
    OPERATIONAL_LENGTHS,
    PRIMARY_KEYS,
    STAGING,
    STAGING_KEYS,
    UNIQUE_COLUMNS,
    required_columns,
    warehouse_lengths,
)
from .given_tables import _HISTORY_SQL, AS_OF_SQL, EARLY_END, FIRST_END, FIRST_START, GIVEN, LEFT_SQL, RAW_SQL, SECOND_END
from .queries import CHANGE_DAY, CHANGED, CHANGES_SQL, DELIVERIES, GONE_SQL, RENAMES_SQL, SPOILED_SQL

START, END0, END1, END2, TODAY = (f"DATE '{d}'" for d in (FIRST_START, EARLY_END, FIRST_END, SECOND_END, CHANGE_DAY))
WINDOWS = {"1": (START, END1), "2": (END1, END2), "all": (START, END2), "early": (START, END0), "between": (END0, END1)}
OPEN = "DATE '9999-12-31'"

# --- operational tables -----------------------------------------------------------------

BOOTSTRAPPED_ORDERS = """
    SELECT order_id, customer_id, status AS order_status_id, order_date, required_date, shipped_date, store_id, staff_id,
           CASE status WHEN 3 THEN shipped_date WHEN 2 THEN required_date + 1 ELSE order_date END AS updated_at
    FROM (SELECT *, CASE order_status WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 ELSE order_status END AS status
          FROM {source}) o"""

CTE: dict[str, str] = {**RAW_SQL, **_HISTORY_SQL, **CHANGES_SQL, **{f"gone_{n}": t for n, t in GONE_SQL.items()}}
CTE["order_status"] = "SELECT * FROM (VALUES (1, 'Pending'), (2, 'Rejected'), (3, 'Completed')) v(order_status_id, order_status)"
CTE["all_orders"] = BOOTSTRAPPED_ORDERS.replace("{source}", "{raw_orders}")
for _n, _day in (("0", END0), ("1", END1), ("2", END2)):
    for _name in ("customers", "products", "staffs", "stores"):
        CTE[f"{_name}_{_n}"] = AS_OF_SQL[_name].replace("{day}", _day)
    CTE[f"orders_as_of_{_n}"] = AS_OF_SQL["orders_as_of"].replace("{day}", _day)
    CTE[f"orders_{_n}"] = BOOTSTRAPPED_ORDERS.replace("{source}", "{orders_as_of_" + _n + "}")

# --- extracts ---------------------------------------------------------------------------

_CONTACT = "phone, email, street, city, state, zip_code"
EXTRACT_COLUMNS = {
    "customers": f"customer_id, first_name, last_name, {_CONTACT}, updated_at, is_active",
    "staffs": "staff_id, first_name, last_name, email, phone, manager_id, updated_at, is_active",
    "stores": f"store_id, store_name, {_CONTACT}, updated_at, is_active",
}


def _extract(name: str, state: str, window: str) -> str:
    after, until = WINDOWS[window]
    inside = f"updated_at > {after} AND updated_at <= {until}"
    if name == "orders":
        return f"""
            SELECT o.order_id, o.customer_id, s.order_status, o.order_date, o.required_date, o.shipped_date, o.store_id,
                   o.staff_id, i.product_id, i.quantity, i.list_price, i.discount, o.updated_at
            FROM {{orders_{state}}} o JOIN {{order_status}} s ON o.order_status_id = s.order_status_id
            JOIN {{raw_order_items}} i ON o.order_id = i.order_id WHERE {inside}"""
    if name == "products":
        return f"""
            SELECT p.product_id, p.product_name, b.brand_name, c.category_name, p.model_year, p.list_price, p.updated_at,
                   p.is_active
            FROM {{products_{state}}} p JOIN {{raw_brands}} b ON p.brand_id = b.brand_id
            JOIN {{raw_categories}} c ON p.category_id = c.category_id WHERE {inside}"""
    return f"SELECT {EXTRACT_COLUMNS[name]} FROM {{{name}_{state}}} WHERE {inside}"


ENTITIES = {
    "customers": ("customer_id", "customer_key", "first_name last_name phone email street city state zip_code".split()),
    "stores": ("store_id", "store_key", "store_name phone email street city state zip_code".split()),
    "staffs": ("staff_id", "staff_key", "first_name last_name email phone manager_id".split()),
    "products": ("product_id", "product_key", "product_name brand_name category_name model_year list_price".split()),
}
MAY_BE_NULL = {"customers": {"phone", "email", "street"}}

for _name in (*ENTITIES, "orders"):
    CTE[f"x_{_name}_1"] = _extract(_name, "1", "1")
    CTE[f"x_{_name}_2"] = _extract(_name, "2", "2")
    CTE[f"x_{_name}_all"] = _extract(_name, "2", "all")
    CTE[f"x_{_name}_early"] = _extract(_name, "0", "early")
    CTE[f"x_{_name}_between"] = _extract(_name, "1", "between")

# --- staging ----------------------------------------------------------------------------


def _first(source: str, keys: str, ties: list[str], where: str = "TRUE", prefer: str = "") -> str:
    order = prefer + ", ".join(f"{c} ASC NULLS FIRST" for c in ties)
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS nth
                              FROM {source} WHERE {where}) d WHERE nth = 1"""


def _stage(name: str, source: str) -> str:
    key, _, columns = ENTITIES[name]
    free = MAY_BE_NULL.get(name, set())
    needed = [key, "updated_at", "is_active", *[c for c in columns if c not in free]]
    where = " AND ".join(f"{c} IS NOT NULL" for c in needed)
    shown = ", ".join("replace(product_name, '\"', '') AS product_name" if c == "product_name" else c for c in columns)
    picked = _first(source, f"{key}, updated_at", [*columns, "is_active"], where)
    return f"SELECT {key}, updated_at AS eff_date, {shown}, is_active AS active_flag FROM ({picked}) p"


MEASURED = """
    SELECT *, CAST(total_price - discount_amount AS DECIMAL(15,2)) AS total_price_with_discount FROM (
        SELECT *, CAST(total_price * discount AS DECIMAL(15,2)) AS discount_amount FROM (
            SELECT *, CAST(list_price * quantity AS DECIMAL(15,2)) AS total_price,
                   CAST(discount * 100 AS INT) AS discount_percent FROM ({lines}) a) b) c"""


def _sales(source: str, first: bool = True) -> str:
    needed = [
        "order_id", "customer_id", "order_status", "order_date", "required_date", "store_id", "staff_id", "product_id",
        "quantity", "list_price", "discount", "updated_at",
    ]
    where = " AND ".join(f"{c} IS NOT NULL" for c in needed)
    ties = [
        "customer_id", "order_status", "order_date", "required_date", "shipped_date", "store_id", "staff_id", "quantity",
        "list_price", "discount", "updated_at",
    ]
    lines = _first(source, "order_id, product_id", ties, where) if first else f"SELECT * FROM {source} WHERE {where}"
    return f"""
        SELECT order_id, product_id, customer_id, store_id, staff_id, strftime(order_date, '%Y%m%d') AS order_date,
               strftime(required_date, '%Y%m%d') AS required_date, strftime(shipped_date, '%Y%m%d') AS shipped_date,
               CASE WHEN order_status = 'Rejected' THEN strftime(updated_at, '%Y%m%d') END AS rejected_date,
               order_status, quantity, discount_percent, discount_amount, total_price, total_price_with_discount
        FROM ({MEASURED.replace("{lines}", lines)}) m"""


def _dates(source: str) -> str:
    roles = " UNION ".join(f"SELECT {c} AS d FROM {source}" for c in ("order_date", "required_date", "shipped_date", "updated_at"))
    return f"""
        SELECT strftime(d, '%Y%m%d') AS date_key, d AS date, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
               CAST(day(d) AS INT) AS day, CAST(quarter(d) AS INT) AS quarter, dayname(d) AS day_of_week,
               monthname(d) AS month_name, CAST(weekofyear(d) AS INT) AS week_of_year
        FROM ({roles}) u WHERE d IS NOT NULL"""


for _n in WINDOWS:
    for _name in ENTITIES:
        CTE[f"stg_{_name}_{_n}"] = _stage(_name, "{x_" + _name + "_" + _n + "}")
    CTE[f"stg_sales_{_n}"] = _sales("{x_orders_" + _n + "}")
    CTE[f"stg_date_{_n}"] = _dates("{x_orders_" + _n + "}")

# --- type-2 merge, closed form ----------------------------------------------------------


def _changed(name: str) -> str:
    free = MAY_BE_NULL.get(name, set())
    tests = [f"coalesce(d.{c}, '') <> coalesce(s.{c}, '')" if c in free else f"d.{c} <> s.{c}" for c in ENTITIES[name][2]]
    return "coalesce(" + " OR ".join(tests) + ", FALSE)"


def _merge(name: str, dim: str | None, staged: str, reactivate: bool = False) -> str:
    key, _, columns = ENTITIES[name]
    attributes = ", ".join(f"s.{c}" for c in columns)
    latest = _first(staged, key, [*columns, "active_flag"], prefer="eff_date DESC, ")
    opened = f"""
        SELECT s.{key}, {attributes}, s.eff_date,
               CASE WHEN s.active_flag = 'N' THEN s.eff_date ELSE {OPEN} END AS exp_date,
               CASE WHEN s.active_flag = 'N' THEN 'N' ELSE 'Y' END AS active_flag, TRUE AS is_new
        FROM ({latest}) s"""
    if dim is None:
        return opened
    kept = ", ".join(f"d.{c}" for c in [key, *columns, "eff_date"])
    known = f"SELECT {key} FROM {dim} WHERE active_flag = 'Y'" if reactivate else f"SELECT {key} FROM {dim}"
    return f"""
        SELECT {kept},
               CASE WHEN d.active_flag = 'N' OR s.{key} IS NULL THEN d.exp_date
                    WHEN {_changed(name)} THEN s.eff_date - 1
                    WHEN s.active_flag = 'N' THEN s.eff_date ELSE d.exp_date END AS exp_date,
               CASE WHEN d.active_flag = 'Y' AND s.{key} IS NOT NULL AND ({_changed(name)} OR s.active_flag = 'N')
                    THEN 'N' ELSE d.active_flag END AS active_flag, FALSE AS is_new
        FROM {dim} d LEFT JOIN ({latest}) s ON d.{key} = s.{key}
        UNION ALL {opened} WHERE s.{key} NOT IN ({known})
        UNION ALL {opened} JOIN {dim} d ON d.{key} = s.{key} AND d.active_flag = 'Y' WHERE {_changed(name)}"""


def _bucket(columns: str) -> str:
    return f"substr(md5(concat_ws('|', {columns})), 1, 3)"


for _name, (_id, _key, _columns) in ENTITIES.items():
    _order = _bucket(f"{_id}, CAST(eff_date AS VARCHAR)") + f", {_id}, eff_date"
    CTE[f"dim_{_name}_1"] = _merge(_name, None, "{stg_" + _name + "_1}")
    CTE[f"dim_{_name}_2"] = _merge(_name, "{dim_" + _name + "_1}", "{stg_" + _name + "_2}")
    CTE[f"keyed_{_name}_1"] = f"SELECT *, row_number() OVER (ORDER BY {_order}) AS {_key} FROM {{dim_{_name}_1}}"
    # Rows of the first run keep their key; new ones are numbered on from the highest.
    CTE[f"keyed_{_name}_2"] = f"""
        SELECT d.*, CASE WHEN d.is_new THEN (SELECT max({_key}) FROM {{keyed_{_name}_1}})
                              + row_number() OVER (PARTITION BY d.is_new ORDER BY {_order.replace(_id, "d." + _id).replace("eff_date", "d.eff_date")})
                         ELSE k.{_key} END AS {_key}
        FROM {{dim_{_name}_2}} d LEFT JOIN {{keyed_{_name}_1}} k ON NOT d.is_new AND k.{_id} = d.{_id} AND k.eff_date = d.eff_date"""

# --- fact -------------------------------------------------------------------------------

FACT = (
    "order_id, product_key, customer_key, store_key, staff_key, order_date, required_date, shipped_date, rejected_date, "
    "order_status_id, quantity, discount_percent, discount_amount, total_price, total_price_with_discount"
)


def _keyed(staged: str, run: str, join: str, where: str) -> str:
    joins = " ".join(
        f"{join} {{keyed_{name}_{run}}} {name} ON s.{key} = {name}.{key} "
        f"AND CAST(strptime(s.order_date, '%Y%m%d') AS DATE) BETWEEN {name}.eff_date AND {name}.exp_date"
        for name, (key, _, _) in ENTITIES.items()
    )
    return f"""
        SELECT s.*, customer_key, store_key, staff_key, product_key, order_status_id
        FROM {staged} s {joins} {join} {{order_status}} os ON s.order_status = os.order_status WHERE {where}"""


_SALES_ORDER = _bucket("order_id, CAST(product_key AS VARCHAR)") + ", order_id, product_key"
CTE["new_1"] = _keyed("{stg_sales_1}", "1", "JOIN", "TRUE")
CTE["fact_1"] = f"SELECT row_number() OVER (ORDER BY {_SALES_ORDER}) AS sales_id, {FACT} FROM {{new_1}}"
_UNSEEN = "s.order_id NOT IN (SELECT order_id FROM {fact_1})"
CTE["new_2"] = _keyed("{stg_sales_2}", "2", "JOIN", _UNSEEN)
CTE["inserted"] = f"""
    SELECT (SELECT max(sales_id) FROM {{fact_1}}) + row_number() OVER (ORDER BY {_SALES_ORDER}) AS sales_id, {FACT}
    FROM {{new_2}}"""


def _updated(fact: str, staged: str) -> str:
    return f"""
    SELECT f.* REPLACE (CASE WHEN moved THEN u.shipped_date ELSE f.shipped_date END AS shipped_date,
                        CASE WHEN moved THEN u.rejected_date ELSE f.rejected_date END AS rejected_date,
                        CASE WHEN moved THEN u.order_status_id ELSE f.order_status_id END AS order_status_id)
    FROM {fact} f LEFT JOIN (
        SELECT DISTINCT s.order_id, s.shipped_date, s.rejected_date, o.order_status_id
        FROM {staged} s JOIN {{order_status}} o ON s.order_status = o.order_status) u ON f.order_id = u.order_id
    CROSS JOIN LATERAL (SELECT u.order_id IS NOT NULL AND (
        coalesce(f.shipped_date, '9999-12-31') <> coalesce(u.shipped_date, '9999-12-31')
        OR coalesce(f.rejected_date, '9999-12-31') <> coalesce(u.rejected_date, '9999-12-31')) AS moved) m"""


CTE["updated"] = _updated("{fact_1}", "{stg_sales_2}")
CTE["fact_2"] = "SELECT * FROM {updated} UNION ALL SELECT * FROM {inserted}"
# Three runs in which lines wait for their ids. A line older than the first version of an id takes that version.
_LATE_WINDOWS = ("early", "between", "2")
_ID = {name: key for name, (key, _, _) in ENTITIES.items()}
for _r, _window in enumerate(_LATE_WINDOWS):
    for _name, _id in _ID.items():
        CTE[f"late_{_name}_{_r}"] = _merge(_name, "{late_" + f"{_name}_{_r - 1}" + "}" if _r else None, "{stg_" + f"{_name}_{_window}" + "}")
    _stg, _was = "{stg_sales_" + _window + "}", "{late_wait_" + str(_r - 1) + "}"
    CTE[f"late_lines_{_r}"] = f"SELECT * FROM {_stg}" if not _r else f"""
        SELECT s.* FROM {_stg} s SEMI JOIN {_was} w ON s.order_id = w.order_id AND s.product_id = w.product_id
        UNION ALL SELECT w.* FROM {_was} w ANTI JOIN {_stg} s ON s.order_id = w.order_id AND s.product_id = w.product_id
        UNION ALL SELECT s.* FROM {_stg} s ANTI JOIN {_was} w ON s.order_id = w.order_id AND s.product_id = w.product_id
                  WHERE s.order_id NOT IN (SELECT order_id FROM {{late_fact_{_r - 1}}})"""
    _joins = " ".join(
        f"""LEFT JOIN (SELECT {i}, exp_date, eff_date,
                              CASE WHEN eff_date = min(eff_date) OVER (PARTITION BY {i}) THEN DATE '0001-01-01' ELSE eff_date END AS since
                       FROM {{late_{n}_{_r}}}) {n}
            ON l.{i} = {n}.{i} AND CAST(strptime(l.order_date, '%Y%m%d') AS DATE) BETWEEN {n}.since AND {n}.exp_date"""
        for n, i in _ID.items()
    )
    CTE[f"late_met_{_r}"] = f"""
        SELECT l.*, o.order_status_id, {", ".join(f"{n}.eff_date AS {n}_since" for n in _ID)}
        FROM {{late_lines_{_r}}} l {_joins} LEFT JOIN {{order_status}} o ON l.order_status = o.order_status"""
    CTE[f"late_wait_{_r}"] = f"""
        SELECT * EXCLUDE (order_status_id, {", ".join(f"{n}_since" for n in _ID)}) FROM {{late_met_{_r}}} l
        WHERE order_status_id IS NOT NULL AND ({" OR ".join(f"{n}_since IS NULL" for n in _ID)})
          AND {" AND ".join(f"({n}_since IS NOT NULL OR {i} NOT IN (SELECT {i} FROM {{late_{n}_{_r}}}))" for n, i in _ID.items())}"""
    CTE[f"late_new_{_r}"] = f"""
        SELECT * EXCLUDE (order_status) FROM {{late_met_{_r}}}
        WHERE order_status_id IS NOT NULL AND {" AND ".join(f"{n}_since IS NOT NULL" for n in _ID)}"""
    CTE[f"late_fact_{_r}"] = f"SELECT * FROM {{late_new_{_r}}}" + (
        f" UNION ALL BY NAME SELECT * FROM ({_updated('{late_fact_' + str(_r - 1) + '}', _stg)}) u" if _r else ""
    )

CTE["dim_date_2"] = "SELECT * FROM {stg_date_1} UNION SELECT * FROM {stg_date_2}"

# --- reports ----------------------------------------------------------------------------

_TOTALS = (
    "CAST(sum(total_price_with_discount) AS DECIMAL(38,2)) AS revenue, CAST(sum(quantity) AS BIGINT) AS units"
)


def _newest(name: str, columns: list[str]) -> str:
    key, surrogate, _ = ENTITIES[name]
    return f"""SELECT {key}, {", ".join(columns)} FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY eff_date DESC, exp_date DESC, {surrogate} DESC) AS nth
        FROM {{keyed_{name}_2}}) v WHERE nth = 1"""


def _per_entity(name: str, columns: list[str]) -> str:
    key, surrogate, _ = ENTITIES[name]
    return f"""SELECT t.{key}, {", ".join(columns)}, revenue, units FROM (
        SELECT {key}, {_TOTALS} FROM {{fact_2}} f JOIN {{keyed_{name}_2}} d ON f.{surrogate} = d.{surrogate}
        GROUP BY {key}) t JOIN ({_newest(name, columns)}) n ON t.{key} = n.{key}"""


REPORTS = {
    "sales_monthly_trend": f"""
        SELECT *, CAST(revenue - lag(revenue) OVER (ORDER BY year, month) AS DECIMAL(38,2)) AS revenue_change,
               CAST(rank() OVER (ORDER BY revenue DESC) AS INT) AS revenue_rank
        FROM (SELECT year, month, month_name, {_TOTALS}, count(DISTINCT order_id) AS orders
              FROM {{fact_2}} JOIN {{dim_date_2}} ON order_date = date_key GROUP BY year, month, month_name) m""",
    "late_delivery_by_store": f"""
        SELECT t.store_id, store_name, orders, shipped_orders, late_orders,
               round(CAST(late_orders AS DOUBLE) / nullif(shipped_orders, 0), 4) AS late_share
        FROM (SELECT store_id, count(DISTINCT order_id) AS orders,
                     count(DISTINCT CASE WHEN shipped_date IS NOT NULL THEN order_id END) AS shipped_orders,
                     count(DISTINCT CASE WHEN shipped_date > required_date THEN order_id END) AS late_orders
              FROM {{fact_2}} f JOIN {{keyed_stores_2}} d ON f.store_key = d.store_key GROUP BY store_id) t
        JOIN ({_newest("stores", ["store_name"])}) n ON t.store_id = n.store_id""",
    "top_products": f"""
        {_per_entity("products", ["product_name", "brand_name"])} ORDER BY revenue DESC, units DESC, product_id LIMIT 10""",
    "brand_ranking": f"""
        SELECT *, CAST(rank() OVER (ORDER BY revenue DESC) AS INT) AS revenue_rank,
               CAST(rank() OVER (ORDER BY units DESC) AS INT) AS units_rank
        FROM (SELECT brand_name, {_TOTALS} FROM {{fact_2}} f JOIN {{keyed_products_2}} d ON f.product_key = d.product_key
              GROUP BY brand_name) b""",
    "unsold_products": f"""
        SELECT product_id, product_name, brand_name FROM ({_newest("products", ["product_name", "brand_name"])}) p
        WHERE product_id NOT IN (SELECT product_id FROM {{keyed_products_2}}
                                 WHERE product_key IN (SELECT product_key FROM {{fact_2}}))""",
    "customers_by_state": """
        SELECT state, count(*) AS customers FROM {dim_customers_2} WHERE active_flag = 'Y' GROUP BY state""",
    "top_spenders": f"""
        {_per_entity("customers", ["first_name", "last_name", "state"])}
        ORDER BY revenue DESC, units DESC, customer_id LIMIT 10""",
    "store_performance": f"""
        SELECT *, CAST(rank() OVER (ORDER BY revenue DESC) AS INT) AS revenue_rank
        FROM ({_per_entity("stores", ["store_name", "state"])}) p""",
    "staff_chains": """
        SELECT * FROM (
            WITH RECURSIVE above AS (
                SELECT staff_id, 1 AS level, manager_id, [staff_id, manager_id] AS way, staff_id = manager_id AS is_cycle
                FROM {staffs_2} WHERE manager_id IS NOT NULL
                UNION ALL
                SELECT a.staff_id, a.level + 1, s.manager_id, list_append(a.way, s.manager_id), list_contains(a.way, s.manager_id)
                FROM above a JOIN {staffs_2} s ON s.staff_id = a.manager_id WHERE NOT a.is_cycle AND s.manager_id IS NOT NULL
            )
            SELECT staff_id, level, manager_id, array_to_string(way, '>') AS path, is_cycle FROM above) r""",
    "staff_hierarchy": """
        SELECT s.staff_id, s.first_name, s.last_name, s.manager_id, m.first_name AS manager_first_name,
               m.last_name AS manager_last_name
        FROM {staffs_2} s LEFT JOIN {staffs_2} m ON s.manager_id = m.staff_id""",
}

_MONTH = "substr(order_date, 1, 6)"
_COUNTED = """count(DISTINCT order_id) AS orders, count(DISTINCT CASE WHEN shipped_date IS NOT NULL THEN order_id END) AS shipped_orders,
              count(DISTINCT CASE WHEN shipped_date > required_date THEN order_id END) AS late_orders"""
SUMMARIES = {
    "summary_of_sales": " UNION ALL ".join(
        f"SELECT {_MONTH} AS month, '{n}' AS grain, {ENTITIES[n][1]} AS key, {_TOTALS} FROM {{fact_2}} GROUP BY ALL"
        for n in ("customers", "products", "stores")
    ),
    "summary_of_orders": f"""
        SELECT {_MONTH} AS month, 'stores' AS grain, store_key AS key, {_COUNTED} FROM {{fact_2}} GROUP BY ALL
        UNION ALL SELECT {_MONTH}, 'months', CAST(NULL AS BIGINT), {_COUNTED} FROM {{fact_2}} GROUP BY ALL""",
    # Months of rows that the second run added, changed or took away.
    "summary_touched_months": f"""
        SELECT DISTINCT {_MONTH} AS month FROM (
            (SELECT * FROM {{fact_2}} EXCEPT SELECT * FROM {{fact_1}}) UNION ALL (SELECT * FROM {{fact_1}} EXCEPT SELECT * FROM {{fact_2}})) f""",
    **{
        f"summary_{n}": REPORTS[n]
        for n in (
            "sales_monthly_trend", "late_delivery_by_store", "top_products", "brand_ranking", "unsold_products", "top_spenders", "store_performance",
        )
    },
}

# --- change capture and checks ----------------------------------------------------------

_CUSTOMER_COLUMNS = ENTITIES["customers"][2]
CTE["bootstrap_customers"] = """
    SELECT c.*, first AS created_at, first AS updated_at, 'Y' AS is_active
    FROM {raw_customers} c
    JOIN (SELECT customer_id, min(order_date) AS first FROM {raw_orders} GROUP BY customer_id) o
      ON c.customer_id = o.customer_id"""


def _folded(changes: str, key: str, columns: list[str]) -> str:
    """First insert, last update and last delete per key."""
    return f"""
        SELECT {key}, min(seq) FILTER (WHERE op = 'I') AS i_seq, max(seq) FILTER (WHERE op = 'U') AS u_seq,
               max(seq) FILTER (WHERE op = 'D') AS d_seq,
               {", ".join(f"arg_min({c}, seq) FILTER (WHERE op = 'I') AS i_{c}" for c in columns)},
               {", ".join(f"arg_max({c}, seq) FILTER (WHERE op = 'U') AS u_{c}" for c in columns)}
        FROM {changes} GROUP BY {key}"""


CTE["folded_customers"] = _folded("{customer_changes}", "customer_id", _CUSTOMER_COLUMNS)
_ORDER_COLUMNS = [
    "customer_id", "order_status_id", "order_date", "required_date", "shipped_date", "store_id", "staff_id",
]
CTE["order_deletes"] = "SELECT order_id, max(seq) AS last FROM {order_changes} WHERE op = 'D' GROUP BY order_id"
CTE["live_changes"] = """
    SELECT c.* FROM {order_changes} c LEFT JOIN {order_deletes} d ON c.order_id = d.order_id
    WHERE d.last IS NULL OR c.seq > d.last"""
CTE["folded_orders"] = _folded("{live_changes}", "order_id", _ORDER_COLUMNS)
CTE["kept_orders"] = "SELECT * FROM {all_orders} WHERE order_id NOT IN (SELECT order_id FROM {order_deletes})"


def _choose(test: str, columns: list[str], when: str, otherwise: str) -> str:
    return ", ".join(f"CASE WHEN {test} THEN {when}{c} ELSE {otherwise}{c} END AS {c}" for c in columns)


CDC = {
    "cdc_apply_changes": f"""
        SELECT c.customer_id, {_choose("u_seq IS NOT NULL", _CUSTOMER_COLUMNS, "u_", "c.")}, created_at,
               CASE WHEN u_seq IS NOT NULL OR d_seq IS NOT NULL THEN {TODAY} ELSE updated_at END AS updated_at,
               CASE WHEN d_seq IS NOT NULL THEN 'N' ELSE is_active END AS is_active
        FROM {{bootstrap_customers}} c LEFT JOIN {{folded_customers}} f ON c.customer_id = f.customer_id
        UNION ALL
        SELECT customer_id, {_choose("u_seq > i_seq", _CUSTOMER_COLUMNS, "u_", "i_")}, {TODAY}, {TODAY},
               CASE WHEN d_seq > i_seq THEN 'N' ELSE 'Y' END
        FROM {{folded_customers}}
        WHERE i_seq IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM {{bootstrap_customers}})""",
    "cdc_soft_delete": f"""
        SELECT * EXCLUDE (hit) REPLACE (CASE WHEN hit THEN {TODAY} ELSE updated_at END AS updated_at,
                                         CASE WHEN hit THEN 'N' ELSE is_active END AS is_active)
        FROM (SELECT *, customer_id IN (SELECT customer_id FROM {{customer_changes}} WHERE op = 'D') AS hit
              FROM {{bootstrap_customers}}) c""",
    "cdc_order_changes": f"""
        SELECT o.order_id, {_choose("u_seq IS NOT NULL", _ORDER_COLUMNS, "u_", "o.")},
               CASE WHEN u_seq IS NOT NULL THEN {TODAY} ELSE updated_at END AS updated_at
        FROM {{kept_orders}} o LEFT JOIN {{folded_orders}} f ON o.order_id = f.order_id
        UNION ALL
        SELECT order_id, {_choose("u_seq > i_seq", _ORDER_COLUMNS, "u_", "i_")}, {TODAY}
        FROM {{folded_orders}} WHERE i_seq IS NOT NULL AND order_id NOT IN (SELECT order_id FROM {{kept_orders}})""",
    "etl_window_dates": f"""
        SELECT "current_date", coalesce(max(CASE WHEN ok THEN "current_date" END) OVER (
                   ORDER BY "current_date" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {START}) AS previous_date,
               runs, ok AS succeeded
        FROM (SELECT CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Bangkok' AS DATE) AS "current_date", count(*) AS runs,
                     bool_or(value > 300) AS ok FROM {{events}} GROUP BY 1) d""",
    "cascade_retain": """
        SELECT * FROM {raw_order_items} WHERE order_id IN (SELECT order_id FROM {orders_1})""",
    "dq_never_extracted": """
        SELECT order_status_id, count(*) AS orders FROM {orders_2} WHERE updated_at IS NULL GROUP BY order_status_id""",
    "cascade_rekey": """
        SELECT i.* REPLACE (coalesce(new_key, product_id) AS product_id)
        FROM {raw_order_items} i LEFT JOIN {renamed_products} r ON i.product_id = r.old_key""",
}

# Deliveries of changes: one counts if it is later than all of its key in the deliveries before.
_CHANGED_TABLES = {"customers": "bootstrap_customers", "stores": "boot_stores", "staffs": "boot_staffs", "products": "boot_products"}
_PAYLOAD = {
    "customers": _CUSTOMER_COLUMNS, "stores": ENTITIES["stores"][2],
    "staffs": "first_name last_name email phone store_id manager_id".split(),
    "products": "product_name brand_id category_id model_year list_price".split(),
}
for _name, _changes in CHANGED.items():
    _key, _columns = ENTITIES[_name][0], _PAYLOAD[_name]
    CTE[f"delivered_{_name}"] = " UNION ALL ".join(
        f"SELECT {n} AS step, DATE '{day}' AS day, c.* FROM ("
        + CHANGES_SQL[_changes].replace("{events}", f"(SELECT * FROM {{events}} WHERE {part}) e") + ") c"
        for n, (day, part) in enumerate(DELIVERIES)
    )
    CTE[f"counted_{_name}"] = f"""
        SELECT * FROM (SELECT *, max(seq) OVER (PARTITION BY {_key} ORDER BY step RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held
                       FROM {{delivered_{_name}}}) d WHERE held IS NULL OR seq > held"""
    CTE[f"changed_{_name}"] = f"""
        SELECT f.*, i_day, c_day, c_seq FROM ({_folded("{counted_" + _name + "}", _key, _columns)}) f
        JOIN (SELECT {_key}, arg_min(day, seq) FILTER (WHERE op = 'I') AS i_day, arg_max(day, seq) FILTER (WHERE op <> 'I') AS c_day,
                     max(seq) FILTER (WHERE op <> 'I') AS c_seq
              FROM {{counted_{_name}}} GROUP BY {_key}) g ON f.{_key} = g.{_key}"""
    CDC[f"cdc_replayed_{_name}"] = f"""
        SELECT c.{_key}, {_choose("u_seq IS NOT NULL", _columns, "u_", "c.")}, created_at,
               coalesce(c_day, updated_at) AS updated_at, CASE WHEN d_seq IS NOT NULL THEN 'N' ELSE is_active END AS is_active
        FROM {{{_CHANGED_TABLES[_name]}}} c LEFT JOIN {{changed_{_name}}} f ON c.{_key} = f.{_key}
        UNION ALL
        SELECT {_key}, {_choose("u_seq > i_seq", _columns, "u_", "i_")}, i_day, CASE WHEN c_seq > i_seq THEN c_day ELSE i_day END,
               CASE WHEN d_seq > i_seq THEN 'N' ELSE 'Y' END
        FROM {{changed_{_name}}}
        WHERE i_seq IS NOT NULL AND {_key} NOT IN (SELECT {_key} FROM {{{_CHANGED_TABLES[_name]}}})"""
CDC["cdc_change_register"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, {ENTITIES[n][0]} AS key, max(seq) AS last_seq FROM {{delivered_{n}}} GROUP BY ALL" for n in CHANGED
)

# Spoiled extracts: what is wrong with a line, in the order of its columns.
_BAD = {"order_date": "store_id = '3'", "quantity": "discount = 0.05", "list_price": "quantity = 7"}
_FILES = {"x_orders_1": f"{FIRST_END:%Y%m%d}-orders.csv", "x_orders_2": f"{SECOND_END:%Y%m%d}-orders.csv"}
for _name in _FILES:
    _why = ", ".join(f"CASE WHEN {t} THEN '{c}' END" for c, t in _BAD.items())
    CTE[f"why_{_name}"] = f"SELECT *, concat_ws(',', {_why}) AS misfit FROM {{{_name}}}"
    CTE[f"spoiled_{_name}"] = SPOILED_SQL.replace("{extract}", f"{{why_{_name}}}").replace("SELECT", "SELECT misfit,", 1)
CDC["csv_fitting_rows"] = " UNION ALL ".join(
    f"SELECT *, '{f}' AS file FROM {{{n}}} WHERE NOT ({' OR '.join(_BAD.values())})" for n, f in _FILES.items()
)
CTE["spoiled_all"] = SPOILED_SQL.replace("{extract}", "{x_orders_all}")
CDC["parsed_dates"] = """
    SELECT order_id, product_id, quantity, order_date AS text, TRY_CAST(order_date AS DATE) AS order_date FROM {spoiled_all}"""
CDC["csv_misfits"] = " UNION ALL ".join(
    f"""SELECT '{f}' AS file, concat_ws(',', {", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in EXTRACT["orders"].names)}) AS line, misfit
        FROM {{spoiled_{n}}} s WHERE misfit <> ''"""
    for n, f in _FILES.items()
)

# The operational tables at the end of the second window, by name.
_STATE = {n: "{" + n + "_2}" for n in ("customers", "products", "staffs", "stores", "orders")} | {
    "order_items": "{raw_order_items}", "order_status": "{order_status}", "brands": "{raw_brands}",
    "categories": "{raw_categories}", "stocks": "{raw_stocks}",
}


_STAGED = {n: "{stg_" + n + "_2}" for n in STAGING}


def _dq_keys(keys: list[tuple[str, list[str]]], state: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{",".join(k)}' AS key, count(*) AS repeated, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows
            FROM (SELECT count(*) AS n FROM {state[t]} GROUP BY {", ".join(k)} HAVING count(*) > 1) g"""
        for t, k in keys
    )


def _left(table: str) -> str:
    return f"(SELECT * FROM {_STATE[table]} WHERE {LEFT_SQL[table]})" if table in LEFT_SQL else _STATE[table]


# Fixed values, written out apart from the schemas: child, column, parent, parent's key, whether the child follows a delete.
REFERENCES = [
    ("staffs", "store_id", "stores", "store_id", True), ("staffs", "manager_id", "staffs", "staff_id", False),
    ("products", "category_id", "categories", "category_id", True), ("products", "brand_id", "brands", "brand_id", True),
    ("orders", "customer_id", "customers", "customer_id", True),
    ("orders", "order_status_id", "order_status", "order_status_id", False),
    ("orders", "store_id", "stores", "store_id", True), ("orders", "staff_id", "staffs", "staff_id", False),
    ("order_items", "order_id", "orders", "order_id", True), ("order_items", "product_id", "products", "product_id", True),
    ("stocks", "store_id", "stores", "store_id", True), ("stocks", "product_id", "products", "product_id", True),
]


def _dq_references() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{child}' AS child, '{column}' AS child_column, '{parent}' AS parent, count(DISTINCT {column}) AS orphans,
                   count({column}) AS rows
            FROM {_left(child)} c WHERE {column} NOT IN (SELECT {key} FROM {_left(parent)} p)"""
        for child, column, parent, key, _ in REFERENCES
    )


# What is left of each table when children have followed their parents; parents first.
for _name in ("stores", "staffs", "categories", "brands", "products", "customers", "order_status", "orders", "order_items", "stocks"):
    _gone = [f"{c} NOT IN (SELECT {k} FROM {{left_{p}}})" for t, c, p, k, follows in REFERENCES if t == _name and follows]
    CTE[f"left_{_name}"] = f"SELECT * FROM {_left(_name)} t" + "".join(f" WHERE NOT coalesce({' OR '.join(_gone)}, FALSE)" for _ in _gone[:1])


# Renames that are carried out, and those that are not with the reason; judged on the tables before.
_KEY = {"stores": "store_id", "products": "product_id", "customers": "customer_id", "orders": "order_id", "order_status": "order_status_id",
        "brands": "brand_id", "categories": "category_id", "staffs": "staff_id"}
# The state that the renames start from, as named parts.
_BEFORE = {n: t.strip("{}") for n, t in _STATE.items()}
for _name, _text in RENAMES_SQL.items():
    CTE[f"renames_{_name}"] = _text.replace("{" + _name + "}", "{" + _BEFORE[_name] + "}")
    _used = [f"SELECT {c} FROM {_STATE[t]}" for t, c, p in (("staffs", "manager_id", "staffs"), ("orders", "staff_id", "staffs")) if p == _name]
    CTE[f"judged_{_name}"] = f"""
        SELECT old_key, new_key,
               CASE WHEN old_key IS NULL OR new_key IS NULL THEN 'no key'
                    WHEN old_key NOT IN (SELECT {_KEY[_name]} FROM {_STATE[_name]}) THEN 'not there'
                    WHEN (SELECT count(*) FROM {{renames_{_name}}} o WHERE o.old_key = r.old_key) > 1
                      OR (SELECT count(*) FROM {{renames_{_name}}} o WHERE o.new_key = r.new_key) > 1 THEN 'repeated'
                    WHEN new_key IN (SELECT {_KEY[_name]} FROM {_STATE[_name]}) THEN 'taken'
                    {"".join(f"WHEN old_key IN ({u}) THEN 'referenced' " for u in _used)} END AS reason
        FROM (SELECT DISTINCT old_key, new_key FROM {{renames_{_name}}}) r"""
    CTE[f"accepted_{_name}"] = f"SELECT old_key, new_key FROM {{judged_{_name}}} WHERE reason IS NULL"

# Fixed values, written out apart from the schemas: the columns that follow a rename of a table's key.
_FOLLOWING = {
    "stores": {"store_id": "stores"}, "staffs": {"staff_id": "staffs", "store_id": "stores"}, "categories": {"category_id": "categories"},
    "brands": {"brand_id": "brands"}, "products": {"product_id": "products", "category_id": "categories", "brand_id": "brands"},
    "customers": {"customer_id": "customers"}, "order_status": {"order_status_id": "order_status"},
    "orders": {"order_id": "orders", "customer_id": "customers", "order_status_id": "order_status", "store_id": "stores"},
    "order_items": {"order_id": "orders", "product_id": "products"}, "stocks": {"store_id": "stores", "product_id": "products"},
}
for _name, _columns in _FOLLOWING.items():
    _new = ", ".join(f"coalesce({c}_r.new_key, t.{c}) AS {c}" for c in _columns)
    _joins = "".join(f" LEFT JOIN {{accepted_{p}}} {c}_r ON t.{c} = {c}_r.old_key" for c, p in _columns.items())
    CTE[f"rekeyed_{_name}"] = f"SELECT t.* REPLACE ({_new}) FROM {_STATE[_name]} t{_joins}"


def _digests(tables: dict[str, tuple[str, list[str]]]) -> str:
    """Per table and first byte of a row's digest: rows, smallest and largest digest. Given: source and columns of each table."""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, substr(r, 1, 2) AS bucket, count(*) AS rows, min(r) AS low, max(r) AS high,
                   CAST(sum(CAST('0x' || substr(r, 3, 8) AS BIGINT)) AS BIGINT) AS total
            FROM (SELECT md5(concat_ws('|', {", ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in sorted(columns))})) AS r
                  FROM {source} s) d GROUP BY 2"""
        for name, (source, columns) in tables.items()
    )


def _dq_columns(schemas: dict, lengths: dict[str, dict[str, int]], state: dict[str, str]) -> str:
    rules = []
    for table in schemas:
        rules += [(table, c, "not null", f"{c} IS NULL") for c in required_columns(schemas[table])]
        rules += [(table, c, "length", f"length({c}) > {n}") for c, n in lengths[table].items()]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{r}' AS rule, count(*) AS violations FROM {state[t]} WHERE {bad}"
        for t, c, r, bad in rules
    )


# --- the queries ------------------------------------------------------------------------


def _constant(source: str, table: str) -> str:
    first = "DATE '2016-01-01'"
    return f"SELECT {source}, {first} AS created_at, {first} AS updated_at, 'Y' AS is_active FROM {table}"


def _replayed(name: str) -> str:
    key, _, columns = ENTITIES[name]
    return _stage(name, "(SELECT * FROM {x_" + name + "_1} UNION ALL SELECT * FROM {x_" + name + "_all}) r")


def _natural(name: str, source: str) -> str:
    key, _, columns = ENTITIES[name]
    return f"SELECT {key}, {', '.join(columns)}, eff_date, exp_date, active_flag FROM {source}"


CTE["products_again"] = _merge("products", "{dim_products_2}", "{stg_products_2}")
CTE["products_reactivated"] = _merge("products", "{dim_products_1}", "{stg_products_2}", reactivate=True)

CTE["boot_staffs"] = _constant(
    "staff_id, first_name, last_name, email, phone, store_id, "
    "CAST(CAST(coalesce(manager_id, 1) AS INT) AS VARCHAR) AS manager_id", "{raw_staffs}",
)
CTE["boot_products"] = _constant("*", "{raw_products}")
CTE["boot_stores"] = _constant("*", "{raw_stores}")


def _two_days(name: str) -> str:
    """Both windows' staging tables with their days, as CSV hands them over."""
    shown = "* REPLACE (nullif(phone, '') AS phone)" if name == "customers" else "*"
    return " UNION ALL ".join(f"SELECT {shown}, {day} AS run_date FROM {{stg_{name}_{n}}}" for n, day in (("1", END1), ("2", END2)))


SQL: dict[str, str] = {
    **{f"extract_{n}_window": f"SELECT * FROM {{x_{n}_2}}" for n in (*ENTITIES, "orders")},
    "bootstrap_customers": "SELECT * FROM {bootstrap_customers}",
    **{f"bootstrap_{n}": f"SELECT * FROM {{boot_{n}}}" for n in ("staffs", "products", "stores")},
    "bootstrap_orders": "SELECT * FROM {all_orders}",
    "order_status_lookup": """
        SELECT s.order_status_id, s.order_status, n AS orders FROM {order_status} s
        LEFT JOIN (SELECT order_status_id, count(*) AS n FROM {all_orders} GROUP BY order_status_id) o
          ON s.order_status_id = o.order_status_id""",
    **{f"stg_{n}": _replayed(n) for n in ENTITIES},
    "stg_date": "SELECT * FROM {stg_date_all}",
    "stg_sales": "SELECT * FROM {stg_sales_all}",
    "stg_sales_summed": f"""
        SELECT *, CAST(CASE WHEN total_price = 0 THEN 0
                            ELSE (CAST(discount_amount * 100 AS BIGINT) * 200 + CAST(total_price * 100 AS BIGINT))
                                 // (2 * CAST(total_price * 100 AS BIGINT)) END AS INT) AS discount_percent
        FROM (SELECT order_id, product_id, customer_id, store_id, staff_id, order_date, required_date, shipped_date, rejected_date,
                     order_status, CAST(sum(quantity) AS INT) AS quantity,
                     CAST(sum(discount_amount) AS DECIMAL(15,2)) AS discount_amount, CAST(sum(total_price) AS DECIMAL(15,2)) AS total_price,
                     CAST(sum(total_price_with_discount) AS DECIMAL(15,2)) AS total_price_with_discount
              FROM ({_sales("{x_orders_all}", first=False)}) s GROUP BY ALL) t""",
    **{f"scd2_{n}": _natural(n, "{dim_" + n + "_2}") for n in ENTITIES},
    "scd2_second_batch": _natural("products", "{products_again}"),
    "scd2_reactivated": _natural("products", "{products_reactivated}"),
    "dim_date_append": """
        SELECT * FROM {stg_date_2} s WHERE NOT EXISTS (SELECT 1 FROM {stg_date_1} d WHERE d.date_key = s.date_key)""",
    # Rows the second run has to write: all but the history that the first run had closed.
    "dim_customer_keys": """
        SELECT customer_key, customer_id, eff_date, exp_date, active_flag FROM {keyed_customers_2}
        WHERE customer_key NOT IN (SELECT customer_key FROM {keyed_customers_1} WHERE active_flag = 'N')""",
    "fact_insert": "SELECT * FROM {inserted}",
    "fact_rejected_rows": f"""
        SELECT * EXCLUDE (customer_key, store_key, staff_key, product_key, order_status_id),
               concat_ws(',', CASE WHEN customer_key IS NULL THEN 'customer_key' END,
                              CASE WHEN store_key IS NULL THEN 'store_key' END,
                              CASE WHEN staff_key IS NULL THEN 'staff_key' END,
                              CASE WHEN product_key IS NULL THEN 'product_key' END,
                              CASE WHEN order_status_id IS NULL THEN 'order_status_id' END) AS missing
        FROM ({_keyed("{stg_sales_2}", "2", "LEFT JOIN", _UNSEEN)}) k
        WHERE customer_key IS NULL OR store_key IS NULL OR staff_key IS NULL OR product_key IS NULL
           OR order_status_id IS NULL""",
    "fact_update": "SELECT * FROM {updated}",
    "end_to_end_star": "SELECT * FROM {fact_2}",
    "end_to_end_late_arrivals": "SELECT * FROM {late_fact_2}",
    # By daily runs or as a stream, the fact is the same; only its own keys depend on the runs.
    "end_to_end_streamed_orders": "SELECT * EXCLUDE (sales_id) FROM {fact_2}",
    "stream_order_register": """
        SELECT order_id, max(updated_at) AS updated_at
        FROM (SELECT order_id, updated_at FROM {x_orders_1} UNION ALL SELECT order_id, updated_at FROM {x_orders_2}) o GROUP BY order_id""",
    "pending_sales": "SELECT * FROM {late_wait_2}",
    **CDC,
    "dq_keys": _dq_keys([*PRIMARY_KEYS.items(), *((t, [c]) for t, cs in UNIQUE_COLUMNS.items() for c in cs)], _STATE),
    "dq_staging_keys": _dq_keys(list(STAGING_KEYS.items()), _STAGED),
    "dq_staging_columns": _dq_columns(STAGING, {n: warehouse_lengths(s) for n, s in STAGING.items()}, _STAGED),
    "dq_references": _dq_references(),
    "dq_columns": _dq_columns(OPERATIONAL, OPERATIONAL_LENGTHS, _STATE),
    "csv_roundtrip": "SELECT * FROM {x_orders_2}",
    "csv_import": _digests({n: ("{raw_" + n + "}", RAW[n].names) for n in RAW}),
    "dataset_setup": _digests(
        {
            "stores": ("{boot_stores}", OPERATIONAL["stores"].names), "staffs": ("{boot_staffs}", OPERATIONAL["staffs"].names),
            "products": ("{boot_products}", OPERATIONAL["products"].names),
            "customers": ("{bootstrap_customers}", OPERATIONAL["customers"].names),
            "orders": ("{all_orders}", OPERATIONAL["orders"].names),
            "order_status": ("{order_status}", OPERATIONAL["order_status"].names),
            **{n: ("{raw_" + n + "}", OPERATIONAL[n].names) for n in ("categories", "brands", "order_items", "stocks")},
        }
    ),
    # A CSV file cannot tell an empty text from a missing one.
    "transform_files": _digests(
        {n: ("{stg_" + n + "_all}", STAGING[n].names) for n in STAGING}
        | {"customers": ("(SELECT * REPLACE (nullif(phone, '') AS phone) FROM {stg_customers_all})", STAGING["customers"].names)}
    ),
    "transform_days": _digests({n: (f"({_two_days(n)})", [*STAGING[n].names, "run_date"]) for n in STAGING}),
    "catalog_tables": f"SELECT *, 0 AS tables_left FROM ({_digests({n: (_STATE[n], OPERATIONAL[n].names) for n in OPERATIONAL})}) d",
    "cascade_all": _digests({n: ("{left_" + n + "}", OPERATIONAL[n].names) for n in OPERATIONAL}),
    "cascade_update": _digests({n: ("{rekeyed_" + n + "}", OPERATIONAL[n].names) for n in OPERATIONAL}),
    "cascade_update_refused": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, CAST(old_key AS VARCHAR) AS old_key, CAST(new_key AS VARCHAR) AS new_key, reason FROM {{judged_{n}}} WHERE reason IS NOT NULL"
        for n in RENAMES_SQL
    ),
    **{
        f"cdc_soft_delete_{n}": f"""
        SELECT * REPLACE (CASE WHEN {_KEY[n]} IN (SELECT {_KEY[n]} FROM {{gone_{n}}}) THEN {TODAY} ELSE updated_at END AS updated_at,
                          CASE WHEN {_KEY[n]} IN (SELECT {_KEY[n]} FROM {{gone_{n}}}) THEN 'N' ELSE is_active END AS is_active)
        FROM {{boot_{n}}}"""
        for n in GONE_SQL
    },
    "parquet_roundtrip": "SELECT * FROM {stg_sales_2}",
    "staging_publish_and_clear": "SELECT *, CAST(0 AS BIGINT) AS left_in_staging FROM {stg_date_all}",
    **REPORTS,
    **SUMMARIES,
}

_NAME = re.compile(r"\{(\w+)\}")


def _with(query: str) -> str:
    """The query with a WITH clause for every named part it needs, in order of need."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in _NAME.findall(text):
            if name in CTE and name not in order:
                need(CTE[name])
                order.append(name)

    need(query)

    def plain(text: str) -> str:
        return _NAME.sub(lambda m: f"c_{m[1]}" if m[1] in CTE else m[1], text)

    unknown = {n for n in _NAME.findall(query) if n not in CTE and n not in GIVEN}
    if unknown:
        raise KeyError(f"unknown parts: {sorted(unknown)}")
    # Materialised: parts such as the dimensions are used several times over.
    parts = ", ".join(f"c_{name} AS MATERIALIZED ({plain(CTE[name])})" for name in order)
    return f"WITH {parts} {plain(query)}" if parts else plain(query)


def oracle_sql() -> dict[str, str]:
    return {name: _with(text) for name, text in SQL.items()}
