"""Comparison of a Spark result with the same query run by DuckDB."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What differs: column names, column types, row values (as a multiset). Empty if equal."""
    found = []
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    result = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(spark_types) != sorted(duck_types):
        return [f"columns {sorted(spark_types)} / {sorted(duck_types)}"]
    for name, kind in spark_types.items():
        wanted = _DUCK_TYPES.get(kind) or kind.upper()
        if wanted.replace(" ", "") != duck_types[name].replace(" ", ""):
            found.append(f"type of {name}: {kind} / {duck_types[name]}")
    names = sorted(spark_types)
    at = [list(duck_types).index(n) for n in names]
    ours = Counter(tuple(str(row[n]) for n in names) for row in df.collect())
    theirs = Counter(tuple(str(row[i]) for i in at) for row in expected)
    if ours != theirs:
        more, less = ours - theirs, theirs - ours
        found.append(f"{sum(ours.values())} / {sum(theirs.values())} rows, {sum(more.values())} only here, {sum(less.values())} only there")
        found += [f"here {r}" for r in list(more)[:3]] + [f"there {r}" for r in list(less)[:3]]
    return found
