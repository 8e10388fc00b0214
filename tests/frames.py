import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T


def day(text):
    return dt.date.fromisoformat(text) if text else None


def frame(spark, schema, rows):
    """Rows (lists in schema order, or dicts with NULL for what is left out) as a DataFrame."""
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    full = [[r.get(f.name) for f in fields] if isinstance(r, dict) else list(r) for r in rows]

    def fit(value, kind):
        if isinstance(kind, T.DateType) and isinstance(value, str):
            return day(value)
        if isinstance(kind, T.DecimalType) and value is not None:
            return Decimal(str(value))
        return value

    fitted = [tuple(fit(v, f.dataType) for v, f in zip(row, fields)) for row in full]
    return spark.createDataFrame(fitted, T.StructType(fields))


def rows(df, *columns):
    return sorted((tuple(str(r[c]) for c in (columns or df.columns)) for r in df.collect()))
