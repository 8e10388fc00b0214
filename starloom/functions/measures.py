"""Sales measures in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY


def sales_measures() -> dict[str, Column]:
    """Measures of one order line. Each builds on the rounded value of the one before it."""
    return {
        "discount_percent": (F.col("discount") * 100).cast("int"),
        "total_price": (F.col("list_price") * F.col("quantity")).cast(MONEY),
        "discount_amount": (F.col("total_price") * F.col("discount")).cast(MONEY),
        "total_price_with_discount": (F.col("total_price") - F.col("discount_amount")).cast(MONEY),
    }


def rejected_on() -> Column:
    """The day an order was rejected: its last update, for rejected orders only."""
    return F.when(F.col("order_status") == "Rejected", F.col("updated_at"))
