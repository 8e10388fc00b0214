"""Keeping the monthly summaries of a warehouse: only months whose part of the fact has changed are read and computed anew."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.summaries import order_summary, sales_summary
from ..session import run_together
from ..sources.warehouse import Run, Warehouse

JOB = "summaries"


def summarised_entry(warehouse: Warehouse) -> int:
    """The log entry whose fact the summaries show; 0 before the first refresh. A refresh has that number as its run id."""
    done = warehouse.log().where(F.col("job") == JOB).agg(F.max_by("run_id", "seq")).first()[0]
    return int(done or 0)


def touched_months(warehouse: Warehouse, before: int, after: int) -> list[str]:
    """Months whose folders of the fact are others in one log entry than in the other; with 0, all months of the other."""

    def folders(seq: int) -> dict[str, set[str]]:
        found: dict[str, set[str]] = {}
        for entry in warehouse.entries(seq)[1] if seq else []:
            if entry["table"] == "fact_sales":
                found.setdefault(entry["segment"], set()).add(entry["folder"])
        return found

    old, new = folders(before), folders(after)
    return sorted(month for month in old.keys() | new.keys() if old.get(month) != new.get(month))


def refresh_summaries(warehouse: Warehouse, seq: int | None = None) -> list[str]:
    """Bring ``sales_summary`` and ``order_summary`` to the fact's state after a finished run, the newest by default.

    Gives the months computed anew; none, and nothing is written, if the summaries show that state already. A month that has left the fact
    leaves the summaries. Both tables become visible by one log entry; like every run, a refresh must not overlap with another one.
    """
    number, _ = warehouse.entries(seq)
    months = touched_months(warehouse, summarised_entry(warehouse), number)
    if not months:
        return []
    fact = Run(warehouse, "", "", None, None, number).read("fact_sales", months)
    run = warehouse.begin(None, None, JOB, str(number))
    summaries = {"sales_summary": sales_summary(fact), "order_summary": order_summary(fact)}
    run_together([lambda t=t, rows=rows: run.publish(t, rows, F.col("month"), months) for t, rows in summaries.items()])
    run.commit()
    return months
