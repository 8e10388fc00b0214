"""Extract files as a stream: each micro-batch is one run of the batch operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.scd2 import late_rows
from ..operators.staging import STAGE, STAGING_ORDER, stage_date
from ..plans.daily import known_orders, load_dates, load_dimension, load_fact, load_statuses, one_of_repeated
from ..schemas import DIMENSIONS, EXTRACT
from ..sources.warehouse import Run, Warehouse


def dimension_loader(warehouse: Warehouse, name: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges a micro-batch of extract rows into a dimension.

    A backlog is merged day by day, so no version of an id is skipped. A micro-batch that is
    delivered again after a restart finds its days in the run log and leaves them out.
    """
    dim, stage = DIMENSIONS[name], STAGE[name]

    def load(extract: DataFrame, batch_id: int) -> None:
        rows = extract.filter(F.col("updated_at").isNotNull())
        days = sorted(r[0] for r in rows.select("updated_at").distinct().collect())  # bounded: calendar days
        for day in days:
            job, run_id = f"stream-{name}", f"{batch_id}-{day:%Y%m%d}"
            if warehouse.has_run(job, run_id):
                continue
            run = warehouse.begin(day - dt.timedelta(days=1), day, job, run_id)
            staged = run.stage(f"stg_{name}", stage(rows.filter(F.col("updated_at") == day)))
            # Rows not later than the open version would make versions overlap: they are listed, not merged.
            late = run.stage(f"late_{name}", late_rows(run.read(dim.table), staged, dim))
            load_dimension(run, staged.join(late.select(dim.id), dim.id, "left_anti"), dim)
            run.commit()

    return load


def stream_dimension(warehouse: Warehouse, landing: str, name: str, checkpoint: str) -> StreamingQuery:
    """Merge all extract files (parquet) that have arrived in ``landing``, then stop."""
    arrivals = warehouse.spark.readStream.schema(EXTRACT[name]).parquet(landing)
    return (
        arrivals.writeStream.foreachBatch(dimension_loader(warehouse, name))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dated_changes(extract: DataFrame) -> DataFrame:
    """Rows that name an order and a date of change."""
    return extract.where("order_id IS NOT NULL AND updated_at IS NOT NULL")


def several_changes(extract: DataFrame) -> DataFrame:
    """The orders with changes of several days, and the last of these. Only ids and dates are shuffled; store the result, so that its size is known."""
    days = dated_changes(extract).groupBy("order_id").agg(F.min("updated_at").alias("_first"), F.max("updated_at").alias("_last"))
    return days.where("_first < _last").select("order_id", "_last")


def latest_changes(extract: DataFrame, several: DataFrame | None = None) -> DataFrame:
    """The lines of each order as of its last change; rows without an order or a date of change are left out.

    With the stored ``several_changes`` of the same extract lines stay where they are, while those orders are few enough to broadcast.
    """
    several = several_changes(extract) if several is None else several
    met = dated_changes(extract).join(several, "order_id", "left")
    return met.where("_last IS NULL OR updated_at = _last").select(extract.columns)


def order_dates(extract: DataFrame) -> DataFrame:
    """The orders of some lines, with their dates as the register has them."""
    date = F.coalesce(F.date_format("order_date", "yyyyMMdd"), F.lit(""))
    return dated_changes(extract).select("order_id", date.alias("order_date"), "updated_at").distinct()


def last_known(run: Run, arrivals: DataFrame) -> DataFrame:
    """The last change that the register has of the orders of a micro-batch; none of orders that it does not have."""
    orders = order_dates(arrivals)
    changed = known_orders(run, orders, "order_register").join(orders, "order_id", "left_semi")
    return changed.groupBy("order_id").agg(F.max("updated_at").alias("known_until"))


def not_later(arrivals: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of a micro-batch that are not later than what the register has of their orders (``known``, see ``last_known``)."""
    return arrivals.join(known, "order_id").where("updated_at <= known_until").select(arrivals.columns)


def without_repeated(run: Run, arrivals: DataFrame, known: DataFrame, before: DataFrame) -> DataFrame:
    """The rows of a micro-batch that are not, in all columns, among the rows that came ``before``.

    The register has every order of the rows before, at their date of change or a later one, so only rows that are not later than it says are
    compared. They are stored first: mostly there are none, and while they are few neither the rows before nor the micro-batch are moved.
    """
    maybe = run.stage("repeated_or_late", not_later(arrivals, known))
    if maybe.isEmpty():
        return arrivals
    repeated = run.stage("repeated_arrivals", before.join(maybe, _same_row(before, maybe), "left_semi").distinct())
    if repeated.isEmpty():
        return arrivals
    return run.stage("fresh_arrivals", arrivals.join(repeated, _same_row(arrivals, repeated), "left_anti"))


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    """Whether two rows of order extracts have the same values, or both none."""
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in EXTRACT["orders"].names])


def order_loader(warehouse: Warehouse, wait: bool = False, again: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that loads a micro-batch of order extracts into the fact, in one run however many days it spans.

    With ``again``, rows that are delivered again within that time are dropped before anything else (see ``stream_orders``): those of the same
    micro-batch by their values, those of earlier ones by the table ``recent_arrivals``, which holds what has arrived in that time by minute.

    Of the changes of an order in a micro-batch the last one counts, as in a daily run over the same days. A change that is not later than
    what the stream has loaded of that order before (delivered again, or late) has no effect on the fact and is listed in the run's
    ``late_orders``; ``order_register`` tells. A micro-batch that is delivered again after a restart finds itself in the run log.
    The lines of one change of an order must come in one micro-batch, e.g. in one file: an order in the fact gets no further lines.
    ``wait`` is that of ``load_fact``, for orders that come before what they name.
    """

    def load(extract: DataFrame, batch_id: int) -> None:
        job, run_id = "stream-orders", str(batch_id)
        if warehouse.has_run(job, run_id):
            return
        run = warehouse.begin(None, None, job, run_id)
        # Stored before anything is asked of it: each look at a micro-batch reads all of its files once more.
        arrivals = run.stage("arrivals", extract if again is None else extract.distinct())
        known = run.stage("known_changes", last_known(run, arrivals))
        if again is not None:
            minute, since = minutes_of(warehouse.spark, again)
            minutes = run.segments("recent_arrivals")
            arrivals = without_repeated(run, arrivals, known, run.read("recent_arrivals", [m for m in minutes if m >= since]))
        first, last = arrivals.agg(F.min("updated_at"), F.max("updated_at")).first()
        if last is None:
            run.clear_all()
            return
        run.previous, run.current = first - dt.timedelta(days=1), last
        changes = run.stage("changes", latest_changes(arrivals, run.stage("several_changes", several_changes(arrivals))))
        judged = changes.join(known, "order_id", "left")
        is_late = F.coalesce(F.col("updated_at") <= F.col("known_until"), F.lit(False))
        late = run.stage("late_orders", judged.where(is_late).select(changes.columns))
        # Mostly no change is late: then all are news, as they lie.
        news = changes if late.isEmpty() else run.stage("news", judged.where(~is_late).select(changes.columns))

        staged = run.stage("stg_sales", one_of_repeated(run, news), sort=STAGING_ORDER["sales"])
        load_dates(run, run.stage("stg_date", stage_date(news)))
        load_statuses(run)
        load_fact(run, staged, wait)
        run.publish("order_register", order_dates(news), F.substring("order_date", 1, 6))
        if again is not None:
            over = [m for m in minutes if m < since]
            run.publish("recent_arrivals", dated_changes(arrivals), F.lit(minute), replaces=over, moved=False)
        run.commit()
        run.clear_all(keep=["rejected_sales", "late_orders"])

    return load


def minutes_of(spark: SparkSession, again: str) -> tuple[str, str]:
    """This minute, and the one that lies the time ``again`` before it, as text that sorts by time."""
    row = spark.sql(f"SELECT date_format(now, 'yyyyMMddHHmm'), date_format(now - INTERVAL '{again}', 'yyyyMMddHHmm') FROM (SELECT current_timestamp() AS now)")
    return tuple(row.first())


def stream_orders(
    warehouse: Warehouse, landing: str, checkpoint: str, again: str = "1 day", wait: bool = False, files: int | None = None
) -> StreamingQuery:
    """Load all order extracts (parquet) that have arrived in ``landing``, then stop; ``files`` is the most files of a micro-batch.

    Rows that are delivered again within the time ``again`` are dropped before they reach the fact; those that come later are told by the
    register. That time runs by arrival, not by the day of the change: no row is dropped for being old, and what must be remembered
    is bounded by what arrives in that time. It is a table of the warehouse, so a task keeps none of it in memory, and what is remembered
    becomes visible by the same log entry as the fact that it entered.
    """
    minutes_of(warehouse.spark, again)  # a text that is no time ends the call, not the first micro-batch
    reader = warehouse.spark.readStream.schema(EXTRACT["orders"])
    arrivals = (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(landing)
    return (
        arrivals.writeStream.foreachBatch(order_loader(warehouse, wait, again))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
