"""Type-2 dimension merge.

One batch row ``s`` per natural id meets the dimension row ``d``:

=====================================  =============================  ==============
case                                   what becomes of ``d``          new version?
=====================================  =============================  ==============
``d`` already closed                   unchanged                      no
open, no ``s``                         unchanged                      no
open, attributes differ                closes the day before ``s``    yes
open, same attributes, ``s`` deleted   closes on the day of ``s``     no
open, same attributes, ``s`` active    unchanged                      no
id not in the dimension                --                             yes
=====================================  =============================  ==============

A new version opens on the day of ``s``; if ``s`` is deleted it also closes that day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_differs
from ..schemas import ACTIVE, INACTIVE, OPEN_END, Dimension
from .rows import keep_one, unseen


def latest_per_id(batch: DataFrame, dim: Dimension) -> DataFrame:
    """The last version of each id in the batch."""
    return keep_one(batch, [dim.id], prefer=[F.col("eff_date").desc()])


def _version(dim: Dimension, source: str, **changed: Column) -> Column:
    """A dimension row as a struct, taken from ``source`` but for the ``changed`` columns."""
    return F.struct(
        *[changed.get(f.name, F.col(f"{source}.{f.name}")).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )


def _opened(dim: Dimension) -> Column:
    """The new version that batch row ``s`` opens; its key is assigned later."""
    deleted = F.col("s.active_flag") == INACTIVE
    return _version(
        dim,
        "s",
        **{
            dim.key: F.lit(None),
            "exp_date": F.when(deleted, F.col("s.eff_date")).otherwise(F.lit(OPEN_END).cast("date")),
            "active_flag": F.when(deleted, F.lit(INACTIVE)).otherwise(F.lit(ACTIVE)),
        },
    )


def scd2_rewrite(current: DataFrame, batch: DataFrame, dim: Dimension, reactivate: bool = False) -> DataFrame:
    """All rows that are, or were until this batch, open: what the merge has to write.

    Closed history is not in the result, as a merge never changes it. Of ``current`` the newest
    version of each id is enough: closed ones are read on their id only, to tell new ids from ids that
    were closed earlier; those stay closed unless ``reactivate`` is set. Rows opened by this batch carry a NULL key.

    The batch is joined as the right side throughout, so while it is small enough to
    broadcast nothing of the dimension is shuffled.
    """
    latest = latest_per_id(batch, dim)
    open_rows = current.filter(F.col("active_flag") == ACTIVE)

    d = open_rows.select(dim.id, F.struct(*dim.schema.names).alias("d"))
    s = latest.select(dim.id, F.struct(*latest.columns).alias("s"))
    changed = F.col("s").isNotNull() & any_differs("d", "s", dim.tracked, dim.null_as_empty)
    deleted = F.coalesce(F.col("s.active_flag") == INACTIVE, F.lit(False))
    kept = _version(
        dim,
        "d",
        exp_date=F.when(changed, F.date_sub("s.eff_date", 1))
        .when(deleted, F.col("s.eff_date"))
        .otherwise(F.col("d.exp_date")),
        active_flag=F.when(changed | deleted, F.lit(INACTIVE)).otherwise(F.col("d.active_flag")),
    )
    versions = F.when(changed, F.array(kept, _opened(dim))).otherwise(F.array(kept))
    rewritten = d.join(s, dim.id, "left").select(F.inline(versions))

    fresh = unseen(s, open_rows if reactivate else current, dim.id)
    opened = fresh.select(_opened(dim).alias("row")).select("row.*")
    return rewritten.unionByName(opened)


def scd2_merge(current: DataFrame, batch: DataFrame, dim: Dimension, reactivate: bool = False) -> DataFrame:
    """The whole dimension after the batch: untouched history and the rewritten rows."""
    history = current.filter(F.col("active_flag") != ACTIVE).select(*dim.schema.names)
    return history.unionByName(scd2_rewrite(current, batch, dim, reactivate))


def append_dates(dim_date: DataFrame, staged: DataFrame) -> DataFrame:
    """The staged dates the date dimension does not have yet."""
    return staged.join(dim_date.select("date_key"), "date_key", "left_anti").select(*dim_date.columns)


def late_rows(current: DataFrame, batch: DataFrame, dim: Dimension) -> DataFrame:
    """Batch rows not later than the open version of their id: merging them would make versions overlap."""
    opened = current.filter(F.col("active_flag") == ACTIVE).select(dim.id, F.col("eff_date").alias("_open"))
    return batch.join(opened, dim.id).filter("eff_date <= _open").select(*batch.columns)

