"""Surrogate keys without a global sort and without a single-task numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def assign_keys(
    rows: DataFrame,
    key: str,
    identity: Sequence[str],
    taken: int = 0,
    digits: int = 3,
) -> DataFrame:
    """Number the rows whose ``key`` is NULL from ``taken + 1`` on, without gaps. They are read twice: store them first.

    ``identity`` names columns that together are unique among the new rows. Rows go to
    buckets by a digest of their identity, which spreads them evenly whatever the values are;
    each bucket is numbered on its own and shifted by the size of the buckets before it. The
    result follows from the values alone, so a recomputed task yields the same keys.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in identity]))
    new = rows.filter(F.col(key).isNull()).withColumn("_bucket", F.substring(digest, 1, digits))

    sizes = new.groupBy("_bucket").agg(F.count("*").alias("_size"))
    # At most 16**digits rows from here on: small enough for one task and to broadcast.
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", (F.lit(taken) + F.coalesce(F.sum("_size").over(before), F.lit(0))).alias("_offset"))

    within = Window.partitionBy("_bucket").orderBy(*identity)
    numbered = (
        new.withColumn("_nth", F.row_number().over(within))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(key, (F.col("_offset") + F.col("_nth")).cast("long"))
        .select(*rows.columns)
    )
    return rows.filter(F.col(key).isNotNull()).unionByName(numbered)
