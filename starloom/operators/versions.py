"""Join of facts to the dimension version valid on a date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import Dimension


def version_on(rows: DataFrame, versions: DataFrame, dim: Dimension, on: str, how: str = "inner") -> DataFrame:
    """Add the surrogate key of the version whose validity (both ends included) covers date ``on``.

    The id is an equality key and the interval a residual condition, so Spark picks a broadcast hash join when the
    dimension is small and a sort-merge join otherwise, in which AQE splits a hot id.
    """
    side = versions.select(
        F.col(dim.id).alias("_id"), F.col(dim.key), F.col("eff_date").alias("_from"), F.col("exp_date").alias("_to")
    )
    match = (F.col(dim.id) == F.col("_id")) & F.col(on).between(F.col("_from"), F.col("_to"))
    return rows.join(side, match, how).drop("_id", "_from", "_to")
