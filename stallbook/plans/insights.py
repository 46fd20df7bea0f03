"""Weekly roll-ups for sellers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.operators.joins import week_start


def weekly_usage(usage: DataFrame, time: str, keys: list[str]) -> DataFrame:
    """Units and units times cores per ISO week and keys, as rows of two measures.

    Both measures come from one pass and one shuffle. usage: units, cores and the keys
    """
    both = (
        usage.groupBy(week_start(F.col(time)).alias("week_start"), *keys)
        .agg(F.sum("units").alias("raw"), F.sum(F.col("units") * F.col("cores")).alias("core"))
        .withColumn("week_end", F.date_add("week_start", 6))
    )
    measures = F.array(
        *[F.struct(F.lit(m).alias("measure"), F.col(m).cast("decimal(38,4)").alias("quantity")) for m in ("raw", "core")]
    )
    return both.select("week_start", "week_end", *keys, F.inline(measures))
