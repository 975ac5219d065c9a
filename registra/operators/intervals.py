"""Continuous periods and gaps of overlapping day intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def periods_and_gaps(df: DataFrame, entity: str, first: str, last: str) -> DataFrame:
    """Merge the intervals of each entity and list the holes between the merged periods.

    ``first`` and ``last`` are day numbers, both covered. Rows with a null entity or end, or with
    ``last < first``, are left out; repeated, nested and equal intervals change nothing.

    Of the intervals that start on one day only the longest counts (a map-side aggregate), which
    bounds an entity's rows by the number of days, however many rows it has. Starts and ends are then
    ranked apart from each other; behind rank i lies a hole exactly if start i+1 exceeds end i by more
    than a day, and the boundaries on both sides of the holes pair up to the periods.
    Returns ``_entity``, ``kind`` (period or gap), ``first_day``, ``last_day``.
    """
    valid = df.select(F.col(entity).alias("_entity"), F.col(first).alias("_s"), F.col(last).alias("_e")).filter("_entity is not null and _s is not null and _e >= _s")
    longest = valid.groupBy("_entity", "_s").agg(F.max("_e").alias("_e"))
    by_start = Window.partitionBy("_entity").orderBy("_s")
    by_end = Window.partitionBy("_entity").orderBy("_e", "_s")
    ranked = longest.select("_entity", "_s", "_e", F.row_number().over(by_start).alias("_rs"), F.row_number().over(by_end).alias("_re"))
    sides = ranked.select("_entity", F.explode(F.array(F.struct(F.col("_rs").alias("r"), F.col("_s").alias("s"), F.lit(None).cast("int").alias("e")), F.struct(F.col("_re").alias("r"), F.lit(None).cast("int").alias("s"), F.col("_e").alias("e")))).alias("b"))
    level = sides.groupBy("_entity", F.col("b.r").alias("_r")).agg(F.max("b.s").alias("_s"), F.max("b.e").alias("_e"))
    by_rank = Window.partitionBy("_entity").orderBy("_r")
    after = level.select("_entity", "_r", "_s", "_e", F.lead("_s").over(by_rank).alias("_next"))
    breaks = after.filter("_r = 1 or _next is null or _next > _e + 1").select(
        "_entity", "_r", "_s", "_e", "_next", (F.col("_next").isNull() | (F.col("_next") > F.col("_e") + 1)).alias("_break")
    )
    began = F.coalesce(F.lag("_next").over(Window.partitionBy("_entity", "_break").orderBy("_r")), F.min("_s").over(Window.partitionBy("_entity")))
    closed = breaks.withColumn("_began", began).filter("_break")
    period = F.struct(F.lit("period").alias("kind"), F.col("_began").alias("first_day"), F.col("_e").alias("last_day"))
    gap = F.struct(F.lit("gap").alias("kind"), (F.col("_e") + 1).alias("first_day"), (F.col("_next") - 1).alias("last_day"))
    rows = F.when(F.col("_next").isNull(), F.array(period)).otherwise(F.array(period, gap))
    return closed.select("_entity", F.inline(rows))
