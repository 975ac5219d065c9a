"""Sequences of rows per entity: earlier row, position-free lookahead, as-of values, states per year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from registra.session import cut


def _looked_back(df: DataFrame, entity: str, order: list[Column], columns: list[str]) -> tuple[DataFrame, WindowSpec]:
    """Rows over range partitions by entity and order, with ``_old`` (the values of ``columns`` in the entity's row before), and the window in a partition."""
    keyed = df.filter(F.col(entity).isNotNull()).withColumn("_o", F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)]))
    placed = cut(keyed.repartitionByRange(entity, *[F.col(f"_o.c{i}").asc_nulls_first() for i in range(len(order))]).withColumn("_part", F.spark_partition_id()))
    here = Window.partitionBy("_part", entity).orderBy(*[F.col(f"_o.c{i}").asc_nulls_first() for i in range(len(order))])
    values = F.struct(*columns)
    seen = placed.withColumns({"_before": F.lag(values).over(here), "_first": F.row_number().over(here) == 1})
    lasts = seen.withColumn("_next", F.lead("_part").over(here)).filter("_next is null").select(entity, "_part", values.alias("_last"))
    steps = Window.partitionBy(entity).orderBy("_part")
    carried = lasts.select(F.col(entity).alias("_e"), F.col("_part").alias("_p"), F.lag("_last").over(steps).alias("_carry")).filter("_carry is not null")
    joined = seen.join(carried, F.col("_first") & (F.col(entity) == F.col("_e")) & (F.col("_part") == F.col("_p")), "left")
    return joined.withColumn("_old", F.coalesce("_before", "_carry")).drop("_before", "_carry", "_first", "_e", "_p"), here


def previous_rows(df: DataFrame, entity: str, order: list[Column], columns: list[str], prefix: str = "previous_") -> DataFrame:
    """Adds the values that ``columns`` had in the entity's row before, in ``order`` (nulls first).

    ``order`` must be total within an entity. Rows with a null entity are left out. Works whatever share
    of the rows one entity has: rows are sorted over range partitions by entity and order, looked back
    within a partition, and the first row of an entity in a partition takes its values from the entity's
    last row in an earlier one (one row per entity and partition that it spans).
    """
    seen, _ = _looked_back(df, entity, order, columns)
    return seen.select(*df.columns, *[F.col("_old")[c].alias(f"{prefix}{c}") for c in columns])


def spans(df: DataFrame, entity: str, order: list[Column], tracked: list[str]) -> DataFrame:
    """Adds ``_span``, the number of the entity's span, and ``_why``, the columns whose change started it (on its first row).

    A span starts with the entity's first row and wherever a known value differs from the known one in the
    row before. The running count is taken within range partitions and continued from the counts of the
    earlier ones (a row per entity and partition that it spans), so no entity is gathered.
    """
    seen, here = _looked_back(df, entity, order, tracked)
    why = F.array_compact(F.array(*[F.when(F.col(c) != F.col("_old")[c], F.lit(c)) for c in tracked]))
    begun = cut(seen.withColumn("_why", why).withColumn("_begun", (F.col("_old").isNull() | (F.size("_why") > 0)).cast("bigint")).drop("_old"))
    steps = Window.partitionBy(entity).orderBy("_part")
    counts = begun.groupBy(entity, "_part").agg(F.sum("_begun").alias("_k"))
    earlier = counts.select(F.col(entity).alias("_e"), F.col("_part").alias("_p"), F.sum("_k").over(steps.rowsBetween(Window.unboundedPreceding, -1)).alias("_sofar")).filter("_sofar > 0")
    joined = begun.join(earlier, (F.col(entity) == F.col("_e")) & (F.col("_part") == F.col("_p")), "left")
    number = F.coalesce("_sofar", F.lit(0)) + F.sum("_begun").over(here)
    return joined.withColumn("_span", number).select(*df.columns, "_span", "_why")


def greatest_per(df: DataFrame, entity: str, order: list[Column], name: str, where: Column | None = None) -> DataFrame:
    """The greatest ``order`` of each entity as a struct (nulls lowest); an aggregate, combined map-side."""
    rank = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)])
    return df.filter(F.col(entity).isNotNull()).groupBy(F.col(entity).alias("_e")).agg(F.max(F.when(where, rank) if where is not None else rank).alias(name))


def last_known(column: str, order: list[Column]) -> Column:
    """The last value of a column that is not null, in ``order``, as an aggregate."""
    c = F.col(column)
    return F.max_by(c, F.when(c.isNotNull(), F.struct(*[x.alias(f"c{i}") for i, x in enumerate(order)])))


def first_known(column: str, order: list[Column]) -> Column:
    """The first value of a column that is not null, in ``order``, as an aggregate."""
    c = F.col(column)
    return F.min_by(c, F.when(c.isNotNull(), F.struct(*[x.alias(f"c{i}") for i, x in enumerate(order)])))


def as_of(versions: DataFrame, days: DataFrame, entity: str, start: str, day: str, columns: list[str]) -> DataFrame:
    """For each distinct (entity, day) the version that held on it: ``entity``, ``day``, ``columns`` (null before the first).

    Days and version starts are laid in one sequence per entity and looked back over, so nothing is
    multiplied out; an entity has at most two rows per calendar day here, however many facts it has.
    """
    starts = versions.select(F.col(entity).alias("_e"), F.col(start).alias("_d"), F.struct(*columns).alias("_v"))
    asked = days.select(F.col(entity).alias("_e"), F.col(day).alias("_d")).filter("_e is not null and _d is not null").distinct()
    both = starts.withColumn("_ask", F.lit(False)).unionByName(asked.withColumns({"_v": F.lit(None).cast(starts.schema["_v"].dataType), "_ask": F.lit(True)}))
    w = Window.partitionBy("_e").orderBy("_d", "_ask")
    held = both.withColumn("_held", F.last("_v", True).over(w)).filter("_ask")
    return held.select(F.col("_e").alias(entity), F.col("_d").alias(day), *[F.col(f"_held.{c}").alias(c) for c in columns])


def per_year(df: DataFrame, entity: str, year: str, aggregates: list[Column]) -> DataFrame:
    """One row per entity and year in which it has rows; null entities and years are left out."""
    return df.filter(F.col(entity).isNotNull() & F.col(year).isNotNull()).groupBy(entity, year).agg(*aggregates)


def year_before(entity: str, year: str) -> Window:
    """A window over an entity's years; bounded by the number of years."""
    return Window.partitionBy(entity).orderBy(year)
