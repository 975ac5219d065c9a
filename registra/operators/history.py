"""History of changing entity attributes by consecutive snapshot differencing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = 99991231


def latest_per_day(df: DataFrame, entity: str, day: str, order: list[str], tracked: list[str], unknown: dict | None = None) -> DataFrame:
    """One row per entity and day: the row with the greatest ``order`` values (nulls lowest).

    An aggregate, so rows are combined before the shuffle and an entity with a third of all rows
    leaves at most one row per day. Values in ``unknown`` (column to value) become null.
    """
    unknown = unknown or {}
    state = [F.when(F.col(c) != F.lit(unknown[c]), F.col(c)).alias(c) if c in unknown else F.col(c) for c in tracked]
    pick = F.max_by(F.struct(*state), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(F.col(entity).alias("_entity"), F.col(day).alias("_day")).agg(pick.alias("_s")).select("_entity", "_day", *[F.col(f"_s.{c}").alias(c) for c in tracked])


def snapshot_events(snapshots: DataFrame, tracked: list[str]) -> DataFrame:
    """Inserted, changed and deleted events between consecutive snapshots of each entity.

    ``snapshots`` has ``_entity``, ``_day`` and ``tracked``; an unknown (null) value repeats the last
    known one. Snapshot n is matched with snapshot n-1 by a full outer join on entity and number: no
    earlier side is an insertion, no later side ends the entity (deletion after the last snapshot),
    both sides are a change if a value differs from a known earlier one. Entities with a null key
    must be left out before. Returns ``_entity``, ``_day``, ``_kind``,
    ``_changed`` (the names of the values that differ) and ``tracked``.
    """
    seen = Window.partitionBy("_entity").orderBy("_day")
    filled = snapshots.select("_entity", "_day", F.row_number().over(seen).alias("_n"), *[F.last(c, True).over(seen).alias(c) for c in tracked])
    now = filled.select("_entity", "_n", "_day", F.struct(*tracked).alias("_now"))
    before = filled.select("_entity", (F.col("_n") + 1).alias("_n"), F.col("_day").alias("_last_day"), F.struct(*tracked).alias("_before"))
    both = now.join(before, ["_entity", "_n"], "full")
    changed = F.array_compact(F.array(*[F.when(F.col(f"_before.{c}").isNotNull() & ~F.col(f"_before.{c}").eqNullSafe(F.col(f"_now.{c}")), F.lit(c)) for c in tracked]))
    kind = F.when(F.col("_before").isNull(), "inserted").when(F.col("_now").isNull(), "deleted").when(F.size("_changed") > 0, "changed")
    events = both.withColumn("_changed", changed).withColumn("_kind", kind).filter("_kind is not null")
    return events.select("_entity", F.coalesce("_day", "_last_day").alias("_day"), "_kind", "_changed", *[F.col(f"_now.{c}").alias(c) for c in tracked])


def attribute_versions(snapshots: DataFrame, tracked: list[str]) -> DataFrame:
    """Every version of every entity with the day it starts and the day the next one starts (null if open).

    Ties: ``snapshots`` must have one row per entity and day (see ``latest_per_day``). An empty input
    gives an empty result. The change events are united and validity is the next event's day.
    """
    events = snapshot_events(snapshots, tracked)
    starts = events.filter("_kind <> 'deleted'")
    nxt = F.lead("_day").over(Window.partitionBy("_entity").orderBy("_day"))
    return starts.select("_entity", F.col("_day").alias("valid_from"), nxt.alias("valid_to"), *tracked)
