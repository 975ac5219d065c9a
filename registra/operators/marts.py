"""Answers over facts and dimensions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.functions import text as T
from registra.operators.dimensions import sequence_order
from registra.operators.facts import lifecycles, relocations, sequence_flags
from registra.operators.quality import overlapping
from registra.operators.sequence import last_known
from registra.session import small_side


def activity_by_area(fact: DataFrame, areas: DataFrame, states: list[str], ended: list[str], start: str, end: str) -> DataFrame:
    """Distinct businesses per area and status among current revisions whose period meets ``start`` to ``end``.

    One column per status in ``states`` (always all of them), one for any other or none, their sum and the
    share of those in ``ended``. A business in two statuses counts in both. Areas are broadcast if they are
    few. Most of the first status come first, ties by area key.
    """
    status = F.when(F.col("status").isin(*states), F.col("status")).otherwise(F.lit("Other"))
    rows = overlapping(sequence_flags(fact).filter("is_current_revision and business_sk <> -1"), "issued_date", "expired_date", start, end)
    wide = rows.withColumn("_status", status).groupBy("neighbourhood_sk").pivot("_status", [*states, "Other"]).agg(F.count_distinct("business_sk")).na.fill(0)
    names = {s: s.lower().replace(" ", "_") for s in (*states, "Other")}
    wide = wide.select("neighbourhood_sk", *[F.col(f"`{s}`").alias(n) for s, n in names.items()])
    total, over = reduce(add, [F.col(n) for n in names.values()]), reduce(add, [F.col(names[s]) for s in ended], F.lit(0).cast("bigint"))
    counted = wide.withColumns({"total": total, "ended": over}).withColumn("ended_rate", T.rounded(F.try_divide(F.col("ended"), F.nullif(F.col("total"), F.lit(0))), 4))
    labelled = counted.join(small_side(areas.select("neighbourhood_sk", "local_area")), "neighbourhood_sk", "left").withColumn("local_area", F.coalesce("local_area", F.lit("Unknown")))
    return labelled.orderBy(F.desc(names[states[0]]), "neighbourhood_sk")


def spans_by_category(fact: DataFrame, categories: DataFrame, first_year: int | None = None) -> DataFrame:
    """Count, mean, median, least and greatest years from first issue to last expiry per latest category.

    With ``first_year`` only businesses first seen after it, whose start was observed. Most businesses come
    first, ties by category key.
    """
    lives = lifecycles(fact).filter("span_years is not null and span_days >= 0")
    if first_year is not None:
        lives = lives.filter(F.col("first_folder_year") > first_year)
    years = F.col("span_years")
    out = lives.groupBy(F.col("latest_category_sk").alias("category_sk")).agg(
        F.count(F.lit(1)).alias("business_count"), T.rounded(F.avg(years), 2).alias("avg_years"), T.rounded(F.median(years), 2).alias("median_years"), F.min(years).alias("min_years"), F.max(years).alias("max_years")
    )
    labels = small_side(categories.select("category_sk", "business_type", "business_subtype"))
    return out.join(labels, "category_sk", "left").withColumn("cohort", F.lit("all" if first_year is None else "observed")).orderBy(F.desc("business_count"), "category_sk")


def labelled_moves(fact: DataFrame, addresses: DataFrame, areas: DataFrame) -> DataFrame:
    """Relocations with the business's last known name, both addresses, streets and areas; latest first, ties by business and year."""
    moves = relocations(fact, addresses)
    names = fact.filter("business_sk <> -1").groupBy("business_sk").agg(last_known("business_name", sequence_order()).alias("business_name"))
    moves = moves.join(names, "business_sk", "left")
    few = small_side(areas.select("neighbourhood_sk", "local_area"))
    for side in ("from", "to"):
        place = addresses.select(F.col("address_sk").alias(f"{side}_address_sk"), F.col("street").alias(f"{side}_street"), F.concat_ws(" ", "unit_type", "unit", "house", "street").alias(f"{side}_address"))
        area = few.select(F.col("neighbourhood_sk").alias(f"{side}_neighbourhood_sk"), F.col("local_area").alias(f"{side}_local_area"))
        moves = moves.join(place, f"{side}_address_sk", "left").join(area, f"{side}_neighbourhood_sk", "left")
    return moves.orderBy(F.desc_nulls_last("changed_on"), "business_sk", "to_folder_year")
