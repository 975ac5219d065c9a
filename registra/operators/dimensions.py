"""Dimensions with surrogate keys, each with an unknown member where facts may point at none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.functions import dates as D
from registra.functions import text as T
from registra.functions.keys import surrogate
from registra.operators.sequence import last_known
from registra.schema import ADDRESS, UNKNOWN

SEQUENCE = ("issued_date", "licence_number", "licence_revision_number", "licence_rsn")


def sequence_order() -> list[Column]:
    """The order of an entity's records: issue (undated first), licence number, revision (none first), key."""
    return [F.col("issued_date"), F.col("licence_number"), F.coalesce("licence_revision_number", F.lit(-1)), F.col("licence_rsn")]


def business_identity(df: DataFrame) -> DataFrame:
    """Adds the identity key, its source and the business key: legal name, else trade name, else licence number."""
    legal, trade = T.spaced_key(F.col("business_name")), T.spaced_key(F.col("business_trade_name"))
    key = F.coalesce(legal, trade, F.col("licence_number"))
    source = F.when(legal.isNotNull(), "legal_name").when(trade.isNotNull(), "trade_name").when(F.col("licence_number").isNotNull(), "licence_only")
    return df.withColumns({"business_identity_key": key, "identity_source": source}).withColumn("business_key", F.when(F.col("business_identity_key").isNull(), F.lit(UNKNOWN).cast("bigint")).otherwise(surrogate([F.col("business_identity_key")])))


def address_key() -> Column:
    """Key of the eight address columns; unknown without house and street."""
    return F.when(F.col("house").isNull() & F.col("street").isNull(), F.lit(UNKNOWN).cast("bigint")).otherwise(surrogate([F.col(c) for c in ADDRESS]))


def member_key(columns: list[str]) -> Column:
    """Key of a member, unknown if its first column is null."""
    return F.when(F.col(columns[0]).isNull(), F.lit(UNKNOWN).cast("bigint")).otherwise(surrogate([F.col(c) for c in columns]))


def dim_business(df: DataFrame) -> DataFrame:
    """One row per business with its last known names, counts and first and last dates."""
    order = sequence_order()
    rows = business_identity(df).withColumn("_day", D.utc_day(F.col("issued_date"), df.schema["issued_date"].dataType))
    out = rows.groupBy("business_key").agg(
        last_known("business_identity_key", order).alias("business_identity_key"), last_known("business_name", order).alias("business_name"),
        last_known("business_trade_name", order).alias("business_trade_name"), last_known("identity_source", order).alias("identity_source"),
        F.count(F.lit(1)).alias("licence_count"), F.count_distinct("business_name").alias("name_variant_count"),
        D.iso_day(F.min("_day")).alias("first_issued"), D.iso_day(F.max("_day")).alias("last_issued"),
        F.min("folder_year").alias("first_folder_year"), F.max("folder_year").alias("last_folder_year"),
    )
    confidence = F.create_map(*[F.lit(x) for x in ("legal_name", "medium", "trade_name", "low", "licence_only", "none")])
    return out.withColumn("identity_confidence", confidence[F.col("identity_source")])


def dim_address(df: DataFrame) -> DataFrame:
    """One row per address, all of it from the first record in sequence that has it, and the unknown member."""
    order = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(sequence_order())])
    rows = df.withColumn("address_key", address_key()).filter(F.col("address_key") != UNKNOWN)
    whole = F.struct(*ADDRESS, "latitude", "longitude")
    known = rows.groupBy("address_key").agg(F.min_by(whole, order).alias("_a")).select("address_key", "_a.*", F.lit(False).alias("is_unknown"))
    spark = df.sparkSession
    return known.unionByName(spark.range(1).select(F.lit(UNKNOWN).cast("bigint").alias("address_key"), F.lit(True).alias("is_unknown")), allowMissingColumns=True)


def dim_members(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Distinct members of one or more columns with their keys, and the unknown member."""
    known = df.filter(F.col(columns[0]).isNotNull()).select(*columns).distinct()
    out = known.select(member_key(columns).alias(key), *columns)
    unknown = df.sparkSession.range(1).select(F.lit(UNKNOWN).cast("bigint").alias(key), *[F.lit("Unknown").alias(c) for c in columns])
    return out.unionByName(unknown)


def dim_category(df: DataFrame, since: str) -> DataFrame:
    """Categories with whether any record was issued before ``since``."""
    day = D.utc_day(F.col("issued_date"), df.schema["issued_date"].dataType)
    early = F.coalesce(day < F.unix_date(F.lit(since).cast("date")), F.lit(False))
    columns = ["business_type", "business_subtype"]
    known = df.filter("business_type is not null").groupBy(*columns).agg(F.bool_or(early).alias("seen_before")).select(member_key(columns).alias("category_key"), *columns, "seen_before")
    unknown = df.sparkSession.range(1).select(F.lit(UNKNOWN).cast("bigint").alias("category_key"), F.lit("Unknown").alias("business_type"), F.lit("Unknown").alias("business_subtype"), F.lit(False).alias("seen_before"))
    return known.unionByName(unknown)


def dim_date(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every day from the least to the greatest date in ``columns``; no dates give no rows."""
    days = [D.utc_day(F.col(c), df.schema[c].dataType) for c in columns]
    ends = df.agg(F.least(*[F.min(d) for d in days]).alias("a"), F.greatest(*[F.max(d) for d in days]).alias("b")) if len(days) > 1 else df.agg(F.min(days[0]).alias("a"), F.max(days[0]).alias("b"))
    d = F.date_from_unix_date(F.col("n"))
    all_days = ends.filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("n"))
    return all_days.select(
        D.ymd(F.col("n")).alias("date_key"), d.cast("string").alias("full_date"), F.year(d).cast("bigint").alias("year"), F.quarter(d).cast("bigint").alias("quarter"), F.month(d).cast("bigint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.dayofmonth(d).cast("bigint").alias("day_of_month"), (d == F.last_day(d)).alias("is_month_end"), ((F.month(d) == 12) & (F.dayofmonth(d) == 31)).alias("is_year_end"),
    )


def synthetic_row(spark: SparkSession, **values) -> DataFrame:
    """One row of literals."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def fanout(df: DataFrame, key: str) -> DataFrame:
    """Keys that would multiply rows if joined: those of more than one row."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
