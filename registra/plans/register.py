"""The licence register's history, periods, snapshot changes and load profiles (problems 1, 4, 5, 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.functions import dates as D
from registra.functions import text as T
from registra.operators.history import OPEN_END, attribute_versions, latest_per_day
from registra.operators.intervals import periods_and_gaps
from registra.operators.profile import ProfileRules, delta_counts, profile_loads, replay
from registra.operators.snapshots import snapshot_changes
from registra.session import table

TRACKED = ["business_name", "status", "address_sk", "category_sk"]

NUMBERS = ("licencersn", "licencerevisionnumber", "folderyear", "numberofemployees", "feepaid")
INSTANTS = ("issueddate", "expireddate", "extractdate")
RECORD_RULES = ProfileRules(
    number_columns=NUMBERS,
    instant_columns=INSTANTS,
    forms={
        **dict.fromkeys(NUMBERS, T.DECIMAL_SHAPE),
        **dict.fromkeys(INSTANTS, r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2}))?$"),
        "licencenumber": r"^\d{2}-\d{6,}$",
        "postalcode": T.POSTAL_SHAPE,
    },
    level_columns=("feepaid", "numberofemployees"),
    share_columns=("status", "businesstype", "businesssubtype", "unittype", "city", "province", "country", "localarea"),
)


def business_versions(spark: SparkSession, folder: str) -> DataFrame:
    fact = table(spark, folder, "fact_licence").filter("business_sk <> -1 and issued_date is not null")
    daily = fact.withColumn("_issued", D.utc_day(F.col("issued_date"), fact.schema["issued_date"].dataType))
    seen = latest_per_day(daily, "business_sk", "_issued", ["extract_date", "licence_rsn"], TRACKED, {"address_sk": -1, "category_sk": -1})
    return attribute_versions(seen, TRACKED)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every version of every business: start day and the next version's start."""
    v = business_versions(spark, folder)
    end = F.coalesce(D.ymd(F.col("valid_to")), F.lit(OPEN_END).cast("bigint"))
    return v.select(F.col("_entity").alias("business_sk"), D.ymd(F.col("valid_from")).alias("valid_from"), end.alias("valid_to"))


def p1_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The versions with the values that held at their start."""
    v = business_versions(spark, folder)
    end = F.coalesce(D.ymd(F.col("valid_to")), F.lit(OPEN_END).cast("bigint"))
    return v.select(F.col("_entity").alias("business_sk"), D.ymd(F.col("valid_from")).alias("valid_from"), end.alias("valid_to"), *TRACKED)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Continuous licensed periods of every business and the holes between them."""
    fact = table(spark, folder, "fact_licence").filter("business_sk <> -1")
    days = fact.select("business_sk", *[D.utc_day(F.col(c), fact.schema[c].dataType).alias(c) for c in ("issued_date", "expired_date")])
    found = periods_and_gaps(days, "business_sk", "issued_date", "expired_date")
    return found.select(F.col("_entity").alias("business_sk"), "kind", D.ymd(F.col("first_day")).alias("first_day"), D.ymd(F.col("last_day")).alias("last_day"))


YEAR, DAY, LICENCE = "__load_year", "__load_day", "__licence"


def delivered(spark: SparkSession, folder: str) -> DataFrame:
    """records with the load (four-digit year, UTC day of the extract) and the licence's number."""
    rows = table(spark, folder, "records")
    return rows.withColumns(
        {
            YEAR: D.century(T.whole_number(F.col("folderyear"))),
            DAY: D.utc_day(D.iso_instant(F.col("extractdate"))),
            LICENCE: T.whole_number(F.col("licencersn")),
        }
    )


def delivered_columns(rows: DataFrame, *without: str) -> list[str]:
    """The columns as delivered, but for ``without`` and what ``delivered`` adds."""
    return [c for c in rows.columns if c not in ("record_no", YEAR, DAY, LICENCE, *without)]


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Licences added, removed or changed from each load of a folder year to the next."""
    rows = delivered(spark, folder)
    compared = delivered_columns(rows, "licencersn", "extractdate")
    changes = snapshot_changes(rows, YEAR, DAY, LICENCE, compared)
    return changes.select(F.col("_g").alias("folder_year"), F.col("_key").alias("licence_rsn"), D.iso_day(F.col("_at")).alias("extract_day"), "change")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Breaks of each column of each load against the load before it."""
    rows = delivered(spark, folder)
    columns = delivered_columns(rows)
    loads, _, breaks = profile_loads(rows, YEAR, DAY, columns, RECORD_RULES)
    return breaks.join(loads, ["_g", "_n"]).select(F.col("_g").alias("folder_year"), D.iso_day(F.col("_at")).alias("extract_day"), "column_name", "finding")


def p7_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile itself: rows, missing, distinct values, range, values without the form, entropy."""
    rows = delivered(spark, folder)
    columns = delivered_columns(rows)
    loads, profiles, _ = profile_loads(rows, YEAR, DAY, columns, RECORD_RULES)
    return profiles.filter("rows > 0").join(loads, ["_g", "_n"]).select(
        F.col("_g").alias("folder_year"), D.iso_day(F.col("_at")).alias("extract_day"), "column_name", F.col("rows").alias("row_count"),
        F.col("missing").alias("missing_count"), F.col("distinct").alias("distinct_count"), F.col("least").alias("least_value"), F.col("most").alias("greatest_value"),
        "least_number", "greatest_number", "first_instant", "last_instant", F.col("lacking").alias("without_form"), T.rounded(F.col("entropy"), 6).alias("entropy_bits"),
    )


def p7_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Per column and load: values gained, values lost, and the sum of the signed deltas; a group's first load gains all it has."""
    rows = delivered(spark, folder)
    loads, changes = replay(rows, YEAR, DAY, delivered_columns(rows), delta_counts)
    return changes.join(loads, ["_g", "_n"]).select(F.col("_g").alias("folder_year"), D.iso_day(F.col("_at")).alias("extract_day"), "column_name", "values_gained", "values_lost", "net_rows")


QUERIES = {"p1_found": p1_found, "p1_versions": p1_versions, "p4_found": p4_found, "p5_found": p5_found, "p7_found": p7_found, "p7_profile": p7_profile, "p7_deltas": p7_deltas}
