"""Facts derived from licence records in sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from registra.functions import dates as D
from registra.functions import geo as G
from registra.functions import text as T
from registra.operators.dimensions import address_key, business_identity, member_key, sequence_order
from registra.operators.history import latest_per_day, snapshot_events
from registra.operators.sequence import as_of, first_known, greatest_per, last_known, per_year, previous_rows, spans, year_before
from registra.schema import UNKNOWN

FAR_FUTURE = "9999-12-31T00:00:00Z"
ATTRIBUTES = ["business_name", "status", "category_sk", "address_sk", "neighbourhood_sk"]


def keyed_licences(df: DataFrame) -> DataFrame:
    """Licence records with the keys of all dimensions, computed in the row and never joined."""
    keyed = business_identity(df)
    keys = {"address_key": address_key(), "area_key": member_key(["local_area"]), "category_key": member_key(["business_type", "business_subtype"]), "status_key": member_key(["status"])}
    for name in ("issued", "expired"):
        day = D.utc_day(F.col(f"{name}_date"), df.schema[f"{name}_date"].dataType)
        keys[f"{name}_key"] = F.coalesce(D.ymd(day), F.lit(UNKNOWN).cast("bigint"))
    out = keyed.withColumns(keys)
    if isinstance(df.schema["expired_date"].dataType, DateType):  # midnight UTC of the day
        out = out.withColumn("expired_date", F.timestamp_micros(F.unix_date("expired_date").cast("bigint") * F.lit(D.DAY_MICROS)))
    return out


def sequence_flags(fact: DataFrame, entity: str = "business_sk") -> DataFrame:
    """Adds is_current_revision, has_later_licence and is_latest_licence.

    The current revision is the highest of a licence number (ties all; no number: never). A later
    licence is any dated record behind this one in sequence; undated records come first. The latest has
    the business's greatest issue date, or none if it has none. All three are aggregates joined back:
    no business is gathered into one window.
    """
    order = sequence_order()
    revision = F.coalesce("licence_revision_number", F.lit(-1))
    if taken := {"_l", "_rev", "_e", "_end"} & {*fact.columns}:
        fact = fact.drop(*taken)
    top = fact.filter("licence_number is not null").groupBy(F.col("licence_number").alias("_l")).agg(F.max(revision).alias("_rev"))
    ends = greatest_per(fact, entity, order, "_end", F.col("issued_date").isNotNull())
    joined = fact.join(top, F.col("licence_number") == F.col("_l"), "left").join(ends, F.col(entity) == F.col("_e"), "left")
    own = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)])
    flags = {
        "is_current_revision": F.coalesce(revision == F.col("_rev"), F.lit(False)),
        "has_later_licence": F.coalesce(F.col("issued_date").isNull() & F.col("_end").isNotNull(), F.lit(False)) | F.coalesce(own < F.col("_end"), F.lit(False)),
        "is_latest_licence": F.col("issued_date").eqNullSafe(F.col("_end.c0")),
    }
    return joined.withColumns(flags).drop("_l", "_rev", "_e", "_end")


def lifecycles(fact: DataFrame) -> DataFrame:
    """One row per business over its current revisions: counts, first and last dates and years, last known state, span."""
    order = sequence_order()
    rows = sequence_flags(fact).filter("is_current_revision and business_sk <> -1")
    out = rows.groupBy("business_sk").agg(
        F.count_distinct("licence_number").alias("licence_count"), F.count(F.lit(1)).alias("record_count"), F.min("issued_date").alias("first_issued"), F.max("issued_date").alias("last_issued"),
        F.max("expired_date").alias("last_expired"), F.min("folder_year").alias("first_folder_year"), F.max("folder_year").alias("last_folder_year"),
        *[last_known(c, order).alias(f"latest_{c}") for c in ("status", "category_sk", "neighbourhood_sk", "address_sk")],
    )
    span = D.floor_days(F.coalesce("last_expired", "last_issued"), F.col("first_issued"))
    return out.withColumns({"span_days": span, "span_years": T.rounded(span / 365.25, 3)})


def relocations(fact: DataFrame, addresses: DataFrame) -> DataFrame:
    """Moves of single-site businesses between the years in which they held licences, with the distance.

    A business with two addresses in any one year is left out for good.
    """
    order = sequence_order()
    known = sequence_flags(fact).filter(F.col("is_current_revision") & (F.col("business_sk") != UNKNOWN) & (F.col("address_sk") != UNKNOWN))
    yearly = per_year(known, "business_sk", "folder_year", [F.count_distinct("address_sk").alias("sites"), *[first_known(c, order).alias(c) for c in ("address_sk", "neighbourhood_sk", "licence_number")], F.min("issued_date").alias("changed_on")])
    several = yearly.filter("sites > 1").select("business_sk").distinct()
    w = year_before("business_sk", "folder_year")
    single = yearly.join(several, "business_sk", "left_anti")
    lagged = single.select("*", *[F.lag(c).over(w).alias(f"from_{c}") for c in ("folder_year", "address_sk", "neighbourhood_sk", "licence_number")])
    moved = lagged.filter("from_address_sk is not null and from_address_sk <> address_sk")
    a = addresses.select(F.col("address_sk").alias("from_address_sk"), F.nanvl("latitude", F.lit(None).cast("double")).alias("_lat1"), F.nanvl("longitude", F.lit(None).cast("double")).alias("_lon1"))
    b = addresses.select("address_sk", F.nanvl("latitude", F.lit(None).cast("double")).alias("_lat2"), F.nanvl("longitude", F.lit(None).cast("double")).alias("_lon2"))
    km = T.rounded(G.haversine_km(F.col("_lat1"), F.col("_lon1"), F.col("_lat2"), F.col("_lon2")), 3)
    out = moved.join(a, "from_address_sk", "left").join(b, "address_sk", "left")
    return out.select(
        "business_sk", "from_folder_year", F.col("folder_year").alias("to_folder_year"), "from_address_sk", F.col("address_sk").alias("to_address_sk"), "from_licence_number",
        F.col("licence_number").alias("to_licence_number"), "changed_on", "from_neighbourhood_sk", F.col("neighbourhood_sk").alias("to_neighbourhood_sk"),
        (F.col("from_neighbourhood_sk") != F.col("neighbourhood_sk")).alias("crossed_neighbourhood"), km.alias("distance_km"),
    )


def transitions(fact: DataFrame) -> DataFrame:
    """Consecutive records of a business whose known statuses differ, with where the change came from and after how long."""
    rows = fact.filter("business_sk <> -1").select("business_sk", "status", "issued_date", "licence_number", "licence_revision_number", "licence_rsn")
    seen = previous_rows(rows, "business_sk", sequence_order(), ["status", "issued_date", "licence_number"])
    changed = seen.filter("status is not null and previous_status is not null and status <> previous_status")
    return changed.select(
        "business_sk", F.col("previous_status").alias("from_status"), F.col("status").alias("to_status"), F.col("issued_date").alias("effective_date"), F.col("previous_issued_date").alias("previous_date"),
        F.col("previous_licence_number").alias("from_licence_number"), F.col("licence_number").alias("to_licence_number"),
        F.when(F.col("licence_number") == F.col("previous_licence_number"), "revision").otherwise("renewal").alias("transition_source"),
        D.floor_days(F.col("issued_date"), F.col("previous_issued_date")).alias("days_in_previous_status"),
    )


def renewals(fact: DataFrame) -> DataFrame:
    """Each year a business holds licences after an earlier such year, with the gap to its last expiry."""
    order = sequence_order()
    rows = sequence_flags(fact).filter("is_current_revision and business_sk <> -1")
    yearly = per_year(rows, "business_sk", "folder_year", [F.count_distinct("licence_number").alias("licences_held"), F.min("issued_date").alias("renewed_on"), F.max("expired_date").alias("_expired"), last_known("status", order).alias("status_after")])
    w = year_before("business_sk", "folder_year")
    lagged = yearly.select("*", F.lag("folder_year").over(w).alias("from_folder_year"), F.lag("renewed_on").over(w).alias("previous_first_issued"), F.lag("_expired").over(w).alias("previous_last_expired"))
    gap = D.floor_days(F.col("renewed_on"), F.col("previous_last_expired"))
    out = lagged.filter("from_folder_year is not null").withColumns({"gap_days": gap, "year_gap": F.col("folder_year") - F.col("from_folder_year")})
    return out.select(
        "business_sk", "from_folder_year", F.col("folder_year").alias("to_folder_year"), "previous_first_issued", "previous_last_expired", "renewed_on", "licences_held", "status_after", "gap_days", "year_gap",
        F.coalesce(F.col("gap_days") <= 0, F.lit(False)).alias("renewed_before_expiry"), F.coalesce(F.col("gap_days") > 0, F.lit(False)).alias("lapsed_then_renewed"), (F.col("year_gap") > 1).alias("skipped_a_year"),
    )


def attribute_history(fact: DataFrame) -> DataFrame:
    """Type 2 history by record: a version starts with a business's first record and wherever a known attribute differs from the record before.

    All records count, undated ones (first in sequence) and several of one day too. Versions are half-open
    from their least issue date (null if undated) to the next version's, the last one to ``FAR_FUTURE``.
    Values and the licence number are the first known ones of the version.
    """
    order = sequence_order()
    rows = spans(fact.filter("business_sk <> -1"), "business_sk", order, ATTRIBUTES)
    versions = rows.groupBy("business_sk", "_span").agg(
        F.min("issued_date").alias("valid_from"), *[first_known(c, order).alias(c) for c in (*ATTRIBUTES, "licence_number")],
        F.array_join(F.min_by("_why", F.struct(*order)), ";").alias("_why"), F.count(F.lit(1)).alias("record_count"),
    )
    followed = previous_rows(versions, "business_sk", [-F.col("_span")], ["valid_from"], "_next_")
    end = F.coalesce("_next_valid_from", F.lit(FAR_FUTURE).cast("timestamp"))
    return followed.select(
        "business_sk", "valid_from", end.alias("valid_to"), F.col("_next_valid_from").isNull().alias("is_current"), *ATTRIBUTES, "licence_number",
        F.coalesce(F.nullif("_why", F.lit("")), F.lit("initial")).alias("change_reason"), "record_count",
    )


def as_was(fact: DataFrame) -> DataFrame:
    """Dated records with the status and category that their business's history shows for their day."""
    dated = fact.filter("business_sk <> -1 and issued_date is not null").withColumn("_issued", D.utc_day(F.col("issued_date"), fact.schema["issued_date"].dataType))
    daily = latest_per_day(dated, "business_sk", "_issued", ["extract_date", "licence_rsn"], ATTRIBUTES, dict.fromkeys(["category_sk", "address_sk", "neighbourhood_sk"], UNKNOWN))
    versions = snapshot_events(daily, ATTRIBUTES).filter("_kind <> 'deleted'").select(F.col("_entity").alias("business_sk"), F.col("_day").alias("_issued"), F.col("status").alias("as_was_status"), F.col("category_sk").alias("as_was_category_sk"))
    held = as_of(versions, dated, "business_sk", "_issued", "_issued", ["as_was_status", "as_was_category_sk"])
    return dated.select("licence_rsn", "business_sk", "_issued").join(held, ["business_sk", "_issued"]).select("licence_rsn", "business_sk", "as_was_status", "as_was_category_sk")
