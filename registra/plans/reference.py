"""One named query per operator of the pipeline, over the register's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.functions import dates as D
from registra.functions import geo as G
from registra.functions import text as T
from registra.functions.keys import blake_key, natural_key
from registra.operators import dimensions as dims
from registra.operators import facts, incremental, marts, quality
from registra.operators.casting import cast_losses, curated_columns
from registra.operators.curate import checked, curate, with_day_keys, write_summary
from registra.operators.sequence import greatest_per
from registra.schema import Rules
from registra.session import table

RULES = Rules()
NOW = "2026-06-01 00:00:00"
SINCE, UNTIL = "2025-03-01", "2025-09-30"
START, END = "2024-01-01", "2025-12-31"
STREAMLINED = "2024-05-06"
STATES = ["Issued", "Pending", "Cancelled", "Inactive", "Gone Out of Business", "Suspended", "Active"]
ENDED = ["Cancelled", "Gone Out of Business"]


def seconds(c: str) -> Column:
    return F.unix_seconds(c).alias(c)


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "records")


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps as epoch seconds and dates as text, so that results compare everywhere."""
    out = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        out.append(seconds(f.name) if kind == "timestamp" else F.col(f.name).cast("string").alias(f.name) if kind == "date" else F.col(f.name))
    return df.select(*out)


def _year(c: str = "folderyear") -> Column:
    return D.century(T.whole_number(F.col(c)))


def scan_project_rename(spark, folder):
    return _plain(curated_columns(_records(spark, folder), also=("record_no",)))


def safe_cast_losses(spark, folder):
    return cast_losses(_records(spark, folder))


def two_digit_year(spark, folder):
    return _records(spark, folder).groupBy("folderyear").agg(F.count(F.lit(1)).alias("n")).withColumn("folder_year", _year())


def partition_discovery(spark, folder):
    return _records(spark, folder).groupBy(_year().alias("folder_year")).agg(F.count(F.lit(1)).alias("n")).filter("folder_year >= 2025")


def _probe(spark, folder):
    return incremental.probe(_records(spark, folder), _year(), D.iso_instant(F.col("extractdate")))


def _held(spark, folder):
    return incremental.probe(table(spark, folder, "curated_licence"), F.col("folder_year"), F.col("extract_date"))


def partition_probe(spark, folder):
    return _plain(_probe(spark, folder))


def needs_refresh(spark, folder):
    return incremental.refresh_plan(_probe(spark, folder), _held(spark, folder))


def partition_profile(spark, folder):
    rows = curated_columns(_records(spark, folder))
    return _plain(incremental.partition_profile(rows, F.col("folder_year"), "licence_rsn", "issued_date", "extract_date", ("licence_number", "postal_code", "fee_paid"), RULES.known_status))


def null_rate_profile(spark, folder):
    rows = _records(spark, folder)
    return incremental.null_rates(rows, [c for c in rows.columns if c != "record_no"])


def null_rate_drift(spark, folder):
    rows = _records(spark, folder).withColumn("_y", _year())
    names = [c for c in rows.columns if c not in ("record_no", "_y")]
    return incremental.null_drift(incremental.null_rates(rows.filter("_y = 2026"), names), incremental.null_rates(rows.filter("_y = 2025"), names), 0.01)


def volume_drift(spark, folder):
    a = _probe(spark, folder).select("partition", "row_count")
    b = a.select((F.col("partition") + 1).alias("partition"), F.col("row_count").alias("previous_count"))
    return incremental.volume_drift(a.join(b, "partition"), 0.10)


def value_histogram(spark, folder):
    return incremental.histogram(_records(spark, folder), "status")


def topk_histogram(spark, folder):
    return incremental.histogram(_records(spark, folder).filter("localarea is not null"), "localarea", 5)


def json_props_extract(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", T.whole_number(F.get_json_object("props", "$.k")).alias("k"), "event_type")


def _spots(spark, folder):
    return _records(spark, folder).select("record_no", G.coordinates(F.col("geo_point_2d"), F.col("geom")).alias("s"), G.point_object(F.col("geo_point_2d")).alias("o"), G.point_text(F.col("geo_point_2d")).alias("t"), G.geometry(F.col("geom")).alias("g"))


def geo_point_parse(spark, folder):
    return _spots(spark, folder).select("record_no", F.col("s.lat").alias("latitude"), F.col("s.lon").alias("longitude"))


def geo_precedence(spark, folder):
    source = F.when(F.col("o").isNotNull(), "object").when(F.col("t").isNotNull(), "text").when(F.col("g").isNotNull(), "geometry").otherwise("none")
    return _spots(spark, folder).groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("n"))


def coordinate_accounting(spark, folder):
    return quality.coordinate_counts(table(spark, folder, "curated_licence").select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("latitude", "longitude")]), RULES)


def text_whitespace(spark, folder):
    return _records(spark, folder).select("record_no", T.squeeze(F.col("businessname")).alias("business_name"))


def text_title_case(spark, folder):
    return _records(spark, folder).select("street").distinct().select("street", T.title(T.squeeze(F.col("street"))).alias("titled"))


def text_name_key(spark, folder):
    return _records(spark, folder).select("record_no", T.plain_key(T.squeeze(F.col("businessname"))).alias("name_key"))


def identity_key(spark, folder):
    rows = dims.business_identity(table(spark, folder, "curated_licence"))
    return rows.select("licence_rsn", "business_identity_key", "identity_source", "business_key")


def postal_normalise(spark, folder):
    return _records(spark, folder).select("postalcode").distinct().select("postalcode", T.postal(F.col("postalcode")).alias("postal_code"), T.postal_valid(T.postal(F.col("postalcode"))).alias("valid"))


def dq_flags(spark, folder):
    return checked(_records(spark, folder), RULES, NOW).select("record_no", "dq_flags")


def flag_explode_count(spark, folder):
    return quality.flag_counts(checked(_records(spark, folder), RULES, NOW))


def _curated(spark, folder):
    rows = checked(_records(spark, folder), RULES, NOW)
    order = [-quality.null_count([c for c in rows.columns if c != "record_no"]), F.col("extract_date"), F.col("licence_revision_number")]
    return quality.one_per_key(rows, "licence_rsn", order, "record_no")


def pk_dedupe_keep(spark, folder):
    return _plain(_curated(spark, folder)[0])


def pk_dedupe_rejects(spark, folder):
    return _curated(spark, folder)[1].select("record_no", "licence_rsn", "dq_reject_reason")


def duplicate_keys(spark, folder):
    return quality.duplicate_keys(curated_columns(_records(spark, folder)), "licence_rsn")


def transform_summary(spark, folder):
    return write_summary(*curate(_records(spark, folder), RULES, NOW))


def transform_window(spark, folder):
    kept, _ = curate(_records(spark, folder), RULES, NOW, since=SINCE, until=UNTIL)
    return kept.select("licence_rsn", seconds("issued_date"), "business_name_key", "postal_code", "dq_flags")


def date_window(spark, folder):
    return quality.day_window(table(spark, folder, "curated_licence"), "issued_date", SINCE, UNTIL, undated=True).select("licence_rsn", seconds("issued_date"))


def period_overlap(spark, folder):
    return quality.overlapping(table(spark, folder, "curated_licence"), "issued_date", "expired_date", START, END).select("licence_rsn")


def dim_business(spark, folder):
    return dims.dim_business(table(spark, folder, "curated_licence"))


def dim_address(spark, folder):
    return dims.dim_address(table(spark, folder, "curated_licence"))


def dim_neighbourhood(spark, folder):
    return dims.dim_members(table(spark, folder, "curated_licence"), ["local_area"], "area_key")


def dim_category(spark, folder):
    return dims.dim_category(table(spark, folder, "curated_licence"), STREAMLINED)


def dim_status(spark, folder):
    return dims.dim_members(table(spark, folder, "curated_licence"), ["status"], "status_key")


def dim_date(spark, folder):
    return dims.dim_date(table(spark, folder, "curated_licence"), ["issued_date", "expired_date", "extract_date"])


def blake_keys(spark, folder):
    """Keys as the given dimensions have them, made anew from the members' names."""
    status = table(spark, folder, "curated_licence").filter("status is not null").select(F.lit("status").alias("dimension"), F.col("status").alias("member"), natural_key([F.col("status")]).alias("k")).distinct()
    area = table(spark, folder, "curated_licence").filter("local_area is not null").select(F.lit("area").alias("dimension"), F.col("local_area").alias("member"), natural_key([F.col("local_area")]).alias("k")).distinct()
    return status.unionByName(area).select("dimension", "member", blake_key("k").alias("member_key"))


def fact_licence(spark, folder):
    keyed = facts.keyed_licences(table(spark, folder, "curated_licence"))
    flagged = facts.sequence_flags(keyed, "business_key")
    return flagged.select(
        "licence_rsn", "business_key", "address_key", "area_key", "category_key", "status_key", "issued_key", "expired_key", "fee_paid", "number_of_employees", "is_current_revision", "has_later_licence", "is_latest_licence"
    )


def _fact(spark, folder):
    return table(spark, folder, "fact_licence")


def current_revision(spark, folder):
    return facts.sequence_flags(_fact(spark, folder)).filter("is_current_revision").select("licence_rsn", "licence_number")


def has_later(spark, folder):
    return facts.sequence_flags(_fact(spark, folder)).select("licence_rsn", "has_later_licence", "is_latest_licence")


def latest_record(spark, folder):
    out = greatest_per(_fact(spark, folder).filter("business_sk <> -1"), "business_sk", dims.sequence_order(), "_end")
    return out.select(F.col("_e").alias("business_sk"), F.col("_end.c3").alias("licence_rsn"))


def business_lifecycle(spark, folder):
    return _plain(facts.lifecycles(_fact(spark, folder)))


def address_change(spark, folder):
    return _plain(facts.relocations(_fact(spark, folder), table(spark, folder, "dim_address")))


def haversine(spark, folder):
    a = table(spark, folder, "dim_address").filter("latitude is not null and not isnan(latitude)")
    return a.select("address_sk", T.rounded(G.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(49.25), F.lit(-123.1)), 3).alias("km"))


def business_history(spark, folder):
    return _plain(facts.attribute_history(_fact(spark, folder)))


def as_was_join(spark, folder):
    return facts.as_was(_fact(spark, folder))


def status_transition(spark, folder):
    return _plain(facts.transitions(_fact(spark, folder)))


def top_transitions(spark, folder):
    moves = facts.transitions(_fact(spark, folder)).groupBy("from_status", "to_status").agg(F.count(F.lit(1)).alias("n"))
    return moves.orderBy(F.desc("n"), "from_status", "to_status").limit(5)


def renewal(spark, folder):
    return _plain(facts.renewals(_fact(spark, folder)))


def mart_neighbourhood(spark, folder):
    return marts.activity_by_area(_fact(spark, folder), table(spark, folder, "dim_neighbourhood"), STATES, ENDED, START, END)


def mart_lifespan(spark, folder):
    first = _fact(spark, folder).agg(F.min("folder_year")).first()[0]
    return marts.spans_by_category(_fact(spark, folder), table(spark, folder, "dim_category"), first)


def mart_address(spark, folder):
    return _plain(marts.labelled_moves(_fact(spark, folder), table(spark, folder, "dim_address"), table(spark, folder, "dim_neighbourhood")))


def daily_partition_keys(spark, folder):
    return with_day_keys(table(spark, folder, "curated_licence")).groupBy("year", "month", "issued_day").agg(F.count(F.lit(1)).alias("n"))


def undated_routing(spark, folder):
    return with_day_keys(table(spark, folder, "curated_licence")).filter("issued_date is null").select("licence_rsn", "year", "month", "issued_day")


def reconcile_counts(spark, folder):
    return incremental.reconcile(_probe(spark, folder), _held(spark, folder))


def fanout_guard(spark, folder):
    return dims.fanout(table(spark, folder, "dim_address"), "address_sk").unionByName(dims.fanout(table(spark, folder, "dim_category").withColumnRenamed("category_sk", "address_sk"), "address_sk"))


def anti_join_multi_site(spark, folder):
    rows = _fact(spark, folder).filter("business_sk <> -1 and address_sk <> -1 and folder_year is not null")
    several = rows.groupBy("business_sk", "folder_year").agg(F.count_distinct("address_sk").alias("sites")).filter("sites > 1").select("business_sk").distinct()
    return rows.select("business_sk").distinct().join(several, "business_sk", "left_anti")


NAMES = (
    "scan_project_rename safe_cast_losses two_digit_year partition_discovery partition_probe needs_refresh partition_profile null_rate_profile null_rate_drift volume_drift value_histogram topk_histogram "
    "json_props_extract geo_point_parse geo_precedence coordinate_accounting text_whitespace text_title_case text_name_key identity_key postal_normalise dq_flags flag_explode_count pk_dedupe_keep "
    "pk_dedupe_rejects duplicate_keys transform_summary transform_window date_window period_overlap dim_business dim_address dim_neighbourhood dim_category dim_status dim_date blake_keys fact_licence "
    "current_revision has_later latest_record business_lifecycle address_change haversine business_history as_was_join status_transition top_transitions renewal mart_neighbourhood mart_lifespan mart_address "
    "daily_partition_keys undated_routing reconcile_counts fanout_guard anti_join_multi_site"
).split()
QUERIES = {name: globals()[name] for name in NAMES}
