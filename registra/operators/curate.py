"""Raw records to curated and rejected rows, and their daily files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.functions import dates as D
from registra.operators.casting import curated_columns
from registra.operators.quality import day_window, flag, flag_checks, locate, null_count, one_per_key, standardise
from registra.schema import Rules
from registra.session import busy


def checked(raw: DataFrame, rules: Rules, now: str, row_id: str = "record_no") -> DataFrame:
    """Raw rows renamed, cast, standardised, located and flagged; ``row_id`` stays beside them."""
    typed = curated_columns(busy(raw), also=("geom", "geo_point_2d", row_id))
    return flag(locate(standardise(typed, rules)), flag_checks(rules, now))


def curate(raw: DataFrame, rules: Rules, now: str, row_id: str = "record_no", since: str | None = None, until: str | None = None, undated: bool = False) -> tuple[DataFrame, DataFrame]:
    """Curated rows, one per key, and rejected rows.

    Keys are made unique over all raw rows before the window is cut, so a window never brings back a
    row that lost; the window does not apply to rejects.
    """
    rows = checked(raw, rules, now, row_id)
    order = [-null_count([c for c in rows.columns if c != row_id]), F.col("extract_date"), F.col("licence_revision_number")]
    kept, rejected = one_per_key(rows, rules.key, order, row_id)
    return day_window(kept, "issued_date", since, until, undated).drop(row_id), rejected.drop(row_id)


def with_day_keys(df: DataFrame) -> DataFrame:
    """``year``, ``month`` and ``issued_day`` folders; undated rows go to their folder year and ``unknown``."""
    day = F.date_from_unix_date(D.utc_day(F.col("issued_date"), df.schema["issued_date"].dataType))
    year = F.coalesce(F.lpad(F.year(day).cast("string"), 4, "0"), F.col("folder_year").cast("string"), F.lit("unknown"))
    return df.withColumns({"year": year, "month": F.coalesce(F.lpad(F.month(day).cast("string"), 2, "0"), F.lit("unknown")), "issued_day": F.coalesce(day.cast("string"), F.lit("no-issued-date"))})


def write_daily(df: DataFrame, path: str, whole: bool = True) -> None:
    """Write by day. ``whole`` replaces everything; else only the days in ``df`` are replaced.

    Rows are sent to one writer per day and a few more for large days, so small days make one file.
    """
    rows = with_day_keys(df)
    writer = rows.repartition("year", "month", "issued_day").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "static" if whole else "dynamic").partitionBy("year", "month", "issued_day").parquet(path)


def write_summary(curated: DataFrame, rejected: DataFrame) -> DataFrame:
    """``measure``, ``n``: rows curated, flagged and rejected, each flag and each reason."""
    rows = curated.agg(F.count(F.lit(1)).alias("curated"), F.count("dq_flags").alias("flagged"))
    rows = rows.select(F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("n")) for c in ("curated", "flagged")])))
    flags = curated.filter("dq_flags is not null").select(F.explode(F.split("dq_flags", ";")).alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("flag:"), "f").alias("measure"), "n")
    reasons = rejected.groupBy("dq_reject_reason").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("reject:"), "dq_reject_reason").alias("measure"), "n")
    return rows.unionByName(flags).unionByName(reasons)
