"""Standard text, soft flags, one row per key, and counts of all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.functions import dates as D
from registra.functions import geo as G
from registra.functions import text as T
from registra.schema import GEO, Rules
from registra.session import free


def standardise(df: DataFrame, rules: Rules) -> DataFrame:
    """White space squeezed, letter case by column, postal codes in one form, and a key of the name."""
    out = {c: T.squeeze(F.col(c)) for c in rules.kept_case if c in df.columns}
    out |= {c: T.title(T.squeeze(F.col(c))) for c in rules.title_case if c in df.columns}
    out |= {c: F.upper(T.squeeze(F.col(c))) for c in rules.upper_case if c in df.columns}
    df = df.withColumns(out)
    if "postal_code" in df.columns:
        df = df.withColumn("postal_code", T.postal(F.col("postal_code"))).withColumn("postal_code_valid", T.postal_valid(F.col("postal_code")))
    return df.withColumn("business_name_key", T.plain_key(F.col("business_name"))) if "business_name" in df.columns else df


def locate(df: DataFrame) -> DataFrame:
    """Latitude, longitude and whether there are any, out of the geo columns, which go."""
    spot = G.coordinates(F.col("geo_point_2d"), F.col("geom"))
    df = df.withColumn("_spot", spot)
    return df.withColumns({"latitude": F.col("_spot.lat"), "longitude": F.col("_spot.lon"), "has_coordinates": F.col("_spot").isNotNull()}).drop("_spot", *GEO)


def coordinate_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows with and without coordinates, off the earth and outside the region, in one pass."""
    lat, lon = F.col("latitude"), F.col("longitude")
    there = lat.isNotNull() & lon.isNotNull()
    on = lat.between(*rules.latitude) & lon.between(*rules.longitude)
    near = lat.between(*rules.region_latitude) & lon.between(*rules.region_longitude)
    return df.agg(F.count_if(there).alias("with_coordinates"), F.count_if(~there).alias("without_coordinates"), F.count_if(there & ~on).alias("off_earth"), F.count_if(there & ~near).alias("outside_region"))


def flag_checks(rules: Rules, now: str) -> dict[str, Column]:
    """The soft checks in the order in which their flags are listed."""
    issued, expired = F.col("issued_date"), F.col("expired_date")
    lat, lon = F.col("latitude"), F.col("longitude")
    checks = {
        "future_issued_date": issued > F.lit(now).cast("timestamp"),
        "expired_before_issued": F.unix_date(expired) < D.utc_day(issued),
        "unknown_status": ~F.col("status").isin(*rules.known_status),
        "postal_code_not_canadian": ~F.col("postal_code_valid"),
        "coordinates_out_of_bounds": ~(lat.between(*rules.latitude) & lon.between(*rules.longitude)),
    }
    return checks | {f"null_{c}": F.col(c).isNull() for c in rules.required if c != rules.key}


def flag(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``dq_flags``: the names of the checks that hold, joined by ``;``, or null; no row is dropped."""
    return df.withColumn("dq_flags", F.nullif(F.concat_ws(";", *[F.when(v, F.lit(k)) for k, v in checks.items()]), F.lit("")))


def null_count(columns: list[str]) -> Column:
    out = F.lit(0)
    for c in columns:
        out = out + F.col(c).isNull().cast("int")
    return out


def one_per_key(df: DataFrame, key: str, order: list[Column], row_id: str) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and rejected ones with ``dq_reject_reason``; nothing is lost between the two.

    Of the rows of a key the one with the greatest ``order`` is kept (nulls lowest), ties by the least
    ``row_id``, which must tell rows apart. Rows with a null key are rejected. The winner is an
    aggregate combined map-side, so a hot key is never gathered.
    """
    known = df.filter(F.col(key).isNotNull())
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], (-F.col(row_id)).alias("r"))
    of, won = free(df, "_key"), free(df, "_best")
    kept = known.groupBy(F.col(key).alias(of)).agg(F.max_by(F.struct(*known.columns), rank).alias(won)).select(f"{won}.*")
    best = known.groupBy(F.col(key).alias(of)).agg(F.max_by(F.col(row_id), rank).alias(won))
    judged = known.join(best, F.col(key) == F.col(of)).drop(of)
    lost = judged.filter(F.col(row_id) != F.col(won)).drop(won).withColumn("dq_reject_reason", F.lit(f"duplicate_{key}_lost_tiebreak"))
    return kept, df.filter(F.col(key).isNull()).withColumn("dq_reject_reason", F.lit(f"null_{key}")).unionByName(lost)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys of more than one row, with the number of rows."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def flag_counts(df: DataFrame, column: str = "dq_flags") -> DataFrame:
    """How often each flag was raised."""
    return df.filter(F.col(column).isNotNull()).select(F.explode(F.split(column, ";")).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def day_window(df: DataFrame, column: str, since: str | None = None, until: str | None = None, undated: bool = False) -> DataFrame:
    """Rows of the days from ``since`` to ``until``, both included; undated rows only if asked for; no bounds change nothing."""
    if since is None and until is None:
        return df
    day = D.utc_day(F.col(column), df.schema[column].dataType)
    keep = F.lit(True)
    if since is not None:
        keep = keep & (day >= F.unix_date(F.lit(since).cast("date")))
    if until is not None:
        keep = keep & (day <= F.unix_date(F.lit(until).cast("date")))
    return df.filter(F.coalesce(keep, F.lit(undated)))


def overlapping(df: DataFrame, first: str, last: str, start: str, end: str) -> DataFrame:
    """Rows whose period meets ``start`` to ``end``; an unknown end is open."""
    a, b = (D.utc_day(F.col(c), df.schema[c].dataType) for c in (first, last))
    return df.filter((a.isNull() | (a <= F.unix_date(F.lit(end).cast("date")))) & (b.isNull() | (b >= F.unix_date(F.lit(start).cast("date")))))
