"""Deciding what to load again, and whether a load can be trusted."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.schema import COLUMNS, GEO, Rules


@dataclass(frozen=True)
class Verdict:
    """What a check of a load found: reasons to stop and remarks."""

    stop: tuple[str, ...]
    warn: tuple[str, ...]

    @property
    def ok(self) -> bool:
        return not self.stop


def probe(df: DataFrame, partition: Column, watermark: Column) -> DataFrame:
    """``partition``, ``row_count``, ``watermark`` (greatest) of each partition."""
    return df.groupBy(partition.alias("partition")).agg(F.count(F.lit(1)).alias("row_count"), F.max(watermark).alias("watermark"))


def refresh_plan(offered: DataFrame, held: DataFrame) -> DataFrame:
    """For each partition on either side whether it has to be loaded, and why.

    ``new`` is held nowhere, ``gone`` is no longer offered (and kept), ``watermark`` and ``row_count`` differ,
    else ``current``.
    """
    a = offered.select("partition", F.col("row_count").alias("_n"), F.col("watermark").alias("_w"))
    b = held.select("partition", F.col("row_count").alias("_hn"), F.col("watermark").alias("_hw"))
    both = a.join(b, "partition", "full")
    reason = F.when(F.col("_hn").isNull(), "new").when(F.col("_n").isNull(), "gone").when(~F.col("_w").eqNullSafe(F.col("_hw")), "watermark").when(F.col("_n") != F.col("_hn"), "row_count").otherwise("current")
    return both.select("partition", reason.alias("reason")).withColumn("refresh", F.col("reason").isin("new", "watermark", "row_count"))


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name``, ``null_rate`` (four digits) of every column in one pass; an empty table has rates of null."""
    rates = df.agg(*[F.round(F.avg(F.col(c).isNull().cast("int")), 4).alias(c) for c in columns])
    return rates.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rate")) for c in columns])))


def null_drift(now: DataFrame, before: DataFrame, tolerance: float) -> DataFrame:
    """Columns whose null rate moved by more than ``tolerance``."""
    both = now.join(before.select("column_name", F.col("null_rate").alias("previous_rate")), "column_name")
    return both.filter(F.abs(F.col("null_rate") - F.col("previous_rate")) > tolerance)


def volume_drift(counts: DataFrame, shrink: float) -> DataFrame:
    """``partition``, ``row_count``, ``previous_count``, ``change``: partitions that shrank by more than ``shrink``."""
    change = F.try_divide(F.col("row_count") - F.col("previous_count"), F.col("previous_count").cast("double"))
    return counts.withColumn("change", F.round(change, 4)).filter(F.col("change") < -shrink)


def histogram(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most first; ``top`` keeps so many (ties by value)."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return out if top is None else out.orderBy(F.desc("n"), F.asc_nulls_first(column)).limit(top)


def partition_profile(df: DataFrame, partition: Column, key: str, issued: str, watermark: str, rates: tuple[str, ...] = (), statuses: tuple[str, ...] = ()) -> DataFrame:
    """Rows, distinct keys, surplus rows, undated rows and the span of the watermark, per partition.

    With ``rates`` also ``null_rate_<column>`` (four digits) of those columns, with ``statuses`` the rows of
    each of those values of ``status`` as ``rows_<value>``.
    """
    out = df.groupBy(partition.alias("partition")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("distinct_keys"), F.count_if(F.col(issued).isNull()).alias("undated"), F.min(watermark).alias("watermark_min"), F.max(watermark).alias("watermark_max"),
        *[F.round(F.avg(F.col(c).isNull().cast("int")), 4).alias(f"null_rate_{c}") for c in rates],
        *[F.count_if(F.col("status") == s).alias(f"rows_{s.lower().replace(' ', '_')}") for s in statuses],
    )
    return out.withColumn("surplus_rows", F.col("row_count") - F.col("distinct_keys"))


def reconcile(offered: DataFrame, held: DataFrame) -> DataFrame:
    """Counts by partition on both sides: ``match``, ``MISMATCH``, or ``partial`` where a side is missing."""
    both = offered.select("partition", F.col("row_count").alias("offered")).join(held.select("partition", F.col("row_count").alias("held")), "partition", "full")
    return both.withColumn("verdict", F.when(F.col("offered").isNull() | F.col("held").isNull(), "partial").when(F.col("offered") == F.col("held"), "match").otherwise("MISMATCH"))


def check_load(raw: DataFrame, partition: str, rules: Rules, previous_rows: int | None = None, previous_rates: dict[str, float] | None = None, strict: bool = False) -> Verdict:
    """Whether a freshly loaded partition can replace what is held; one pass over its rows.

    Stops: no rows, unknown columns, no key column, null keys, rows of another partition, a shrink beyond
    ``rules.shrink``, and duplicates if ``strict``. Remarks: missing columns, duplicates (with up to ten of
    the keys), licence numbers whose revision occurs again, null rates that moved beyond
    ``rules.null_drift``, nulls where none belong.
    """
    expected = {*COLUMNS, *GEO}
    stop = [f"unknown column {c}" for c in sorted({*raw.columns} - expected)]
    warn = [f"missing column {c}" for c in sorted(expected - {*raw.columns})]
    if "licencersn" not in raw.columns:
        return Verdict((*stop, "no key column"), tuple(warn))
    here = [c for c in raw.columns if c in expected]
    stray = F.count_if(~F.col("folderyear").eqNullSafe(F.lit(partition))) if "folderyear" in raw.columns else F.lit(0)
    row = raw.agg(F.count(F.lit(1)).alias("_n"), F.count_distinct("licencersn").alias("_keys"), stray.alias("_stray"), *[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in here]).first()
    if not row["_n"]:
        return Verdict((*stop, "no rows"), tuple(warn))
    if row["licencersn"]:
        stop.append("null keys")
    if row["_stray"]:
        stop.append(f"{row['_stray']} rows of another partition")
    if previous_rows and (row["_n"] - previous_rows) / previous_rows < -rules.shrink:
        stop.append(f"shrank from {previous_rows} to {row['_n']} rows")
    if row["_keys"] < row["_n"]:
        (stop if strict else warn).append(f"{row['_n'] - row['_keys']} duplicate keys")
        again = raw.groupBy("licencersn").count().filter("count > 1 and licencersn is not null").orderBy("licencersn").limit(10).collect()
        warn.append(f"repeated keys: {', '.join(r.licencersn for r in again)}")
    if {"licencenumber", "licencerevisionnumber"} <= {*here}:
        reused = raw.groupBy("licencenumber", "licencerevisionnumber").count().agg(F.sum(F.col("count") - 1)).first()[0]
        if reused:
            warn.append(f"{reused} rows share licence number and revision with another")
    warn += [f"null rate of {c} moved" for c in here if previous_rates and c in previous_rates and abs(row[c] - previous_rates[c]) > rules.null_drift]
    warn += [f"nulls in {c}" for c in here if c not in rules.nullable and c != "licencersn" and row[c]]
    return Verdict(tuple(stop), tuple(warn))
