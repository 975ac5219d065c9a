"""Raw columns to curated names and types; a failed cast gives null and is counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.functions import dates as D
from registra.functions import text as T
from registra.schema import COLUMNS, GEO


def cast_to(c: Column, kind: str) -> Column:
    """A text as the curated type; null on failure, never an error."""
    if kind == "bigint":
        return T.rounded_number(c)
    if kind == "double":
        return T.number(c)
    if kind == "timestamp":
        return D.iso_instant(c)
    if kind == "date":
        return F.date_from_unix_date(D.utc_day(D.iso_instant(c)))
    return c


def curated_columns(raw: DataFrame, columns: dict[str, tuple[str, str]] = COLUMNS, also: tuple[str, ...] = GEO) -> DataFrame:
    """Rename, select and cast; columns missing in ``raw`` come out null, unknown ones are dropped but for ``also``."""
    out = []
    for name, (to, kind) in columns.items():
        value = cast_to(F.col(name), kind) if name in raw.columns else F.lit(None).cast(kind)
        out.append((D.century(value) if to == "folder_year" else value).alias(to))
    return raw.select(*out, *[F.col(c) for c in also if c in raw.columns])


def cast_losses(raw: DataFrame, columns: dict[str, tuple[str, str]] = COLUMNS) -> DataFrame:
    """``column_name``, ``lost``: values that were there and did not survive the cast, in one pass."""
    typed = {n: (to, kind) for n, (to, kind) in columns.items() if kind != "string" and n in raw.columns}
    counts = raw.agg(*[F.count_if(F.col(n).isNotNull() & cast_to(F.col(n), kind).isNull()).alias(to) for n, (to, kind) in typed.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(to).alias("column_name"), F.col(to).alias("lost")) for to, _ in typed.values()])))
