"""Surrogate keys: the same key for the same natural key on every run."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

UNIT_SEPARATOR = "\x1f"


def natural_key(parts: list[Column]) -> Column:
    """The parts, trimmed, null as empty, with separators kept in place."""
    return F.concat_ws(UNIT_SEPARATOR, *[F.coalesce(F.trim(p), F.lit("")) for p in parts])


def surrogate(parts: list[Column]) -> Column:
    """60 bits of the MD5 of the natural key, as a positive bigint; stays inside code generation."""
    return F.conv(F.substring(F.md5(natural_key(parts).cast("binary")), 1, 15), 16, 10).cast("bigint")


@F.pandas_udf(LongType())
def blake_key(keys: pd.Series) -> pd.Series:
    """Signed 64-bit BLAKE2b of a natural key (big-endian), for tables that were keyed that way; null stays null."""
    return keys.map(lambda k: int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "big", signed=True), na_action="ignore").astype("Int64")
