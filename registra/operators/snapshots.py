"""What changed between consecutive full snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registra.functions import text as T
from registra.session import cut, small_side


def row_digest(columns: list[Column]) -> list[Column]:
    """Two independent 64-bit hashes of a row's canonical text."""
    row = T.canonical(columns)
    return [F.xxhash64(row), F.xxhash64(F.lit("second"), row)]


def number_loads(loads: DataFrame, group: str, at: str) -> DataFrame:
    """Each distinct load of a group with its number in order of ``at``: ``_g``, ``_at``, ``_n``.

    A few rows, one per load and not per record; they are written once and broadcast where a count
    shows that they fit.
    """
    known = loads.select(F.col(group).alias("_g"), F.col(at).alias("_at")).filter("_g is not null and _at is not null").distinct()
    return small_side(cut(known.select("_g", "_at", F.row_number().over(Window.partitionBy("_g").orderBy("_at")).alias("_n"))))


def snapshot_changes(df: DataFrame, group: str, at: str, key: str, compared: list[str]) -> DataFrame:
    """Keys added, removed or changed from each load of a group to the next: ``_g``, ``_at``, ``_key``, ``change``.

    A load is one value of ``at`` (the later load's is returned). A key's content is the set of its
    distinct rows over ``compared`` (null equals null, repeated rows count once). Rows without group,
    load or key are left out, but a load of which all rows lack a key is still a load (without keys).
    The first load of a group gives no rows.

    Repeated rows collapse before any key is gathered, and the set's digest is a commutative aggregate
    (count and exclusive ors of two hashes), so a key with very many rows is combined map-side. Loads
    are matched by a full outer join on group, key and load number: a missing side is an addition or a
    removal, unequal digests are a change. Keys of the last load have no later load and give nothing.
    """
    h1, h2 = row_digest([F.col(c) for c in compared])
    rows = df.filter(F.col(group).isNotNull() & F.col(at).isNotNull() & F.col(key).isNotNull())
    content = (
        rows.select(F.col(group).alias("_g"), F.col(at).alias("_at"), F.col(key).alias("_key"), h1.alias("_h1"), h2.alias("_h2"))
        .distinct()
        .groupBy("_g", "_key", "_at")
        .agg(F.count(F.lit(1)).alias("_c"), F.bit_xor("_h1").alias("_x1"), F.bit_xor("_h2").alias("_x2"))
    )
    loads = number_loads(df.select(group, at), group, at)
    numbered = content.join(loads, ["_g", "_at"])
    digest = F.struct("_c", "_x1", "_x2")
    now = numbered.select("_g", "_key", "_n", digest.alias("_now"))
    before = numbered.select("_g", "_key", (F.col("_n") + 1).alias("_n"), digest.alias("_before"))
    both = now.join(before, ["_g", "_key", "_n"], "full").filter("_n > 1 and not (_now <=> _before)")
    change = F.when(F.col("_before").isNull(), "added").when(F.col("_now").isNull(), "removed").otherwise("changed")
    return both.select("_g", "_key", "_n", change.alias("change")).join(loads, ["_g", "_n"]).select("_g", "_at", "_key", "change")
