"""The best representative of each duplicate group, and which of the group's values are true.

Which row stands for a group is a fixed order (fullness first). What the merged record says is inferred by
a latent two-sided quality model: each source has, for each field, a sensitivity (how often it gives a true
value) and a specificity (how often it withholds a false one), found by expectation maximisation. Several
values of one field may be judged true.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.functions import text as T
from registra.session import cut, release, small_side


def filled(columns: list[str]) -> Column:
    """How many of ``columns`` make a claim, i.e. hold more than a word or sign for "no value"."""
    return reduce(add, [F.when(T.is_missing(F.col(c)), 0).otherwise(1) for c in columns])


def representatives(df: DataFrame, key: str, row_id: str, columns: list[str], order: list[Column]) -> DataFrame:
    """``key``, ``row_id`` and ``n`` of the row that stands for each key: most claims, then greatest ``order``, then least ``row_id``.

    Nulls in ``order`` are lowest, a null ``row_id`` is last. Rows with a null key are left out; a key
    with one row stands for itself (``n`` is 1). An aggregate that combines map-side, so a key with a
    third of all rows needs no gathering.
    """
    rank = F.struct(filled(columns).alias("f"), *[c.alias(f"o{i}") for i, c in enumerate(order)], (-F.coalesce(F.col(row_id), F.lit(9223372036854775807))).alias("r"))
    picked = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(F.col(row_id).alias("id")), rank).alias("_best"), F.count(F.lit(1)).alias("_n"))
    return picked.select(F.col("_key").alias(key), F.col("_best.id").alias(row_id), F.col("_n").alias("n"))


def claims(df: DataFrame, key: str, source: str, columns: list[str]) -> DataFrame:
    """Each distinct claim once: ``_key``, ``_field``, ``_value``, ``_source``; missing values claim nothing."""
    cells = F.array_compact(F.array(*[F.when(~T.is_missing(F.col(c)), F.struct(F.lit(c).alias("_field"), F.col(c).cast("string").alias("_value"))) for c in columns]))
    rows = df.filter(F.col(key).isNotNull() & F.col(source).isNotNull())
    return rows.select(F.col(key).alias("_key"), F.col(source).alias("_source"), F.inline(cells)).distinct()


def judged_values(df: DataFrame, key: str, source: str, columns: list[str], rounds: int = 12, settled: float = 0.002) -> DataFrame:
    """``_key``, ``_field``, ``_value``, ``_sources`` (how many claim it) and ``_p``, the probability that it is true.

    A source that fills the field of a key with other values speaks against a value; one that leaves it
    missing is silent. Facts with the same field and the same sources for and against are one pattern, so
    the rounds run on patterns with counts, not on the facts. They end when no source's quality moves by
    more than ``settled``, after ``rounds`` at the latest; the quality table (one row per field and source)
    is written out after each, and what the round before wrote is removed. Empty tables give an empty result.
    """
    said = claims(df, key, source, columns)
    spoke = said.groupBy("_key", "_field").agg(F.array_sort(F.collect_set("_source")).alias("_all"))
    facts = said.groupBy("_key", "_field", "_value").agg(F.array_sort(F.collect_set("_source")).alias("_for")).join(spoke, ["_key", "_field"])
    facts = cut(facts.withColumn("_pattern", F.md5(F.concat_ws("|", F.col("_field"), F.array_join("_for", ","), F.array_join("_all", ",")).cast("binary"))))
    patterns = facts.groupBy("_pattern").agg(F.first("_field").alias("_field"), F.first("_for").alias("_for"), F.first("_all").alias("_all"), F.count(F.lit(1)).alias("_n"))
    votes = cut(patterns.select("_pattern", "_field", "_n", "_for", F.explode("_all").alias("_source")).select("_pattern", "_field", "_n", "_source", F.array_contains("_for", F.col("_source")).alias("_yes")))
    start = votes.groupBy("_pattern", "_field", "_n").agg(F.avg(F.col("_yes").cast("double")).alias("_p"))
    belief = cut(start)
    quality = None
    for _ in range(rounds):
        before, weighed = quality, votes.join(belief.select("_pattern", "_p"), "_pattern")
        hit = F.sum(F.when(F.col("_yes"), F.col("_n") * F.col("_p")).otherwise(0.0))
        false_hit = F.sum(F.when(F.col("_yes"), F.col("_n") * (1 - F.col("_p"))).otherwise(0.0))
        quality = cut(
            weighed.groupBy("_field", "_source").agg(
                ((hit + 9) / (F.sum(F.col("_n") * F.col("_p")) + 10)).alias("_sensitivity"),
                ((false_hit + 1) / (F.sum(F.col("_n") * (1 - F.col("_p"))) + 10)).alias("_false_rate"),
            )
        )
        tr, fa = F.col("_sensitivity"), F.col("_false_rate")
        odds = F.sum(F.when(F.col("_yes"), F.log(tr / fa)).otherwise(F.log((1 - tr) / (1 - fa))))
        last, belief = belief, cut(votes.join(small_side(quality), ["_field", "_source"]).groupBy("_pattern", "_field", "_n").agg((1 / (1 + F.exp(-odds))).alias("_p")))
        release(last)
        if before is not None:
            old = before.select("_field", "_source", tr.alias("_tr"), fa.alias("_fa"))
            moved = quality.join(old, ["_field", "_source"]).agg(F.max(F.greatest(F.abs(tr - F.col("_tr")), F.abs(fa - F.col("_fa"))))).first()[0]
            release(before)
            if (moved or 0.0) <= settled:
                break
    return facts.join(small_side(belief.select("_pattern", "_p")), "_pattern").select("_key", "_field", "_value", F.size("_for").cast("bigint").alias("_sources"), "_p")


def merged_records(values: DataFrame, columns: list[str], true_from: float = 0.5) -> DataFrame:
    """One row per key with, for each column, every value judged true, most probable first (an array, maybe empty).

    Ties go to the value of more sources, then to the lesser text.
    """
    ranked = F.struct((-F.round("_p", 6)).alias("p"), (-F.col("_sources")).alias("s"), F.col("_value").alias("v"))
    lists = [F.transform(F.array_sort(F.collect_set(F.when((F.col("_field") == c) & (F.col("_p") >= true_from), ranked))), lambda x: x["v"]).alias(c) for c in columns]
    return values.groupBy("_key").agg(*lists)
