"""Column profiles of loads from persistent value counts that are kept up by signed deltas."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registra.functions import dates as D
from registra.functions import text as T
from registra.operators.snapshots import number_loads
from registra.session import cut, remove, shared_folder, small_side

COUNTS = "_g bigint, column_name string, value string, n bigint"


@dataclass(frozen=True)
class ProfileRules:
    """What counts as a break; shares and ratios are exceeded, not reached. Columns of numbers and of instants get typed ranges."""

    missing: float = 0.107
    form: float = 0.083
    level: float = 2.0
    spread: float = 2.0
    share: float = 0.107
    forms: dict[str, str] = field(default_factory=dict)
    level_columns: tuple[str, ...] = ()
    share_columns: tuple[str, ...] = ()
    number_columns: tuple[str, ...] = ()
    instant_columns: tuple[str, ...] = ()


def value_counts(df: DataFrame, group: str, at: str, columns: list[str]) -> DataFrame:
    """``_g``, ``_at``, ``column_name``, ``value``, ``n``: how often a load holds each value as delivered, null included.

    Rows without group or load are left out. Counting starts map-side on the values as they are, so a
    value that fills a third of all rows travels as one row per task, and nothing is worked out per cell.
    """
    cells = df.filter(F.col(group).isNotNull() & F.col(at).isNotNull()).select(
        F.col(group).cast("bigint").alias("_g"), F.col(at).alias("_at"), F.posexplode(F.array(*[F.col(c) for c in columns])).alias("_c", "value")
    )
    counted = cells.groupBy("_g", "_at", "_c", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("_g", "_at", F.get(F.array(*map(F.lit, columns)), F.col("_c")).alias("column_name"), "value", "n")


def signed_deltas(state: DataFrame, counts: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """What a full load adds to and takes from the stored counts of its groups: ``_g``, ``column_name``, ``value``, ``before``, ``delta``.

    Both sides have ``_g``, ``column_name``, ``value``, ``n``. Values whose count stays come with delta 0.
    Groups that the load does not bring are left out and so stay as stored; ``groups`` (``_g``) are those
    it brings, found in ``counts`` if not given.
    """
    zero = F.lit(0).cast("bigint")
    groups = small_side(counts.select("_g").distinct() if groups is None else groups)
    old = state.join(groups, "_g", "left_semi").select("_g", "column_name", "value", F.col("n").alias("_b"), zero.alias("_a"))
    new = counts.select("_g", "column_name", "value", zero.alias("_b"), F.col("n").alias("_a"))
    return old.unionByName(new).groupBy("_g", "column_name", "value").agg(F.sum("_b").alias("before"), (F.sum("_a") - F.sum("_b")).alias("delta"))


def maintain(state: DataFrame, delta: DataFrame) -> DataFrame:
    """Apply signed deltas to a table of value counts (``_g``, ``column_name``, ``value``, ``n``); zero counts leave it."""
    both = state.select("_g", "column_name", "value", "n").unionByName(delta.select("_g", "column_name", "value", F.col("delta").alias("n")))
    return both.groupBy("_g", "column_name", "value").agg(F.sum("n").alias("n")).filter("n <> 0")


class ValueCountStore:
    """Value counts per column kept in a shared folder, one version per load number.

    ``add`` takes the value counts of one load, reads the last version only, and writes the next one: the
    count before, the signed delta and the maintained count of every value. A version is written whole
    before anything reads it, so a failed call leaves the last version intact and can be repeated.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, version: int) -> str:
        return f"{self.folder}/version={version}"

    def changes(self, version: int) -> DataFrame:
        """``_g``, ``column_name``, ``value``, ``before``, ``delta``, ``n`` of the groups that version brought."""
        return self.spark.read.parquet(self._path(version))

    def state(self, version: int) -> DataFrame:
        """The maintained counts of that version; none before the first."""
        if version < 1:
            return self.spark.createDataFrame([], COUNTS)
        return self.changes(version).filter("n > 0").select("_g", "column_name", "value", "n")

    def add(self, version: int, counts: DataFrame, groups: DataFrame | None = None) -> DataFrame:
        """Apply a load's signed deltas to the version before and return the changes."""
        deltas = signed_deltas(self.state(version - 1), counts, groups)
        deltas.withColumn("n", F.col("before") + F.col("delta")).write.mode("overwrite").parquet(self._path(version))
        return self.changes(version)

    def forget(self, version: int) -> None:
        """Drop a version that later ones have replaced."""
        remove(self.spark, self._path(version))


def replay(df: DataFrame, group: str, at: str, columns: list[str], summary: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Bring every load of ``df`` into a store, in order, and take ``summary`` of the changes of each (with ``_n``).

    Returns the loads and the summaries of all of them. ``df`` is read once, for its value counts, which
    are written sorted by load, so that each step reads one load's counts and one stored version. Step n
    takes load n of every group; a version is dropped when the next one stands. ``summary`` must give a few
    rows per group and column: they are kept and all that remains.
    """
    spark = df.sparkSession
    home = f"{shared_folder(spark)}/value-counts-{uuid.uuid4().hex}"
    value_counts(df, group, at, columns).sortWithinPartitions("_at", "_g").write.parquet(f"{home}/delivered")
    delivered = spark.read.parquet(f"{home}/delivered")
    loads = number_loads(delivered, "_g", "_at")
    most = loads.agg(F.max("_n")).first()[0] or 0
    store = ValueCountStore(spark, f"{home}/kept")
    kept = []
    for n in range(1, most + 1):
        own = cut(loads.filter(F.col("_n") == n).select("_g", "_at"))  # one row per group
        first, last = own.agg(F.min("_at"), F.max("_at")).first()
        near = delivered.filter(F.col("_at").between(first, last))  # reaches the scan, which skips the pages of other loads
        changes = store.add(n, near.join(small_side(own), ["_g", "_at"]).drop("_at"), own.select("_g"))
        kept.append(cut(summary(changes.withColumn("_n", F.lit(n)))))
        store.forget(n - 1)
    out = reduce(DataFrame.unionByName, kept) if kept else cut(summary(store.state(0).selectExpr("*", "n as before", "n as delta", "1 as _n")))
    remove(spark, home)
    return loads, out


def _lacks_form(forms: dict[str, str]) -> Column:
    """Whether the value lacks its column's form; null for columns without one."""
    out = F.lit(None).cast("boolean")
    for name, pattern in forms.items():
        out = F.when(F.col("column_name") == name, ~F.col("value").rlike(pattern)).otherwise(out)
    return out


def _within(columns: tuple[str, ...]) -> Column:
    return F.col("column_name").isin(*columns) if columns else F.lit(False)


def _totals(count: Column, rules: ProfileRules) -> dict[str, Column]:
    """Aggregates over the value counts of one column at one time."""
    known = ~F.col("_missing") & (count > 0)
    level = F.when(_within(rules.level_columns), F.col("_number"))
    return {
        "rows": F.sum(count),
        "missing": F.sum(F.when(F.col("_missing"), count).otherwise(F.lit(0))),
        "distinct": F.count_if(known),
        "numbers": F.sum(F.when(level.isNotNull(), count).otherwise(F.lit(0))),
        "total": F.sum(level * count),
    }


def load_profiles(changes: DataFrame, rules: ProfileRules) -> DataFrame:
    """Exact metrics of each column in a load, with those of the load before it (``b_`` columns): a row per ``_g``, ``_n``, ``column_name``.

    Per column: rows, missing, distinct values, number sums, least and greatest value (by number or instant
    where the column holds them, else by text), values lacking the form, entropy (bits) and the largest
    change of a value's share. Every figure comes from the maintained counts (``n``, and ``before``).
    """
    typed = changes.withColumns(
        {
            "_missing": T.is_missing(F.col("value")),
            "_number": F.when(~T.is_missing(F.col("value")) & _within((*rules.number_columns, *rules.level_columns)), T.number(F.col("value"))),
            "_instant": F.when(_within(rules.instant_columns), F.unix_micros(D.iso_instant(F.col("value")))),
        }
    )
    n, known = F.col("n"), ~F.col("_missing") & (F.col("n") > 0)
    text = F.when(known & ~_within((*rules.number_columns, *rules.instant_columns)), F.col("value"))
    now, old = _totals(n, rules), _totals(F.col("before"), rules)
    sums = typed.groupBy("_g", "_n", "column_name").agg(
        *[v.alias(k) for k, v in now.items()],
        *[v.alias(f"b_{k}") for k, v in old.items()],
        F.sum(F.when(known, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))).alias("logs"),
        F.min(text).alias("least"),
        F.max(text).alias("most"),
        *[f(F.when((n > 0) & _within(rules.number_columns), F.col("_number"))).alias(a) for f, a in ((F.min, "least_number"), (F.max, "greatest_number"))],
        *[f(F.when(known, F.col("_instant"))).alias(a) for f, a in ((F.min, "first_instant"), (F.max, "last_instant"))],
        F.sum(F.when(known & _lacks_form(rules.forms), n).otherwise(F.lit(0))).alias("lacking"),
    )
    values = F.col("rows") - F.col("missing")
    sums = sums.withColumn("entropy", F.when(values > 0, F.log2(values.cast("double")) - F.col("logs") / values))
    if not rules.share_columns:
        return sums.withColumn("share_change", F.lit(None).cast("double"))
    kept = typed.filter(_within(rules.share_columns) & ~F.col("_missing"))
    bases = sums.filter(_within(rules.share_columns)).select("_g", "_n", "column_name", values.alias("_v"), (F.col("b_rows") - F.col("b_missing")).alias("_bv"))
    shift = F.abs(F.coalesce(F.try_divide(n, F.col("_v")), F.lit(0.0)) - F.coalesce(F.try_divide(F.col("before"), F.col("_bv")), F.lit(0.0)))
    shifts = kept.join(bases, ["_g", "_n", "column_name"]).filter("_v > 0 and _bv > 0").groupBy("_g", "_n", "column_name").agg(F.max(shift).alias("share_change"))
    return sums.join(shifts, ["_g", "_n", "column_name"], "left")


def profile_breaks(profiles: DataFrame, rules: ProfileRules) -> DataFrame:
    """Findings of each load but a group's first: ``_g``, ``_n``, ``column_name``, ``finding``."""
    values, b_values = F.col("rows") - F.col("missing"), F.col("b_rows") - F.col("b_missing")
    mean, b_mean = F.try_divide(F.col("total"), F.col("numbers")), F.try_divide(F.col("b_total"), F.col("b_numbers"))

    def apart(a: Column, b: Column, ratio: float) -> Column:
        return F.coalesce(F.greatest(a, b) > F.lit(ratio) * F.least(a, b), F.lit(False)) & a.isNotNull() & b.isNotNull()

    checks = {
        "missing": F.abs(F.col("missing") / F.col("rows") - F.col("b_missing") / F.col("b_rows")) > rules.missing,
        "form": F.try_divide(F.col("lacking"), values) > rules.form,
        "level": apart(mean, b_mean, rules.level),
        "spread": apart(F.col("distinct"), F.col("b_distinct"), rules.spread),
        "share": F.col("share_change") > rules.share,
    }
    found = F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in checks.items()]))
    later = profiles.filter("_n > 1 and rows > 0 and b_rows > 0")
    return later.select("_g", "_n", "column_name", F.explode(found).alias("finding"))


def profile_loads(df: DataFrame, group: str, at: str, columns: list[str], rules: ProfileRules) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Loads, profiles and breaks of every load of ``df``, by bringing its loads into a store one after the other.

    Empty tables give empty results; repeated rows count as often as they occur.
    """
    loads, profiles = replay(df, group, at, columns, lambda changes: load_profiles(changes, rules))
    return loads, profiles, profile_breaks(profiles, rules)


def delta_counts(changes: DataFrame) -> DataFrame:
    """Values gained, values lost and the sum of the signed deltas of each column in a load."""
    known = ~T.is_missing(F.col("value"))
    return changes.groupBy("_g", "_n", "column_name").agg(
        F.count_if(known & (F.col("before") == 0) & (F.col("n") > 0)).alias("values_gained"), F.count_if(known & (F.col("n") == 0)).alias("values_lost"), F.sum("delta").alias("net_rows")
    )
