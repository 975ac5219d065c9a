"""Changes between loads against sets, and profiles kept by signed deltas."""

import random

from pyspark.sql import functions as F

from registra.operators.profile import ProfileRules, ValueCountStore, load_profiles, maintain, profile_loads, signed_deltas, value_counts
from registra.operators.snapshots import number_loads, snapshot_changes

SCHEMA = "g bigint, at int, k bigint, a string, b string, _key string, value string"


def brute(data):
    loads = {}
    for g, at, k, a, b, *_ in data:
        if None not in (g, at):
            keys = loads.setdefault(g, {}).setdefault(at, {})
            if k is not None:
                keys.setdefault(k, set()).add((a, b))
    out = []
    for g, byday in loads.items():
        order = sorted(byday)
        for x, y in zip(order, order[1:], strict=False):
            old, new = byday[x], byday[y]
            out += [(g, y, k, "added") for k in new.keys() - old.keys()] + [(g, y, k, "removed") for k in old.keys() - new.keys()]
            out += [(g, y, k, "changed") for k in new.keys() & old.keys() if new[k] != old[k]]
    return sorted(out, key=repr)


def test_random_against_sets(spark, rows):
    rnd = random.Random(9)
    data = [(rnd.choice([1, 2, None]), rnd.choice([None, 1, 2, 3]), rnd.choice([None, *range(8)]), rnd.choice([None, "", "x", "1:x"]), rnd.choice([None, "x", "-"]), "c", "v") for _ in range(250)]
    got = snapshot_changes(spark.createDataFrame(data, SCHEMA), "g", "at", "k", ["a", "b"])
    assert rows(got) == brute(data)
    assert rows(snapshot_changes(spark.createDataFrame([], SCHEMA), "g", "at", "k", ["a", "b"])) == []


def test_a_load_without_keys_is_a_load(spark, rows):
    data = [(1, 1, 5, "x", "", "", ""), (1, 2, None, "x", "", "", ""), (1, 3, 5, "x", "", "", "")]
    assert rows(snapshot_changes(spark.createDataFrame(data, SCHEMA), "g", "at", "k", ["a", "b"])) == [(1, 2, 5, "removed"), (1, 3, 5, "added")]


def test_null_and_neighbouring_values_differ(spark, rows):
    data = [(1, 1, 1, None, "x", "", ""), (1, 2, 1, "x", None, "", ""), (1, 1, 2, "", None, "", ""), (1, 2, 2, None, None, "", ""), (1, 1, 3, "a", "b", "", ""), (1, 2, 3, "a", "b", "", ""), (1, 2, 3, "a", "b", "", "")]
    assert rows(snapshot_changes(spark.createDataFrame(data, SCHEMA), "g", "at", "k", ["a", "b"])) == [(1, 2, 1, "changed"), (1, 2, 2, "changed")]


def test_deltas_rebuild_every_state(spark, rows, tmp_path):
    """The store's counts after each load are the load's own; groups without a load stay as they were."""
    rnd = random.Random(2)
    data = [(g, rnd.choice([1, 2, 3] if g == 1 else [1]), 0, rnd.choice(["x", "y", "N/A", None]), rnd.choice("pq"), "", "") for g in (1, 2) for _ in range(120)]
    df = spark.createDataFrame(data, SCHEMA)
    counts, loads = value_counts(df, "g", "at", ["a", "b"]), number_loads(df, "g", "at")
    numbered = counts.join(loads, ["_g", "_at"])
    store = ValueCountStore(spark, str(tmp_path))
    for n in (1, 2, 3):
        changes = store.add(n, numbered.filter(f"_n = {n}"))
        want = numbered.filter(f"_n = {n}").select("_g", "column_name", "value", "n")
        assert rows(store.state(n)) == rows(want)
        assert changes.filter("n <> before + delta or n < 0").isEmpty()
    assert rows(maintain(store.state(3), signed_deltas(store.state(3), numbered.filter("_n = 2")))) == rows(numbered.filter("_n = 2 and _g = 1").select("_g", "column_name", "value", "n"))
    assert rows(maintain(store.state(3), changes.limit(0))) == rows(store.state(3))


def test_a_load_is_added_without_the_earlier_ones(spark, rows, tmp_path):
    """Only the last version is read: with all else gone, one more load gives the same profile."""
    rnd = random.Random(5)
    loads = {n: spark.createDataFrame([(1, n, 0, rnd.choice("xyz"), rnd.choice(["1", "20", None]), "", "") for _ in range(50)], SCHEMA) for n in (1, 2, 3)}
    rules = ProfileRules(number_columns=("b",), share_columns=("a",))
    stores = [ValueCountStore(spark, str(tmp_path / name)) for name in ("all", "last")]
    for store in stores:
        for n in (1, 2):
            store.add(n, value_counts(loads[n], "g", "at", ["a", "b"]))
    stores[1].forget(1)
    got = [rows(load_profiles(s.add(3, value_counts(loads[3], "g", "at", ["a", "b"])).withColumn("_n", F.lit(3)), rules)) for s in stores]
    assert got[0] == got[1] and len(got[0]) == 2


def test_ranges_are_typed(spark):
    data = [(1, 1, 0, v, d, "", "") for v, d in (("9", "2024-02-01"), ("10", "2024-01-01T23:00:00-05:00"), ("n/a", None), ("x", "soon"))]
    rules = ProfileRules(number_columns=("a",), instant_columns=("b",))
    _, profiles, _ = profile_loads(spark.createDataFrame(data, SCHEMA), "g", "at", ["a", "b"], rules)
    got = {r.column_name: r for r in profiles.collect()}
    assert (got["a"].least_number, got["a"].greatest_number, got["a"].least) == (9.0, 10.0, None)
    assert (got["b"].first_instant, got["b"].last_instant) == (1704168000000000, 1706745600000000)


def test_breaks(spark, rows):
    ok = [(1, 1, 0, v, "5", "", "") for v in "xxxxxxxyyy"]
    worse = [(1, 2, 0, v, "50", "", "") for v in ["x", "x", "n/a", None, " ", "y", "y", "y", "y", "z"]]
    rules = ProfileRules(forms={"b": r"^5$"}, level_columns=("b",), share_columns=("a",))
    loads, profiles, breaks = profile_loads(spark.createDataFrame(ok + worse, SCHEMA), "g", "at", ["a", "b"], rules)
    assert rows(breaks.select("column_name", "finding")) == [("a", "missing"), ("a", "share"), ("b", "form"), ("b", "level")]
    first = profiles.filter("_n = 1 and column_name = 'a'").select("rows", "missing", "distinct", F.round("entropy", 4)).first()
    assert tuple(first) == (10, 0, 2, 0.8813)
    assert rows(profile_loads(spark.createDataFrame([], SCHEMA), "g", "at", ["a"], rules)[2]) == []
