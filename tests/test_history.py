"""Versions against a plain loop, and the defined edge cases."""

import random

from registra.operators.history import attribute_versions, latest_per_day, snapshot_events

SCHEMA = "e bigint, day int, at int, id bigint, a string, b bigint, _entity string"


def brute(data, tracked=("a", "b")):
    best = {}
    for r in data:
        if r[0] is not None and r[1] is not None:
            key, rank = (r[0], r[1]), (-1 if r[2] is None else r[2], -1 if r[3] is None else r[3])
            if key not in best or rank > best[key][0]:
                best[key] = (rank, (r[4], None if r[5] == -1 else r[5]))
    out = []
    for e in {k[0] for k in best}:
        known, starts = [None] * len(tracked), []
        for day in sorted(k[1] for k in best if k[0] == e):
            new, changed = best[e, day][1], not starts
            for i, v in enumerate(new):
                if v is not None:
                    changed |= known[i] is not None and v != known[i]
                    known[i] = v
            if changed:
                starts.append((day, tuple(known)))
        for i, (day, state) in enumerate(starts):
            out.append((e, day, starts[i + 1][0] if i + 1 < len(starts) else None, *state))
    return sorted(out, key=repr)


def versions(spark, data):
    df = spark.createDataFrame(data, SCHEMA).filter("e is not null and day is not null")
    return attribute_versions(latest_per_day(df, "e", "day", ["at", "id"], ["a", "b"], {"b": -1}), ["a", "b"])


def test_random_against_loop(spark, rows):
    rnd = random.Random(5)
    data = [(rnd.choice([1, 2, 3, None]), rnd.choice([None, *range(12)]), rnd.choice([None, 1, 2]), i, rnd.choice([None, "x", "y"]), rnd.choice([None, -1, 7, 8]), "clash") for i in range(300)]
    assert rows(versions(spark, data)) == brute(data)
    assert rows(versions(spark, data + data)) == brute(data)  # repeated rows change nothing


def test_unknown_value_starts_no_version(spark, rows):
    data = [(1, 1, 1, 1, None, 5, ""), (1, 2, 1, 2, "x", 5, ""), (1, 3, 1, 3, None, -1, ""), (1, 4, 1, 4, "z", 5, "")]
    assert rows(versions(spark, data)) == [(1, 1, 4, None, 5), (1, 4, None, "z", 5)]


def test_events_name_what_changed(spark):
    data = [(1, 1, 1, 1, "x", 5, ""), (1, 2, 1, 2, "y", 6, "")]
    df = latest_per_day(spark.createDataFrame(data, SCHEMA), "e", "day", ["at", "id"], ["a", "b"])
    events = {(r["_day"], r["_kind"]): list(r["_changed"]) for r in snapshot_events(df, ["a", "b"]).collect()}
    assert events[2, "changed"] == ["a", "b"] and {k for _, k in events} == {"inserted", "changed", "deleted"}


def test_empty(spark, rows):
    assert rows(versions(spark, [])) == []
