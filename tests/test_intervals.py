"""Periods and gaps against day sets."""

import random

from registra.operators.intervals import periods_and_gaps

SCHEMA = "e bigint, s int, t int, _s string, kind string"


def brute(data):
    days = {}
    for e, s, t, *_ in data:
        if None not in (e, s, t) and t >= s:
            days.setdefault(e, set()).update(range(s, t + 1))
    out = []
    for e, covered in days.items():
        order, runs = sorted(covered), []
        for d in order:
            if runs and runs[-1][1] == d - 1:
                runs[-1][1] = d
            else:
                runs.append([d, d])
        out += [(e, "period", a, b) for a, b in runs] + [(e, "gap", x[1] + 1, y[0] - 1) for x, y in zip(runs, runs[1:], strict=False)]
    return sorted(out, key=repr)


def test_random_against_day_sets(spark, rows):
    rnd = random.Random(3)
    for _ in range(3):
        data = [(rnd.choice([1, 2, 3, 4, None]), rnd.choice([None, *range(60)]), rnd.choice([None, *range(60)]), "x", "y") for _ in range(60)]
        assert rows(periods_and_gaps(spark.createDataFrame(data, SCHEMA), "e", "s", "t")) == brute(data)


def test_next_day_touches_and_nested_vanish(spark, rows):
    data = [(1, 1, 5, "", ""), (1, 6, 9, "", ""), (1, 2, 3, "", ""), (1, 11, 11, "", ""), (1, 11, 11, "", "")]
    assert rows(periods_and_gaps(spark.createDataFrame(data, SCHEMA), "e", "s", "t")) == [(1, "gap", 10, 10), (1, "period", 1, 9), (1, "period", 11, 11)]


def test_empty(spark, rows):
    assert rows(periods_and_gaps(spark.createDataFrame([], SCHEMA), "e", "s", "t")) == []
