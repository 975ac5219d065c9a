"""Election against a sort, and values judged by sources of unlike quality."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from registra.functions import text as T
from registra.llm.survivors import judged_values, merged_records, representatives

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "k bigint, id bigint, a string, b string, at int, _key string"


def test_election_against_sort(spark, rows):
    rnd = random.Random(7)
    data = [(rnd.choice([None, 1, 2, 3, 4]), i, rnd.choice([None, "x", "N/A", " "]), rnd.choice(["y", "-", None]), rnd.choice([None, 1, 2]), "c") for i in range(80)]
    missing = lambda v: v is None or v.strip().lower() in T.NO_VALUE
    want = []
    for k in (1, 2, 3, 4):
        group = [r for r in data if r[0] == k]
        best = min(group, key=lambda r: (missing(r[2]) + missing(r[3]), -(r[4] or -1) if r[4] is not None else 1, r[1]))
        want.append((k, best[1], len(group)))
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(representatives(df, "k", "id", ["a", "b"], [F.col("at")])) == sorted(want, key=repr)
    assert rows(representatives(df.limit(0), "k", "id", ["a", "b"], [F.col("at")])) == []


def test_a_bad_source_is_outvoted_and_two_values_may_stay(spark):
    """Three sources; one is mostly wrong. Some keys truly have two values, each given by the good sources."""
    rnd = random.Random(5)
    data, truth = [], {}
    for k in range(150):
        true = {f"v{k}", f"w{k}"} if k % 5 == 0 else {f"v{k}"}
        truth[k] = true
        for s in ("s1", "s2"):
            for v in true:
                data.append((k, s, v, "clash"))
        data.append((k, "s3", f"bad{rnd.randrange(9)}" if k % 3 else f"v{k}", "clash"))
    data += [(None, "s1", "x", "c"), (1, None, "x", "c"), (1, "s1", "N/A", "c"), (1, "s1", None, "c")]
    values = judged_values(spark.createDataFrame(data, "k bigint, s string, a string, _p string"), "k", "s", ["a"])
    got = {r["_key"]: set(r["a"]) for r in merged_records(values, ["a"]).collect()}
    assert sum(got[k] == t for k, t in truth.items()) >= 0.95 * len(truth)
    assert judged_values(spark.createDataFrame([], "k bigint, s string, a string"), "k", "s", ["a"], rounds=2).count() == 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")
def test_inferred_quality_beats_the_majority_on_the_licence_records(spark):
    """Streets of the given records, delivered by three careful and four careless loads that repeat each other's stale values."""
    rnd = random.Random(21)
    records = spark.read.parquet(f"{FOLDER}/records.parquet")
    streets = [r[0] for r in records.filter(~T.is_missing(F.col("street"))).select("street").distinct().orderBy("street").collect()]
    licences = [r[0] for r in records.filter(~T.is_missing(F.col("licencersn"))).select("licencersn").distinct().orderBy("licencersn").collect()]
    truth, claims = {}, []
    for k, _ in enumerate(licences):
        true, stale = rnd.sample(streets, 2)
        truth[k] = true
        for s in range(7):
            right = rnd.random() < (0.95 if s < 3 else 0.35)
            wrong = stale if rnd.random() < 0.8 else rnd.choice(streets)
            claims.append((k, f"load{s}", true if right else wrong))
    df = spark.createDataFrame(claims, "k bigint, s string, street string")
    top = F.struct("_p", F.col("_sources").alias("n"), F.col("_value").alias("v"))
    judged = judged_values(df, "k", "s", ["street"]).groupBy("_key").agg(F.max(top)["v"].alias("v")).collect()
    counted = df.groupBy("k", "street").count().groupBy("k").agg(F.max_by("street", F.struct("count", "street"))).collect()
    right = sum(truth[r[0]] == r[1] for r in judged), sum(truth[r[0]] == r[1] for r in counted)
    assert len(truth) > 100 and right[0] >= 0.97 * len(truth) and right[0] > right[1] + 0.03 * len(truth)
