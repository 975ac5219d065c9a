"""Every query against its SQL on the smallest data, and the training-data queries on awkward tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry
from compare import canon
from registra.plans import CATALOGUE, ORACLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")


def connect(folder):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in Path(folder).iterdir():
        con.execute(f"create view {p.name.split('.')[0]} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def same(spark, con, folder, name):
    df = CATALOGUE[name](spark, folder)
    names = sorted(df.columns)
    got = sorted(tuple(canon(v) for v in r) for r in df.select(*names).collect())
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    want = sorted(tuple(canon(r[columns.index(n)]) for n in names) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", list(CATALOGUE))
def test_against_sql(spark, name):
    same(spark, connect(FOLDER), FOLDER, name)


def test_catalogues_agree():
    assert set(ORACLES) <= set(CATALOGUE) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Tables with a row of nulls, every row twice but for key columns, and extra columns with clashing names."""
    out = tmp_path_factory.mktemp("awkward")
    for name in ("records", "fact_licence"):
        df = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        nulls = spark.createDataFrame([tuple(None for _ in df.columns)], df.schema)
        both = df.unionByName(df).unionByName(nulls)
        extra = {"fact_licence": ("_entity", "_day", "_s", "kind", "_n", "valid_from"), "records": ()}[name]
        for c in extra:
            both = both.selectExpr("*", f"'x' as `{c}`")
        both.coalesce(2).write.parquet(f"{out}/{name}.parquet")
    return str(out)


@pytest.mark.parametrize("name", ["p1_found", "p4_found", "p5_found", "p7_found", "p7_profile"])
def test_awkward_tables(spark, awkward, name):
    same(spark, connect(awkward), awkward, name)


@pytest.mark.parametrize("name", ["p1_found", "p4_found", "p5_found", "p7_found", "p7_deltas", "business_history", "status_transition", "pk_dedupe_keep", "mart_neighbourhood"])
def test_empty_tables(spark, tmp_path, name):
    for t in ("records", "fact_licence", "curated_licence", "dim_neighbourhood"):
        spark.read.parquet(f"{FOLDER}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert CATALOGUE[name](spark, str(tmp_path)).count() == 0
