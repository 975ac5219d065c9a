"""The texts' and names' queries on the smallest data, on empty tables and on awkward ones."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from compare import canon
from registra.llm.catalogue import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = ("curated_licence", "records", "documents", "page_labels", "eval_items")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Each table with a row of nulls, its rows twice, and extra columns with clashing names."""
    out = tmp_path_factory.mktemp("awkward")
    for name in TABLES:
        df = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        both = df.unionByName(df).unionByName(spark.createDataFrame([tuple(None for _ in df.columns)], df.schema))
        for c in () if name == "records" else ("_key", "_own", "_text", "_doc", "_item", "sig", "name_", "ids", "score"):
            both = both.selectExpr("*", f"'x' as `{c}`")
        both.coalesce(2).write.parquet(f"{out}/{name}.parquet")
    return str(out)


@pytest.mark.parametrize("name", list(QUERIES))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


@pytest.mark.parametrize("name", list(SQL))
@pytest.mark.parametrize("where", ["plain", "awkward"])
def test_against_sql(spark, awkward, name, where):
    folder = awkward if where == "awkward" else FOLDER
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        p = Path(folder) / f"{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    df = QUERIES[name](spark, folder)
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    want = sorted(tuple(canon(r[columns.index(c)]) for c in sorted(columns)) for r in cursor.fetchall())
    assert sorted(tuple(canon(v) for v in r) for r in df.select(*sorted(columns)).collect()) == want


@pytest.mark.parametrize("name", ["p2_found", "p3_found", "p6_found", "p6_merged", "p8_ids", "p9_found", "p10_found"])
def test_awkward_and_empty(spark, awkward, tmp_path, name):
    plain, odd = QUERIES[name](spark, FOLDER), QUERIES[name](spark, awkward)
    key = plain.columns[0]
    if name != "p6_found":  # its groups grow when every row comes twice
        assert {r[0] for r in plain.select(key).collect()} <= {r[0] for r in odd.select(key).collect()}
    for t in TABLES:
        spark.read.parquet(f"{FOLDER}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


def test_every_field_is_merged(spark):
    """Each column of the records but the key; revisions, never merged before, have values."""
    merged = QUERIES["p6_merged"](spark, FOLDER)
    assert set(merged.columns) == {"licence_rsn"} | set(spark.read.parquet(f"{FOLDER}/records.parquet").columns) - {"record_no", "licencersn"}
    assert merged.filter("size(licencerevisionnumber) > 0").count() > 0
