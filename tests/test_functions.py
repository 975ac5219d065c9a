"""Scalar expressions on literal rows."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from registra.functions import dates as D
from registra.functions import geo as G
from registra.functions import text as T
from registra.functions.keys import blake_key, natural_key, surrogate


def one(spark, expression, **values):
    df = spark.range(1).select(*[F.lit(v).cast("string").alias(k) if v is None else F.lit(v).alias(k) for k, v in values.items()])
    return df.select(expression.alias("x")).first()["x"]


CASES = [
    (T.squeeze, " a   b ", "a b"), (T.squeeze, "   ", None), (T.squeeze, "a 　b", "a b"), (T.squeeze, None, None),
    (T.title, "renfrew-collingwood", "Renfrew-Collingwood"), (T.title, "o'brien's 1st st", "O'Brien'S 1St St"), (T.title, "", ""),
    (T.plain_key, "Café & Co.", "CAF CO"), (T.spaced_key, "Café & Co.", "CAFE CO"), (T.ascii_fold, "Café Ø ß", "Cafe  "), (T.ascii_fold, "ﬁｘ", "fix"), (T.ascii_fold, "Acme™", "AcmeTM"), (T.ascii_fold, "№ 5", "No 5"), (T.ascii_fold, "Ĳssel", "IJssel"), (T.ascii_fold, "5㎏", "5kg"), (T.ascii_fold, "a金b", "ab"), (T.spaced_key, "Acme™ № 5", "ACMETM NO 5"),
    (T.postal, "v5k0a1", "V5K 0A1"), (T.postal, "98101", "98101"), (T.postal, "--", None), (T.postal_valid, "V5K 0A1", True), (T.postal_valid, "98101", False), (T.postal_valid, None, None),
    (T.number, "1e3", 1000.0), (T.number, " 12 ", 12.0), (T.number, "0x1F", None), (T.number, "True", None), (T.number, "1_000", None), (T.number, "", None), (T.number, "2f", None), (T.number, "1e999", None),
    (T.rounded_number, "0.5", 0), (T.rounded_number, "1.5", 2), (T.rounded_number, "2.5", 2), (T.whole_number, "003120580.0", 3120580), (T.whole_number, "1.5", None), (T.whole_number, "L309", None),
    (T.is_missing, "N/A", True), (T.is_missing, "\t", True), (T.is_missing, None, True), (T.is_missing, "000", False), (T.is_missing, "nan ", True),
    (D.century, 24, 2024), (D.century, 79, 2079), (D.century, 80, 1980), (D.century, 2024, 2024),
]


@pytest.mark.parametrize(("f", "value", "want"), CASES)
def test_literal(spark, f, value, want):
    assert one(spark, f(F.col("v")), v=value) == want


def test_instants(spark):
    sec = lambda v: one(spark, F.unix_seconds(D.iso_instant(F.col("v"))), v=v)
    want = int(datetime(2024, 9, 9, 7, 4, 9).timestamp() - datetime(1970, 1, 1).timestamp())
    assert {sec(v) for v in ("2024-09-09T07:04:09Z", "2024-09-09T07:04:09+00:00", "2024-09-09T00:04:09-07:00", "2024-09-09T07:04:09.000+0000")} == {want}
    assert sec("2024-13-01T00:00:00Z") is None and sec("20/01/2026") is None and sec("2024-01-02") == 1704153600


def test_floor_days_and_days(spark):
    a, b = F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit("2024-01-01 10:00:00").cast("timestamp")
    assert one(spark, D.floor_days(a, b)) == -1
    assert one(spark, D.ymd(D.utc_day(a))) == 20240101 and one(spark, D.iso_day(F.lit(0))) == "1970-01-01"
    assert one(spark, D.utc_day(F.lit(date(1969, 12, 31)), __import__("pyspark").sql.types.DateType())) == -1


def test_geo(spark):
    spot = lambda p, g: (lambda r: r and (r["lat"], r["lon"]))(one(spark, G.coordinates(F.col("p"), F.col("g")), p=p, g=g))
    feature = '{"type": "Feature", "geometry": {"type": "Point", "coordinates": [-123.1, 49.2]}}'
    assert spot('{"lon": -123.0, "lat": 49.0}', feature) == (49.0, -123.0)
    assert spot("49.2, -123.1", None) == (49.2, -123.1)
    assert spot(None, feature) == (49.2, -123.1) and spot(None, '{"coordinates": [-1, 2]}') == (2.0, -1.0)
    assert spot(None, '{"coordinates": [-1]}') is None and spot(None, None) is None
    assert spot('{"lon": "x", "lat": 49.0}', feature) == (49.2, -123.1)
    km = one(spark, G.haversine_km(F.lit(49.0), F.lit(-123.0), F.lit(50.0), F.lit(-123.0)))
    assert math.isclose(km, 6371 * math.pi / 180, rel_tol=1e-9)


def test_keys(spark):
    assert one(spark, blake_key(natural_key([F.lit("Issued")]))) == 3283906556648077893
    assert one(spark, surrogate([F.lit("a"), F.lit(None).cast("string")])) == one(spark, surrogate([F.lit("a "), F.lit("")]))
    assert one(spark, surrogate([F.lit("a"), F.lit("")])) != one(spark, surrogate([F.lit(""), F.lit("a")]))


def test_rounding_halves_to_even(spark):
    got = spark.sql("select explode(array(0.125D, 0.375D, 2.5D, -0.125D)) as v").select(T.rounded(F.col("v"), 2), T.rounded(F.col("v"), 0)).collect()
    assert [tuple(r) for r in got] == [(0.12, 0.0), (0.38, 0.0), (2.5, 2.0), (-0.12, 0.0)]
