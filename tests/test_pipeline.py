"""Raw files through the portal, the curated layer, the model and the stream."""

import http.server
import json
import threading
from urllib import parse

import pytest
from pyspark.sql import functions as F

from registra import cli
from registra.operators import facts
from registra.operators.casting import cast_losses, curated_columns
from registra.operators.curate import curate, write_daily
from registra.operators.incremental import check_load, histogram, null_drift, null_rates, reconcile, refresh_plan, volume_drift
from registra.operators.quality import coordinate_counts, day_window, duplicate_keys, flag_counts
from registra.operators.sequence import previous_rows, spans
from registra.schema import RAW, Rules, resolve
from registra.sources import files
from registra.sources.portal import Portal, PortalError, decode_year, encode_year, fetch, register
from registra.streaming.ingest import curate_stream, daily_counts, read_streamed

NOW = "2026-06-01 00:00:00"


def record(rsn, year="25", **more):
    base = dict.fromkeys(RAW.names)
    return base | {
        "licencersn": rsn, "licencenumber": f"{year}-{int(rsn or 0):06d}", "licencerevisionnumber": "00", "folderyear": year, "businessname": "Acme  Ltd.", "status": "Issued", "issueddate": f"20{year}-02-03T10:00:00+00:00",
        "expireddate": f"20{year}-12-31", "extractdate": "2026-05-01T07:00:00+00:00", "businesstype": "Shop", "house": "1", "street": "main st", "city": "kestrel bay", "province": "bc", "postalcode": "v5k0a1", "localarea": "old ferry",
        "geo_point_2d": {"lon": -123.1, "lat": 49.2},
    } | more


@pytest.fixture
def portal():
    """A local server that answers as a portal does."""
    data = {"24": [record("1", "24")], "25": [record("1", "25"), record("2", "25", status="Cancelled")]}
    failures = {"n": 0}

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            url = parse.urlsplit(self.path)
            q = {k: v[0] for k, v in parse.parse_qs(url.query).items()}
            label = q.get("where", '""').split('"')[1]
            if failures["n"] > 0:
                failures["n"] -= 1
                self.send_response(503)
                self.end_headers()
                return
            if url.path.endswith("/missing"):
                self.send_response(404)
                self.end_headers()
                return
            if "group_by" in q:
                body = {"results": [{"folderyear": k, "n": len(v)} for k, v in data.items()] + [{"folderyear": None, "n": 1}]}
            elif url.path.endswith("/records"):
                body = {"results": [{"n": len(data[label]), "w": max(r["extractdate"] for r in data[label])}]}
            elif "/exports/" in url.path:
                body = data[label]
            else:
                body = {"metas": {"default": {"records_count": 3}}}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", data, failures
    server.shutdown()


def raw_frame(spark, records):
    text = [tuple(v if v is None or isinstance(v, str) else json.dumps(v) for v in (r[n] for n in RAW.names)) for r in records]
    return files.with_row_numbers(spark.createDataFrame(text, RAW).coalesce(1))


def test_years():
    assert [decode_year(x) for x in ("24", "79", "80", "2024")] == [2024, 2079, 1980, 2024] and encode_year(2024) == "24"


def test_portal(spark, portal):
    base, _, failures = portal
    p = Portal(base, "licences")
    assert p.discover() == [("24", 1), ("25", 2)] and p.discover(2025) == [("25", 2)]
    assert p.probe("25") == (2, "2026-05-01T07:00:00+00:00") and p.metadata()["records_count"] == 3
    failures["n"] = 2
    assert json.loads(fetch(p.export_url("24"), pause=lambda s: None))[0]["licencersn"] == "1"
    failures["n"] = 9
    with pytest.raises(PortalError, match="gave up"):
        fetch(p.export_url("24"), pause=lambda s: None)
    failures["n"] = 0
    with pytest.raises(PortalError, match="404"):
        fetch(f"{base}/missing", pause=lambda s: pytest.fail("a refusal must not be tried again"))
    register(spark)
    df = spark.read.format("explore_portal").option("base", base).option("dataset", "licences").load()
    assert df.schema == RAW and df.count() == 3
    assert json.loads(df.filter("folderyear = '24'").first()["geo_point_2d"])["lat"] == 49.2


def test_discover_reads_every_page():
    groups = [{"folderyear": f"{n}", "n": 1} for n in range(1000, 1250)]

    def get(url):
        q = dict(parse.parse_qsl(parse.urlsplit(url).query))
        at = int(q.get("offset", 0))
        return json.dumps({"results": groups[at : at + int(q["limit"])]}).encode()

    for n in (250, 200, 0):
        del groups[n:]
        assert Portal("http://x", "licences", get=get).discover() == [(g["folderyear"], 1) for g in groups]


def test_command_line(spark, portal, tmp_path):
    base, data, _ = portal
    raw, curated, model = (str(tmp_path / x) for x in ("raw", "curated", "model"))
    fetch_args = ["fetch", "--base", base, "--dataset", "licences", "--raw-root", raw]
    assert cli.main([*fetch_args, "--partition", "1999"]) == 2
    assert cli.main([*fetch_args, "--dry-run"]) == 0 and files.held_years(raw) == []
    assert cli.main([*fetch_args, "--side-copy", "csv"]) == 0 and files.held_years(raw) == [2024, 2025]
    assert (tmp_path / "raw/2025/records.json").read_bytes() == Portal(base, "licences").received("25")  # as sent
    before = (tmp_path / "raw/2025/records.json").stat().st_mtime_ns
    assert cli.main(fetch_args) == 0 and (tmp_path / "raw/2025/records.json").stat().st_mtime_ns == before  # nothing changed
    data["25"].pop()
    assert cli.main(fetch_args) == 1  # it shrank by half and is not taken
    assert cli.main(["curate", "--raw-root", raw, "--curated-root", curated, "--year", "1990"]) == 2
    assert cli.main(["curate", "--raw-root", raw, "--curated-root", curated]) == 0
    assert files.read_curated(spark, f"{curated}/curated").count() == 2
    assert spark.read.parquet(f"{curated}/quarantine").count() == 1
    assert cli.main(["model", "--curated-root", curated, "--model-root", model]) == 0
    assert spark.read.parquet(f"{model}/fact_licence").count() == 2 and spark.read.parquet(f"{model}/mart_neighbourhood_activity").count() == 1
    assert cli.main(["model", "--curated-root", str(tmp_path / "none"), "--model-root", model]) == 1


def test_saved_whole_and_read_as_text(spark, tmp_path):
    files.save_records([record("1")], str(tmp_path), 2025)
    row = files.read_raw(spark, str(tmp_path)).first()
    assert row["licencersn"] == "1" and json.loads(row["geo_point_2d"]) == {"lon": -123.1, "lat": 49.2}
    assert [p.name for p in (tmp_path / "2025").iterdir() if not p.name.startswith(".")] == ["records.json"]  # beside a checksum
    with pytest.raises(FileNotFoundError):
        files.read_raw(spark, str(tmp_path), [2031])
    (tmp_path / "2026").mkdir()
    (tmp_path / "2026/records.json").write_text('[{"licencersn": "1"')
    assert files.held_state(spark, str(tmp_path), 2026) is None and files.held_state(spark, str(tmp_path), 2025)["rows"] == 1
    with pytest.raises(ValueError, match="unknown format"):
        files.side_copy(spark.range(1).toDF("a"), str(tmp_path / "x"), "xls")


def test_one_row_per_key_and_nothing_lost(spark):
    rows = [record(None), record("0"), record("7", house=None), record("7"), record("7", extractdate="2026-05-02T07:00:00Z"), record("8"), record("8", licencerevisionnumber="01"), record("9"), record("9")]
    rows[1]["licencersn"] = "ERR"
    kept, rejected = curate(raw_frame(spark, rows), Rules(), NOW)
    got = {r.licence_rsn: r for r in kept.collect()}
    assert set(got) == {7, 8, 9} and got[7].extract_date.day == 2 and got[8].licence_revision_number == 1
    assert kept.count() + rejected.count() == len(rows)
    assert {r.dq_reject_reason: r.n for r in rejected.groupBy("dq_reject_reason").agg(F.count("*").alias("n")).collect()} == {"null_licence_rsn": 2, "duplicate_licence_rsn_lost_tiebreak": 4}
    assert got[7].city == "Kestrel Bay" and got[7].province == "BC" and got[7].postal_code == "V5K 0A1" and got[7].business_name == "Acme Ltd." and got[7].latitude == 49.2


def test_flags_in_order(spark):
    bad = record("1", issueddate="2027-01-01T00:00:00Z", expireddate="2026-01-01", status="Odd", postalcode="98101", geo_point_2d="99.5, -300.0", licencenumber=None)
    kept, _ = curate(raw_frame(spark, [bad]), Rules(), NOW)
    assert kept.first()["dq_flags"] == "future_issued_date;expired_before_issued;unknown_status;postal_code_not_canadian;coordinates_out_of_bounds;null_licence_number"
    assert flag_counts(kept).count() == 6
    assert tuple(coordinate_counts(kept, Rules()).first()) == (1, 0, 1, 1)


def test_window_after_keys(spark):
    """A row that lost its key does not come back when the winner lies outside the window."""
    rows = [record("1", issueddate="2025-01-05T00:00:00Z", house=None), record("1", issueddate="2024-01-05T00:00:00Z"), record("2", issueddate="2025-01-31T23:59:59Z"), record("3", issueddate=None)]
    kept, _ = curate(raw_frame(spark, rows), Rules(), NOW, since="2025-01-01", until="2025-01-31")
    assert [r.licence_rsn for r in kept.collect()] == [2]
    kept, _ = curate(raw_frame(spark, rows), Rules(), NOW, since="2025-01-01", undated=True)
    assert sorted(r.licence_rsn for r in kept.collect()) == [2, 3]
    assert day_window(kept, "issued_date").count() == 2


def test_daily_files(spark, tmp_path):
    kept, _ = curate(raw_frame(spark, [record("1"), record("2", issueddate=None), record("3", issueddate=None, folderyear=None)]), Rules(), NOW)
    write_daily(kept, str(tmp_path / "c"))
    names = sorted(str(p.relative_to(tmp_path / "c")) for p in (tmp_path / "c").glob("year=*/month=*/issued_day=*"))
    assert names == ["year=2025/month=02/issued_day=2025-02-03", "year=2025/month=unknown/issued_day=no-issued-date", "year=unknown/month=unknown/issued_day=no-issued-date"]
    write_daily(kept.filter("licence_rsn = 1").withColumn("fee_paid", F.lit(5.0)), str(tmp_path / "c"), whole=False)
    assert files.read_curated(spark, str(tmp_path / "c")).count() == 3  # other days stay


def test_casts_counted(spark):
    lost = {r.column_name: r.lost for r in cast_losses(raw_frame(spark, [record("1", feepaid="1_0", numberofemployees="12.5"), record("2", feepaid=None)])).collect()}
    assert lost["fee_paid"] == 1 and lost["number_of_employees"] == 0
    assert curated_columns(spark.createDataFrame([("1", "z")], "licencersn string, odd string")).columns[0] == "licence_rsn"


def test_load_checks(spark):
    raw = raw_frame(spark, [record("1"), record("2")]).drop("record_no")
    assert check_load(raw, "25", Rules()).ok
    assert "no rows" in check_load(raw.limit(0), "25", Rules()).stop
    assert check_load(raw.withColumn("odd", F.lit(1)), "25", Rules()).stop == ("unknown column odd",)
    assert check_load(raw.drop("licencersn"), "25", Rules()).stop[-1] == "no key column"
    assert check_load(raw, "24", Rules()).stop == ("2 rows of another partition",)
    assert check_load(raw, "25", Rules(), previous_rows=3).stop == ("shrank from 3 to 2 rows",)
    assert check_load(raw.unionAll(raw), "25", Rules(), strict=True).stop == ("2 duplicate keys",) and check_load(raw.unionAll(raw), "25", Rules()).ok
    twice = check_load(raw.unionAll(raw), "25", Rules())
    assert "repeated keys: 1, 2" in twice.warn and any("share licence number and revision" in w for w in twice.warn)
    assert "null rate of house moved" in check_load(raw.withColumn("house", F.lit(None).cast("string")), "25", Rules(), previous_rates={"house": 0.0}).warn
    assert "null keys" in check_load(raw.withColumn("licencersn", F.lit(None).cast("string")), "25", Rules()).stop


def test_refresh_and_drift(spark):
    a = spark.createDataFrame([(1, 5, 10), (2, 5, 10), (3, 5, 10), (4, 5, 10)], "partition int, row_count long, watermark int")
    b = spark.createDataFrame([(2, 5, 9), (3, 6, 10), (4, 5, 10), (5, 1, 1)], "partition int, row_count long, watermark int")
    assert {r.partition: r.reason for r in refresh_plan(a, b).collect()} == {1: "new", 2: "watermark", 3: "row_count", 4: "current", 5: "gone"}
    assert {r.partition: r.verdict for r in reconcile(a, b).collect()} == {1: "partial", 2: "match", 3: "MISMATCH", 4: "match", 5: "partial"}
    assert volume_drift(spark.createDataFrame([(1, 89, 100), (2, 90, 100)], "partition int, row_count long, previous_count long"), 0.1).count() == 1
    x, y = spark.createDataFrame([(None,), (1,)], "a int"), spark.createDataFrame([(2,), (1,)], "a int")
    assert null_drift(null_rates(x, ["a"]), null_rates(y, ["a"]), 0.4).count() == 1
    assert [r.n for r in histogram(spark.createDataFrame([("x",), ("x",), ("y",)], "v string"), "v", 1).collect()] == [2]


def test_what_the_publisher_states():
    held = {2024: 3, 2025: 4}
    assert cli.agreement(7, held, {2024, 2025}, False) == "match" and "MISMATCH" in cli.agreement(8, held, {2024, 2025}, False)
    assert cli.agreement(7, held, {2024}, True).startswith("partial")


def test_spans_of_one_hot_entity(spark):
    """Spans over many partitions go on counting across their bounds; null says nothing."""
    value = lambda i: None if i % 11 == 0 else f"v{i // 50}"
    df = spark.createDataFrame([(1 if i % 10 else 2, i, value(i)) for i in range(3000)], "e int, o int, a string").repartition(7)
    got = sorted(spans(df, "e", [F.col("o")], ["a"]).collect(), key=lambda r: (r.e, r.o))
    last = {}
    for r in got:
        before, n = last.get(r.e, (None, 0))
        n += r.e not in last or None not in (before, r.a) and before != r.a
        assert r._span == n
        last[r.e] = (r.a, n)
    assert len(got) == 3000 and max(r._span for r in got) > 40


def test_settings():
    assert resolve({"shrink": 0.2}, {"shrink": None, "known_status": ["A"]}).shrink == 0.2
    with pytest.raises(TypeError):
        resolve({"unheard_of": 1})


def test_previous_rows_of_one_hot_entity(spark):
    """One entity over many partitions sees its earlier row across their bounds."""
    df = spark.range(4000).select(F.when(F.col("id") % 10 == 0, F.lit(2)).otherwise(F.lit(1)).alias("e"), "id", (F.col("id") * 7 % 4000).alias("o"), F.lit(0).alias("_part0"))
    got = previous_rows(df, "e", [F.col("o")], ["o"]).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.e, r.o)):
        assert r.previous_o == by.get(r.e)
        by[r.e] = r.o
    assert len(got) == 4000 and previous_rows(df.limit(0), "e", [F.col("o")], ["o"]).count() == 0


def test_sequence_flags(spark):
    fact = spark.createDataFrame([(1, i, d, f"n{i}", 0) for i, d in enumerate([None, "2024-01-01", "2024-01-01", "2024-01-02"])], "business_sk long, licence_rsn long, d string, licence_number string, licence_revision_number long")
    fact = fact.withColumn("issued_date", F.col("d").cast("timestamp"))
    got = {r.licence_rsn: (r.has_later_licence, r.is_latest_licence) for r in facts.sequence_flags(fact).collect()}
    assert got == {0: (True, False), 1: (True, False), 2: (True, False), 3: (False, True)}


def test_stream(spark, tmp_path):
    files.save_records([record("1"), record("2")], str(tmp_path / "raw"), 2025)
    for _ in range(2):  # the second run finds nothing new
        curate_stream(spark, str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ck"), NOW).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    files.save_records([record("1", house="77"), record("3"), record(None)], str(tmp_path / "raw"), 2026)
    curate_stream(spark, str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ck"), NOW).awaitTermination(120)
    kept, rejected = read_streamed(spark, str(tmp_path / "out"))
    assert {r.licence_rsn: r.house for r in kept.collect()}[1] == "77" and kept.count() == 3 and rejected.count() == 2
    (tmp_path / "events").mkdir()
    stream = spark.readStream.schema("at timestamp, status string").json(str(tmp_path / "events"))
    assert stream.isStreaming and daily_counts(stream, "at").columns == ["day", "status", "n"]
