"""Command line: fetch, curate and model. Exit codes: 0 clean, 1 failure, 2 bad settings or unknown year."""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import UTC, datetime

from pyspark.sql import functions as F

from registra.operators import dimensions as dims
from registra.operators import facts, marts
from registra.operators.curate import curate, write_daily, write_summary
from registra.operators.incremental import check_load
from registra.schema import Rules
from registra.session import build_session
from registra.sources import files
from registra.sources.portal import Portal, PortalError, decode_year, encode_year

log = logging.getLogger("registra")
MOST_STATES = 200


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="registra")
    p.add_argument("--log-level", default="INFO")
    p.add_argument("--master", default="local[*]")
    sub = p.add_subparsers(dest="stage", required=True)
    a = sub.add_parser("fetch", help="load partitions that changed")
    a.add_argument("--base", required=True)
    a.add_argument("--dataset", required=True)
    a.add_argument("--raw-root", required=True)
    a.add_argument("--partition", nargs="+")
    a.add_argument("--first-year", type=int)
    a.add_argument("--full-refresh", action="store_true")
    a.add_argument("--dry-run", action="store_true")
    a.add_argument("--strict", action="store_true")
    a.add_argument("--side-copy", choices=("parquet", "csv"))
    b = sub.add_parser("curate", help="raw to curated, always over all years")
    b.add_argument("--raw-root", required=True)
    b.add_argument("--curated-root", required=True)
    b.add_argument("--year", nargs="+", type=int, help="years that must be there")
    b.add_argument("--since")
    b.add_argument("--until")
    b.add_argument("--include-undated", action="store_true")
    b.add_argument("--dry-run", action="store_true")
    c = sub.add_parser("model", help="curated to dimensions and facts")
    c.add_argument("--curated-root", required=True)
    c.add_argument("--model-root", required=True)
    c.add_argument("--start", default="1900-01-01", help="first day of the range for the area mart")
    c.add_argument("--end", default=None, help="last day of it, today if not given")
    c.add_argument("--ended", nargs="+", default=["Cancelled", "Gone Out of Business"], help="statuses that end a licence")
    c.add_argument("--all-spans", action="store_true", help="spans of all businesses, not only of those whose start was observed")
    c.add_argument("--dry-run", action="store_true")
    return p


def run_fetch(spark, args) -> int:
    """Probe each partition, load what differs, check it, save it; one partition's failure does not stop the others."""
    portal = Portal(args.base, args.dataset)
    offered = dict(portal.discover(args.first_year))
    chosen = portal_labels(offered, args)
    if unknown := [x for x in chosen if x not in offered]:
        log.error("unknown partitions: %s", ", ".join(unknown))
        return 2
    failed = 0
    for label in chosen:
        year = decode_year(label)
        try:
            rows, watermark = portal.probe(label)
            held = files.held_state(spark, args.raw_root, year)
            latest = spark.range(1).select(F.unix_seconds(F.lit(watermark).try_cast("timestamp"))).first()[0] if watermark else None
            if held and not args.full_refresh and (held["rows"], held["watermark"]) == (rows, latest):
                log.info("%s is current", year)
                continue
            if args.dry_run:
                log.info("%s would be loaded (%d rows)", year, rows)
                continue
            arrived = f"{args.raw_root}/.arrived/{year}/{files.RECORDS}"
            files.land(portal.received(label), arrived)
            raw = files.read_received(spark, arrived)
            verdict = check_load(raw, label, Rules(), held and held["rows"], held and held["null_rates"], args.strict)
            for w in verdict.warn:
                log.warning("%s: %s", year, w)
            if not verdict.ok:
                raise ValueError("; ".join(verdict.stop))
            files.put(arrived, f"{args.raw_root}/{year}/{files.RECORDS}")
            if args.side_copy:
                files.side_copy(files.read_raw(spark, args.raw_root, [year]), f"{args.raw_root}/{year}/copy.{args.side_copy}", args.side_copy)
        except (PortalError, ValueError) as e:
            log.error("%s: %s", year, e)
            failed += 1
    held_rows = {y: state["rows"] for y in files.held_years(args.raw_root) if (state := files.held_state(spark, args.raw_root, y))}
    log.info("%d rows held: %s", sum(held_rows.values()), agreement(portal.metadata()["records_count"], held_rows, {decode_year(x) for x in portal_labels(offered, args)}, bool(args.partition or args.first_year)))
    return 1 if failed else 0


def portal_labels(offered: dict[str, int], args) -> list[str]:
    return [encode_year(x) for x in args.partition] if args.partition else list(offered)


def agreement(stated: int | None, held: dict[int, int], asked: set[int], partial: bool) -> str:
    """Whether the rows held are as many as the publisher states; a run over a part of the years cannot tell."""
    if partial:
        return f"partial run over {len(asked)} years, not compared"
    return "match" if sum(held.values()) == stated else f"MISMATCH, the publisher states {stated}"


def run_curate(spark, args) -> int:
    if missing := [y for y in args.year or [] if y not in files.held_years(args.raw_root)]:
        log.error("unknown years: %s", missing)
        return 2
    raw = files.with_row_numbers(files.read_raw(spark, args.raw_root))
    kept, rejected = curate(raw, Rules(), datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S"), since=args.since, until=args.until, undated=args.include_undated)
    for r in write_summary(kept, rejected).collect():  # a row per flag and reason
        log.info("%s: %d", r.measure, r.n)
    if not args.dry_run:
        write_daily(kept, f"{args.curated_root}/curated", whole=args.since is None and args.until is None)
        write_daily(rejected, f"{args.curated_root}/quarantine")
    return 0


def run_model(spark, args) -> int:
    df = files.read_curated(spark, f"{args.curated_root}/curated")
    keyed = facts.sequence_flags(facts.keyed_licences(df), "business_key")
    fact = keyed.withColumnsRenamed({"business_key": "business_sk", "address_key": "address_sk", "area_key": "neighbourhood_sk", "category_key": "category_sk", "status_key": "status_sk"}).drop("is_current_revision", "has_later_licence", "is_latest_licence")
    places = dims.dim_address(df).withColumnRenamed("address_key", "address_sk")
    tables = {
        "dim_business": dims.dim_business(df), "dim_address": places, "dim_neighbourhood": dims.dim_members(df, ["local_area"], "area_key"), "dim_status": dims.dim_members(df, ["status"], "status_key"),
        "dim_date": dims.dim_date(df, ["issued_date", "expired_date", "extract_date"]), "fact_licence": keyed, "dim_business_history": facts.attribute_history(fact), "fact_business_lifecycle": facts.lifecycles(fact),
        "fact_address_change": facts.relocations(fact, places), "fact_status_transition": facts.transitions(fact), "fact_renewal": facts.renewals(fact),
    }
    for name, key in (("dim_business", "business_key"), ("dim_address", "address_sk"), ("fact_licence", "licence_rsn"), ("fact_business_lifecycle", "business_sk")):
        if not dims.fanout(tables[name], key).isEmpty():
            log.error("%s has repeated keys", name)
            return 1
    areas = tables["dim_neighbourhood"].withColumnRenamed("area_key", "neighbourhood_sk")
    kinds = dims.dim_members(df, ["business_type", "business_subtype"], "category_sk")
    statuses = sorted(r.status for r in df.filter("status is not null").select("status").distinct().limit(MOST_STATES + 1).collect())
    if len(statuses) > MOST_STATES:
        log.error("more than %d statuses, too many for columns", MOST_STATES)
        return 1
    first = None if args.all_spans else df.agg(F.min("folder_year")).first()[0]
    tables |= {
        "dim_category": kinds, "mart_neighbourhood_activity": marts.activity_by_area(fact, areas, statuses, [s for s in statuses if s in args.ended], args.start, args.end or datetime.now(UTC).strftime("%Y-%m-%d")),
        "mart_lifespan_by_category": marts.spans_by_category(fact, kinds, first), "mart_address_changes": marts.labelled_moves(fact, places, areas),
    }
    for name, rows in files.write_tables(tables, args.model_root, ("dim_neighbourhood", "dim_status", "dim_date"), args.dry_run).items():
        log.info("%s: %d rows", name, rows)
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=args.log_level.upper(), format="%(levelname)s %(message)s")
    spark = build_session(args.master)
    try:
        return {"fetch": run_fetch, "curate": run_curate, "model": run_model}[args.stage](spark, args)
    except (FileNotFoundError, PortalError) as e:
        log.error("%s", e)
        return 1


if __name__ == "__main__":
    sys.exit(main())
