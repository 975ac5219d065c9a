"""Raw JSON arrays by year, curated and model tables as Parquet, and what is held already.

Every path may lie on any file system that the session's Hadoop configuration knows.
"""

from __future__ import annotations

import json

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.functions import dates as D
from registra.schema import RAW

RECORDS = "records.json"


def _at(path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path on it."""
    spark = SparkSession.active()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(path: str) -> bool:
    system, where = _at(path)
    return system.exists(where)


def held_years(root: str) -> list[int]:
    """Years with a file of records, ascending; other folders are passed over."""
    system, where = _at(root)
    names = [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []
    return sorted(int(n) for n in names if n.isdigit() and exists(f"{root}/{n}/{RECORDS}"))


def land(data: bytes, path: str) -> None:
    """Write bytes as received to a path of their own; a reader sees the whole file or none."""
    system, part = _at(f"{path}.part")
    out = system.create(part, True)
    try:
        for at in range(0, len(data), 1 << 20):
            out.write(bytearray(data[at : at + (1 << 20)]))
    finally:
        out.close()
    put(f"{path}.part", path)


def put(source: str, target: str) -> None:
    """Move a file into place over what is there, in one step where the file system can."""
    spark = SparkSession.active()
    fs = spark._jvm.org.apache.hadoop.fs
    _, a = _at(source)
    system, b = _at(target)
    system.mkdirs(b.getParent())
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    options[0] = getattr(fs, "Options$Rename").OVERWRITE
    a, b = system.makeQualified(a), system.makeQualified(b)
    fs.FileContext.getFileContext(b.toUri(), spark._jsc.hadoopConfiguration()).rename(a, b, options)


def save_records(records: list[dict], root: str, year: int) -> str:
    """Write a year's records as a JSON array."""
    target = f"{root}/{year}/{RECORDS}"
    land(json.dumps(records, ensure_ascii=False).encode(), target)
    return target


def read_raw(spark: SparkSession, root: str, years: list[int] | None = None) -> DataFrame:
    """All years' records with every field as text (nested ones as their JSON); no year raises FileNotFoundError."""
    chosen = held_years(root) if years is None else years
    paths = [f"{root}/{y}/{RECORDS}" for y in chosen]
    if not paths or (lost := [p for p in paths if not exists(p)]):
        raise FileNotFoundError(f"no records under {root}" if not paths else ", ".join(lost))
    return spark.read.schema(RAW).option("multiLine", True).option("mode", "FAILFAST").json(paths)


def read_received(spark: SparkSession, path: str) -> DataFrame:
    """One landed file with whatever columns it has, plain values as text."""
    return spark.read.option("multiLine", True).option("mode", "FAILFAST").option("primitivesAsString", True).json(path)


def with_row_numbers(raw: DataFrame) -> DataFrame:
    """Adds ``record_no``: rows by input partition and place in it, the same whenever the files are."""
    return raw.withColumn("record_no", F.monotonically_increasing_id())


def side_copy(df: DataFrame, path: str, kind: str) -> None:
    """Write ``df`` once more as ``parquet`` or ``csv``; another kind raises ValueError."""
    if kind not in ("parquet", "csv"):
        raise ValueError(f"unknown format {kind}")
    writer = df.write.mode("overwrite")
    writer.parquet(path) if kind == "parquet" else writer.option("header", True).csv(path)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """The curated table without its folder columns; an empty or missing folder raises FileNotFoundError."""
    system, where = _at(path)
    found = system.listFiles(where, True) if system.exists(where) else None
    while found is not None and found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return spark.read.parquet(path).drop("year", "month", "issued_day")
    raise FileNotFoundError(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table that ``write_tables`` left under ``root``; a missing one raises FileNotFoundError."""
    if not exists(f"{root}/{name}/_SUCCESS"):
        raise FileNotFoundError(f"{root}/{name}")
    return spark.read.parquet(f"{root}/{name}")


def write_tables(tables: dict[str, DataFrame], path: str, small: tuple[str, ...] = (), dry_run: bool = False) -> dict[str, int]:
    """Write each table under ``path`` and return row counts; tables named in ``small`` become one file. A dry run only counts."""
    counts = {}
    for name, df in tables.items():
        if dry_run:
            counts[name] = df.count()
            continue
        (df.coalesce(1) if name in small else df).write.mode("overwrite").parquet(f"{path}/{name}")
        counts[name] = df.sparkSession.read.parquet(f"{path}/{name}").count()
    return counts


def held_state(spark: SparkSession, root: str, year: int) -> dict | None:
    """Row count, greatest extract instant (epoch seconds) and null rates of what is held of a year; None if it is missing or cannot be read."""
    try:
        raw = read_raw(spark, root, [year])
        rates: list[Column] = [F.round(F.avg(F.col(c).isNull().cast("int")), 4).alias(c) for c in raw.columns]
        row = raw.agg(F.count(F.lit(1)).alias("_n"), F.unix_seconds(F.max(D.iso_instant(F.col("extractdate")))).alias("_w"), *rates).first()
    except Exception:  # a broken file counts as none, whatever broke it
        return None
    return {"rows": row["_n"], "watermark": row["_w"], "null_rates": {c: row[c] for c in raw.columns}}
