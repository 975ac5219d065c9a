"""New raw files to the curated table as they arrive, by the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from registra.operators.curate import checked
from registra.operators.quality import null_count, one_per_key
from registra.schema import RAW, Rules
from registra.sources.files import with_row_numbers


def watch_raw(spark: SparkSession, root: str) -> DataFrame:
    """A stream over the years' JSON files, each field as text."""
    return spark.readStream.schema(RAW).option("multiLine", True).json(f"{root}/*/records.json")


def curate_stream(spark: SparkSession, root: str, out: str, checkpoint: str, now: str, rules: Rules | None = None) -> StreamingQuery:
    """Check every new file once and append its rows under ``out`` by batch; ends when all are taken.

    A batch is written to a folder of its own number, so a batch that is run again after a failure
    replaces itself. ``read_streamed`` makes keys unique over all batches.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = checked(with_row_numbers(batch), rules or Rules(), now).withColumn("batch", F.lit(number))
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return watch_raw(spark, root).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_streamed(spark: SparkSession, out: str, rules: Rules | None = None) -> tuple[DataFrame, DataFrame]:
    """Curated and rejected rows over all batches under ``out``; full ties go to the later batch."""
    chosen = rules or Rules()
    rows = with_row_numbers(spark.read.parquet(out).drop("record_no"))
    order = [-null_count([c for c in rows.columns if c not in ("record_no", "batch")]), F.col("extract_date"), F.col("licence_revision_number"), F.col("batch")]
    kept, rejected = one_per_key(rows, chosen.key, order, "record_no")
    return kept.drop("record_no", "batch"), rejected.drop("record_no", "batch")


def daily_counts(stream: DataFrame, at: str, late: str = "2 days") -> DataFrame:
    """Rows per day and status of a stream, with rows later than ``late`` left out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, "1 day").alias("day"), "status").agg(F.count(F.lit(1)).alias("n")).select(F.col("day.start").alias("day"), "status", "n")
