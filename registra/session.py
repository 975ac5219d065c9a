"""Session set-up and the few places where a plan is cut or sized."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[*]", app: str = "registra", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; extra settings by keyword, dots written as two underscores."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only where that is unset and the session runs on one machine a temporary folder is made; on a cluster
    an unset folder raises, as the executors' own disks would not do.
    """
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="registra-")
    context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return it without its lineage.

    The files are replicated by the file system, so a lost executor loses nothing. ``release`` removes them.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system it lies; a missing one is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(*frames: DataFrame) -> None:
    """Delete what ``cut`` wrote for ``frames``, once nothing reads them any more; other frames are left alone."""
    for df in frames:
        plan = df._jdf.queryExecution().logical()
        if plan.nodeName().startswith("LogicalRDD") or "LogicalRDD" in plan.getClass().getName():
            file = plan.rdd().getCheckpointFile()
            if file.isDefined():
                remove(df.sparkSession, file.get())


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked to meet its partner in a sort-merge join, for sides whose size no statistic tells."""
    return df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over enough partitions to keep every core busy, for few rows with much work each."""
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))


def busy(df: DataFrame) -> DataFrame:
    """``df`` as it is, or shuffled once where its input comes in fewer pieces than there are cores.

    For scans that feed much work per row; large inputs come in enough pieces and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


MOST_BYTES = 32_000_000


def small_side(df: DataFrame, rows: int = 100_000, size: int = MOST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows and ``size`` bytes (as JSON), else as it is (the join then shuffles).

    What was looked at is written out, so a small side is worked out once.
    """
    seen = cut(df.limit(rows + 1))
    n, width = seen.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct(*df.columns))).cast("bigint"))).first()
    return F.broadcast(seen) if n <= rows and (width or 0) <= size else df


def free(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    while name in df.columns:
        name = f"_{name}"
    return name


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read one Parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
