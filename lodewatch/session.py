"""Session helpers: a local session for tests and the shared work folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Rows that a task of a gathered scan holds.
GATHERED_ROWS = 250_000

_made: dict[str, list[str]] = {}  # work folders by application


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lodewatch")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that a local folder is seen by all of them."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only where a session on one machine names none (tests, local runs) a folder of our own is
    made and set, so that every later call uses the same root. On a cluster a missing
    `spark.checkpoint.dir` is an error: executors would write to disks that nobody else reads.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = current.get() if current.isDefined() else None
    if not root:
        if not one_machine(spark):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lodewatch-")
        spark.sparkContext.setCheckpointDir(root)
    path = os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_work(spark: SparkSession) -> int:
    """Deletes the work folders that this session has made; for the end of a job. Returns their number."""
    made = _made.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in made:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    return len(made)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table written to the shared work folder.

    For results that several later steps read: they are computed once, the plan behind them ends
    here, and the table outlives a lost executor.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def small_enough(table: DataFrame) -> bool:
    """Whether Spark broadcasts a stored table by itself: its size in bytes is below the session's threshold."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size <= limit


def gathered(scan: DataFrame, *keys: str, rows: int = GATHERED_ROWS) -> DataFrame:
    """A scan dealt by key once, so that aggregations by these and more columns need no further shuffle.

    The number of parts follows from the number of rows in the files, so a task holds about `rows` rows at any size. Only for
    plain scans, whose rows are counted without reading them, and for keys of few rows each.
    """
    return scan.repartition(gathered_parts(scan, rows), *keys)


def gathered_parts(scan: DataFrame, rows: int = GATHERED_ROWS) -> int:
    """Number of parts of a gathered scan, for the other side of a join that is to lie like it."""
    return max(scan.sparkSession.sparkContext.defaultParallelism, math.ceil(scan.count() / rows))


def spread(scan: DataFrame) -> DataFrame:
    """Spreads a scan that has fewer splits than the session has cores over all cores.

    For work that is heavy per row (JSON, regular expressions) on a few large splits. A scan with
    enough splits, as any large one has, is returned as it is. Only for plain scans: asking a plan
    with a shuffle for its partitions would run it.
    """
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
