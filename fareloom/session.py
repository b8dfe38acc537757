"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
METHOD_CONF = "spark.sql.codegen.hugeMethodLimit"


def local_session(cores: int | str = "*", app: str = "fareloom", memory: str = "8g") -> SparkSession:
    """A small local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Wide feature projections make methods the JVM refuses to compile; below this size
        # Spark falls back to split projections, which it does compile.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@contextmanager
def split_methods(spark: SparkSession) -> Iterator[None]:
    """For jobs of wide projections: no methods that are too long for the JVM to compile, unless the session has its own limit."""
    given = spark.conf.get(METHOD_CONF)
    if given == "65535":
        spark.conf.set(METHOD_CONF, "8000")
    try:
        yield
    finally:
        spark.conf.set(METHOD_CONF, given)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, taking the cluster's own setting first.

    Only a local session that names none gets a temporary folder: on a cluster that would
    be a different folder on every machine.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get(CHECKPOINT_CONF, None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="fareloom-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table, visible to every executor."""
    shared = spark.conf.get(CHECKPOINT_CONF, None) or ensure_checkpoint_dir(spark)
    return f"{shared.rstrip('/')}/fareloom-{name}-{uuid.uuid4().hex}"


def spread(scan: DataFrame) -> DataFrame:
    """Deal out a scan that has fewer splits than there are cores, before heavy work per row.

    A few small files would leave most cores idle; a large table has more splits than
    cores and is left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def dealt(rows: DataFrame) -> DataFrame:
    """Deal rows out so that every core gets as many, before many passes over them.

    There are as many parts as a scan has splits, rounded up to a multiple of the cores.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(-(-max(rows.rdd.getNumPartitions(), 1) // cores) * cores)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    That cuts the lineage, survives lost executors, and gives the optimizer the table's
    real size, so a later join broadcasts it only if it is small enough. Such tables are as long as
    the input, so they are written in the codec that takes least room.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
