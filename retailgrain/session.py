"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings for speed; none changes what a query means, so a running session can take them.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffled order lines grow to some 18 times their bytes where a task sorts or groups them.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Columnar files grow several times in memory; without this, sides are broadcast that should not be.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# A write ends a step of its own, so the shuffle files it needed are of no further use.
CLEAN_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Partitions that a shuffle is cut into before small ones are put together; a fixed small number would let tasks grow with the tables.
INITIAL_PARTITIONS = 1000

# What a session of the library's own has besides.
STATIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python call site of every column slows down building wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_fallback_dir: str | None = None


def build_session(
    app_name: str = "retailgrain",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create or get a session with the library's settings; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**STATIC_CONF, **RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings for speed to a session somebody else built; its time zone and write modes stay."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    cut = max(INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(cut))
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local-mode session may go without that setting; it then gets one
    scratch folder per process.
    """
    global _fallback_dir
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _fallback_dir is None:
            _fallback_dir = tempfile.mkdtemp(prefix="retailgrain-")
        base = _fallback_dir
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a work folder and read again: made once however often it is used, and without its shuffle files."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    with settings(spark, CLEAN_CONF):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
