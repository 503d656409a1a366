"""Spark session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on; all are runtime-settable, so they also
# apply to a session the caller has already built.
RULES = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even when that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_fallback_root: dict[str, str] = {}


def apply_rules(spark: SparkSession) -> SparkSession:
    """Set RULES on the session, for good: its time zone is UTC from then on."""
    for key, value in RULES.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "revlattice",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the house rules; `shuffle_partitions` is only for small local runs.

    On a cluster leave it unset and give AQE a high
    `spark.sql.adaptive.coalescePartitions.initialPartitionNum` through `extra`.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        # Noting the Python line of every column costs more driver time than planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RULES, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in `spark.checkpoint.dir`.

    Only where that is unset (local runs, tests) is a folder made here.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _fallback_root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        _fallback_root[app] = tempfile.mkdtemp(prefix="revlattice-")
    return _fallback_root[app]


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
