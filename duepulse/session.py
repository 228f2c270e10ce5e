"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

REQUIRED_CONF = {
    # Day and hour buckets are taken from zone-less timestamps.
    "spark.sql.session.timeZone": "UTC",
    # A value that does not parse stops the job instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_MB = 1024 * 1024
_SHUFFLED_SHARE = 0.25
_LEAST_BLOCK = 256 * 1024
_MOST_PARTITION = 2048 * _MB


def require(spark: SparkSession) -> None:
    """Raises unless a value that does not parse stops a job of this session."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("spark.sql.ansi.enabled must be true; see session.REQUIRED_CONF")


def cluster_conf(input_bytes: int, executor_cores: int) -> dict[str, str]:
    """Settings for a run that reads about ``input_bytes`` on ``executor_cores`` cores in all.

    The largest shuffle, of the loan aggregate, moves about a quarter of the input. It has at
    least two partitions per core and at most 2 GB in each, which the aggregate can spill; the
    adaptive planner merges what turns out small. Every scan task writes a block for every
    partition, and many small blocks are random reads; so scan tasks are as few as keep the mean
    block at 256 KB, yet two for each core.
    """
    shuffled = int(input_bytes * _SHUFFLED_SHARE)
    partitions = max(2 * executor_cores, -(-shuffled // _MOST_PARTITION))
    scan_tasks = max(2 * executor_cores, shuffled // (partitions * _LEAST_BLOCK))
    split = max(128 * _MB, -(-input_bytes // scan_tasks))
    return {
        **REQUIRED_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * _MB),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def build_session(app_name: str = "duepulse", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the required settings; ``conf`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
