"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# UTC makes text with a zone and text without one mean the same instant on every
# host; the skew settings let AQE split a hot join key even where that costs an
# extra exchange further up. JSON scalars are read as text, for which exact parsing copies
# every value once more and reads about twelve times slower.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.json.enableExactStringParsing": "false",
}

# Spark removes the shuffle files of a job as it ends, not when the driver happens to collect
# its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_base: dict[str, str] = {}


def get_spark(
    app_name: str = "ludomart",
    master: str | None = None,
    shuffle_tasks: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots.

    ``shuffle_tasks`` is the number of partitions that shuffles begin with, for the whole
    session: about a task for each 64 MB of the largest input. AQE joins what turns out
    small, and cannot split what began too large. Left out, Spark's own number holds.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_tasks:
        conf["spark__sql__adaptive__coalescePartitions__initialPartitionNum"] = str(shuffle_tasks)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def workspace(spark: SparkSession, tag: str) -> str:
    """A fresh path below the folder the cluster shares (``spark.checkpoint.dir``).

    Only a local master may fall back to a temporary folder of this machine:
    executors elsewhere could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base.get(sc.applicationId)
        if base is None:
            base = _local_base[sc.applicationId] = tempfile.mkdtemp(prefix="ludomart-")
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a write or a collect are gone when it ends, so that a job
    of many steps takes the disk of one step and not of all. The session's own choice holds again
    after it."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``df`` read back from a working table, and the table's path for ``empty``."""
    path = workspace(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def empty(spark: SparkSession, path: str) -> None:
    """Empty a working folder that no frame reads any more."""
    spark.range(0, 0, 1, 1).write.mode("overwrite").parquet(path)
