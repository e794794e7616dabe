"""Reviews that keep landing, appended to the published table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludomart.functions import parse_iso
from ludomart.plans import facts
from ludomart.schemas import ATLAS_REVIEWS, PARTITIONS


def _known_ids(spark: SparkSession, path: str) -> DataFrame | None:
    """Ids in the table; none if there is no table yet. Not every committer leaves a marker
    file: the folder itself is asked for."""
    try:
        return spark.read.schema("review_id STRING").parquet(path).select(F.col("review_id").alias("id"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def incremental_reviews(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    games: DataFrame,
    bgg: DataFrame,
    users: DataFrame,
    files_per_batch: int = 1000,
    rejects: str | None = None,
) -> None:
    """Process the files that landed since the last call, then stop.

    Each batch is deduplicated, reviews already in the table are taken out by an
    anti join on the id column, and the rest is appended to its month. So a batch
    that is run again adds nothing, and late reviews need no watermark: the table
    itself is the state. Where copies of a review differ, the first to arrive stays.
    Rows with an id whose date cannot be read go to ``rejects`` as they came, a folder for
    each batch (beside the target by default), which a batch that is run again overwrites.
    """
    rejects = rejects or f"{target.rstrip('/')}_rejects"

    def append(batch: DataFrame, number: int) -> None:
        unread = batch.filter(F.col("id").isNotNull() & parse_iso(F.col("createdAt")).isNull())
        unread.write.mode("overwrite").json(f"{rejects}/batch={number}")
        fresh = batch
        if (known := _known_ids(spark, target)) is not None:
            fresh = batch.join(known, "id", "left_anti")
        rows = facts.reviews(fresh, games, bgg, users).filter(F.col("review_datetime").isNotNull())
        (
            rows.hint("rebalance", *PARTITIONS["reviews"])
            .write.mode("append")
            .partitionBy(*PARTITIONS["reviews"])
            .parquet(target)
        )

    query = (
        spark.readStream.schema(ATLAS_REVIEWS)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
