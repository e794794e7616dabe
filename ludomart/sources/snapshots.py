"""Published tables as immutable snapshots and a log that says which one is current.

    root/table/20260102T030405123456-3f2a9c1e/    a snapshot: Parquet, written once, never renamed
    root/_manifests/table/                        the log: one small JSON file for each step

A publisher notes that a snapshot has begun, writes it, and notes that it is published. Spark's
append makes a note visible at once or not at all, so a reader finds the old table or the new
one, whole, and keeps reading the one it has found. A run that is killed leaves a snapshot that
no note calls published. Older snapshots than the newest ``keep`` are emptied, as are those of
killed runs; nothing is renamed, which would be a copy on object stores.

One publisher works on a table at a time. Of two at once the later note wins, whole.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

NOTE = "snapshot STRING, state STRING, n_rows LONG, noted_at TIMESTAMP"
KEEP = 2


@dataclass(frozen=True)
class Snapshot:
    root: str
    table: str
    name: str

    @property
    def path(self) -> str:
        return f"{self.root}/{self.table}/{self.name}"


def _log(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/_manifests/{table}"


def history(spark: SparkSession, root: str, table: str) -> list[Row]:
    """The notes of a table in order: a few for each time it was published."""
    try:
        notes = spark.read.schema(NOTE).json(_log(root, table)).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(notes, key=lambda n: (n.noted_at, n.snapshot))


def _note(spark: SparkSession, snapshot: Snapshot, state: str, rows: int | None = None) -> None:
    values = (
        F.lit(snapshot.name).alias("snapshot"),
        F.lit(state).alias("state"),
        F.lit(rows).cast("long").alias("n_rows"),
        F.lit(datetime.now(UTC)).alias("noted_at"),
    )
    # A range of one row and one partition: a single task writes a single file.
    spark.range(0, 1, 1, 1).select(*values).write.mode("append").json(_log(snapshot.root, snapshot.table))


def _published(notes: list[Row]) -> list[Row]:
    """Snapshots that readers may find, the newest last."""
    gone = {n.snapshot for n in notes if n.state == "expired"}
    return [n for n in notes if n.state == "published" and n.snapshot not in gone]


def begin(spark: SparkSession, root: str, table: str) -> Snapshot:
    """A new snapshot to write to."""
    name = f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    snapshot = Snapshot(root.rstrip("/"), table, name)
    _note(spark, snapshot, "begun")
    return snapshot


def commit(spark: SparkSession, snapshot: Snapshot, rows: int, keep: int = KEEP) -> None:
    """From now on readers find this snapshot; what is too old is emptied."""
    _note(spark, snapshot, "published", rows)
    expire(spark, snapshot.root, snapshot.table, keep)


def discard(spark: SparkSession, snapshot: Snapshot) -> None:
    """Empty a snapshot and note that it is gone."""
    spark.range(0, 0, 1, 1).write.mode("overwrite").parquet(snapshot.path)
    _note(spark, snapshot, "expired")


def expire(spark: SparkSession, root: str, table: str, keep: int = KEEP) -> list[str]:
    """Empty all snapshots before the newest ``keep`` published ones, and those that were begun
    before the newest and never published; their names."""
    notes = history(spark, root, table)
    published = _published(notes)
    if not published:
        return []
    kept = {n.snapshot for n in published[-max(keep, 1) :]}
    gone = {n.snapshot for n in notes if n.state == "expired"}
    old = sorted({n.snapshot for n in notes if n.noted_at <= published[-1].noted_at} - kept - gone)
    for name in old:
        discard(spark, Snapshot(root.rstrip("/"), table, name))
    return old


def current(spark: SparkSession, root: str, table: str) -> str:
    """The folder of the published table."""
    published = _published(history(spark, root, table))
    if not published:
        raise FileNotFoundError(f"no table {table} is published below {root}")
    return Snapshot(root.rstrip("/"), table, published[-1].snapshot).path


def read_table(spark: SparkSession, root: str, table: str, *columns: str) -> DataFrame:
    """A published table, narrowed to ``columns`` (the scan reads only those)."""
    df = spark.read.parquet(current(spark, root, table))
    return df.select(*columns) if columns else df
