"""Operators over a total order of the whole frame, without a global window.

All start from ``ordered_blocks``: Spark range-partitions and sorts the rows
once, and the result is written to the shared folder together with each row's
block and position. Blocks are balanced by Spark's own sampling of the full sort
key, so a group that holds a third of all rows is spread over a third of the
blocks. The table is written because block bounds come from sampling: counting
and numbering have to see the same blocks, also after an executor is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludomart.session import workspace

# Layout of monotonically_increasing_id: partition above bit 33, row number below.
_ROW_BITS = 33


def sorted_ranges(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` in partitions by range of the order that ``ordered_blocks`` gives, each sorted."""
    order = [F.col(k).asc_nulls_first() for k in keys]
    others = [c for c in df.columns if c not in keys]
    if others:
        order.append(F.xxhash64(*others).asc())
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def ordered_blocks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` sorted by ``keys`` (NULL first) plus ``_block`` and ``_pos`` (from 0).

    Rows equal in all keys are ordered by a hash of their other columns: a total
    order whose key stays short, since Spark samples keys to the driver.
    """
    path = workspace(df.sparkSession, "ordered")
    (
        sorted_ranges(df, keys)
        .withColumn("_m", F.monotonically_increasing_id())
        .withColumn("_block", F.shiftright("_m", _ROW_BITS).cast("int"))
        .withColumn("_pos", F.col("_m").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_m")
        .write.parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def dense_id(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add ``name`` = 0..n-1 in the order of ``keys``.

    The count per block reads one integer column of the written table; the
    window below runs over one row per block, never over the data.
    """
    blocks = ordered_blocks(df, keys)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocks.groupBy("_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per block: as many as the range partitioning has partitions.
    return (
        blocks.join(F.broadcast(offsets), "_block")
        .withColumn(name, F.col("_offset") + F.col("_pos"))
        .select(*df.columns, name)
    )


def previous_in_order(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    """Add ``name`` = ``value`` of the row before in (``order``) within ``group``.

    Same result as ``lag`` over a window by ``group``, but no group has to fit
    one task: rows are read block by block, and the last row of each block is
    handed to the next one (one row per block).
    """
    blocks = ordered_blocks(df, [*group, *order])
    row = F.struct(*[F.col(g) for g in group], F.col(value).alias("_value"))
    ends = blocks.groupBy("_block").agg(F.max("_pos").alias("_pos"))
    # One row per block in ends, last and carried.
    last = blocks.join(F.broadcast(ends), ["_block", "_pos"]).select("_block", row.alias("_carry"))
    carried = last.select(
        F.lead("_block").over(Window.orderBy("_block")).alias("_block"), "_carry"
    ).filter("_block IS NOT NULL")
    in_block = Window.partitionBy("_block").orderBy("_pos")
    prev = F.coalesce(F.lag(row).over(in_block), F.when(F.col("_pos") == 0, F.col("_carry")))
    same: Column = F.lit(True)
    for g in group:
        same = same & F.col(f"_prev.{g}").eqNullSafe(F.col(g))
    return (
        blocks.join(F.broadcast(carried), "_block", "left")
        .withColumn("_prev", prev)
        .withColumn(name, F.when(F.col("_prev").isNotNull() & same, F.col("_prev._value")))
        .select(*df.columns, name)
    )


def batch_ids(df: DataFrame, key: str, size: int) -> DataFrame:
    """Batches of ``size`` ids in order: (batch, ids). Each group has ``size`` rows at most."""
    return (
        dense_id(df.select(key).dropna(), [key], "_id")
        .groupBy(F.expr(f"_id div {size}").alias("batch"))
        .agg(F.array_sort(F.collect_list(key)).alias("ids"))
    )
