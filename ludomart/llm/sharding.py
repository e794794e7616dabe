"""Shards by extendible hashing.

A directory is indexed by the first bits of the key's hash; a bucket that is larger than the
byte limit splits on its next bit, and only such a bucket, until every one fits. The directory
is built by aggregates: each pass sums the bytes of open buckets by their next ``PASS_BITS``
bits and finds there the shallowest prefixes that fit. Rows then look their prefix up, pass by
pass. Nothing but the number of open buckets reaches the driver.

A bucket of one row is not split. Rows whose hashes agree in all bits (one key, repeated) are
dealt to pages of such a bucket by running sums over parts of the input, each part bounded by
a task's input; a row larger than the limit is the only one that exceeds it.

Defined results: a null key hashes as the empty text, a null text has 0 bytes, ties and
repeated rows share their key's bucket, an empty table gives an empty table, other columns
pass through and a column named as a new one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludomart.llm.common import stored

LIMIT_BYTES = 64 << 20
HASH_BITS = 60
PASS_BITS = 10


def key_hash(key: Column) -> Column:
    """60 bits of md5 of the key as text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _prefix(h: str | Column, depth: Column | int) -> Column:
    shift = F.lit(HASH_BITS) - (F.lit(depth) if isinstance(depth, int) else depth)
    return F.call_function("shiftright", F.col(h) if isinstance(h, str) else h, shift.cast("int"))


def directory(sizes: DataFrame, limit: int = LIMIT_BYTES) -> list[DataFrame]:
    """Buckets over rows (h, size), one table for each pass that found any: ``entry`` (the
    first bits, as many as the pass looks at), depth, prefix, bytes, rows."""
    found, open_, done = [], None, 0
    while True:
        deep = min(done + PASS_BITS, HASH_BITS)
        rows = sizes.withColumn("entry", _prefix("h", deep))
        if open_ is not None:
            rows = rows.join(
                open_.select(F.col("prefix").alias("up")), _prefix("h", done) == F.col("up"), "left_semi"
            )
        cells = rows.groupBy("entry").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        nodes = (
            cells.withColumn("depth", F.explode(F.sequence(F.lit(done), F.lit(deep))))
            .withColumn("prefix", F.call_function("shiftright", "entry", (F.lit(deep) - F.col("depth"))))
            .groupBy("depth", "prefix")
            .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        )
        nodes = stored(nodes, "directory")
        fits = (F.col("bytes") <= limit) | (F.col("rows") == 1)
        up = nodes.where(~fits).select(
            (F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix")
        )
        leaves = nodes.where(fits).join(up, ["depth", "prefix"], "left_semi")
        if done == 0:
            leaves = leaves.union(nodes.where(fits & (F.col("depth") == 0)).select(leaves.columns))
        if deep == HASH_BITS:
            leaves = leaves.union(nodes.where(~fits & (F.col("depth") == deep)).select(leaves.columns))
        span = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(deep) - F.col("depth"))
        first = F.col("prefix") * span
        entries = leaves.withColumn("entry", F.explode(F.sequence(first, first + span - 1)))
        found.append(entries.withColumn("bits", F.lit(deep)))
        open_ = nodes.where(~fits & (F.col("depth") == deep))
        if deep == HASH_BITS or open_.isEmpty():
            return found
        done = deep


def assign(
    df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT_BYTES, size: str | None = None
) -> DataFrame:
    """``df`` with shard_id (the bucket's bits, and a page where one is needed), shard_depth,
    shard_bytes and shard_rows of its bucket. ``size`` names a column of bytes to use instead
    of the text's length."""
    new = ("shard_id", "shard_depth", "shard_bytes", "shard_rows")
    kept = [c for c in df.columns if c.lower() not in new]
    bytes_ = F.octet_length(F.col(f"`{text}`")) if size is None else F.col(f"`{size}`")
    # The columns of the frame travel as one, so that their names meet none of those below.
    df = df.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"_{c}") for c in kept]).alias("_row"),
        key_hash(F.col(f"`{key}`")).alias("_h"),
        F.coalesce(bytes_.cast("long"), F.lit(0).cast("long")).alias("_size"),
    )
    sizes = stored(df.select(F.col("_h").alias("h"), F.col("_size").alias("size")), "sizes")
    tables = directory(sizes, limit)
    for i, entries in enumerate(tables):
        deep = min((i + 1) * PASS_BITS, HASH_BITS)
        leaf = entries.select(
            F.col("entry").alias("_entry"), F.struct("depth", "prefix", "bytes", "rows").alias(f"_leaf{i}")
        )
        df = df.join(leaf, _prefix("_h", deep) == F.col("_entry"), "left").drop("_entry")
    leaf = F.coalesce(*[F.col(f"_leaf{i}") for i in range(len(tables))])
    df = df.withColumn("_leaf", leaf).drop(*[f"_leaf{i}" for i in range(len(tables))])
    bits = F.lpad(F.conv(F.col("_leaf.prefix").cast("string"), 10, 2), F.col("_leaf.depth"), F.lit("0"))
    df = df.withColumns(
        {
            "shard_id": F.when(F.col("_leaf.depth") == 0, F.lit("")).otherwise(bits),
            "shard_depth": F.col("_leaf.depth").cast("int"),
            "shard_bytes": F.col("_leaf.bytes"),
            "shard_rows": F.col("_leaf.rows"),
        }
    ).drop("_leaf")
    if len(tables) * PASS_BITS >= HASH_BITS:
        df = _paged(df, limit)
    return df.select(*[F.col("_row").getField(f"_{c}").alias(c) for c in kept], *new)


def _paged(df: DataFrame, limit: int) -> DataFrame:
    """Pages for buckets that no bit can split any more: page p holds the rows whose running
    sum of bytes begins in the p-th stretch of limit minus the largest row."""
    full = (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)
    # Written first, so that parts and their order are the same at every evaluation.
    over = stored(df.where(full).withColumn("_part", F.spark_partition_id()), "overflow")
    parts = over.groupBy("_h", "_part").agg(F.sum("_size").alias("_sum"), F.max("_size").alias("_most"))
    by_part = Window.partitionBy("_h").orderBy("_part")
    parts = parts.withColumns(
        {
            "_before": F.sum("_sum").over(by_part.rowsBetween(Window.unboundedPreceding, -1)),
            "_most": F.max("_most").over(Window.partitionBy("_h")),
        }
    ).drop("_sum")
    within = Window.partitionBy("_h", "_part").orderBy("_size").rowsBetween(Window.unboundedPreceding, -1)
    stretch = F.greatest(F.lit(limit) - F.col("_most") + 1, F.lit(1))
    start = F.coalesce("_before", F.lit(0)) + F.coalesce(F.sum("_size").over(within), F.lit(0))
    paged = over.join(parts, ["_h", "_part"]).withColumn("_page", F.floor(start / stretch))
    pages = paged.groupBy("_h", "_page").agg(F.sum("_size").alias("_b"), F.count("*").alias("_r"))
    paged = paged.join(pages, ["_h", "_page"]).withColumns(
        {
            "shard_id": F.concat("shard_id", F.lit("-"), F.col("_page").cast("string")),
            "shard_bytes": F.col("_b"),
            "shard_rows": F.col("_r"),
        }
    )
    return df.where(~full).unionByName(paged.select(df.columns))


def write(df: DataFrame, path: str, **kwargs) -> None:
    """One folder of Parquet files for each shard."""
    out = assign(df, **kwargs)
    out.repartition("shard_id").write.partitionBy("shard_id").parquet(path)
