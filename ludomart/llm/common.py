"""What the operators share: reading tables, passing Arrow batches through, union of links."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ludomart.session import workspace

# Bytes of text that one step of a Python task holds as arrays at a time. A text is never
# cut: one that is longer makes a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: its lineage ends there."""
    path = workspace(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(df: DataFrame, *names: str) -> list[str]:
    """``names`` for columns of one's own, with underscores before those that ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def share(spark: SparkSession, value):
    """A broadcast of an object of this subpackage, which ``shared`` gives back. It travels by
    value, as the workers may lack the package; plain broadcasts go by reference."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(broadcast):
    return pickle.loads(broadcast.value)


def fold_of(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(n)


def steps(batch: pa.RecordBatch, text: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have up to ``limit`` bytes, one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def with_columns(
    df: DataFrame,
    text: str,
    fields: list[StructField],
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, pa.Array]]],
    keep: list[str] | None = None,
    limit: int = STEP_BYTES,
) -> DataFrame:
    """Columns computed from whole texts, beside the columns ``keep`` (all by default).

    ``make`` runs once in a task and returns the function from a slice of a batch to the new
    columns. A new column replaces an old one of its name; ``keep`` may leave out the text.
    """
    new = {f.name for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    inputs = list(dict.fromkeys([*kept, text, *(c for c in df.columns if c in new and keep is None)]))
    inputs = [c for c in inputs if c in df.columns and (c in kept or c == text)]
    out = StructType([*(df.schema[c] for c in kept), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            if work is None:
                work = make()
            for part in steps(batch, text, limit):
                made = work(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [made[f.name] for f in fields],
                    names=kept + [f.name for f in fields],
                )

    return df.select(*[F.col(f"`{c}`") for c in inputs]).mapInArrow(run, out)


def keep_where(
    df: DataFrame, text: str, make: Callable[[], Callable[[pa.RecordBatch], list | pa.Array]], limit: int = STEP_BYTES
) -> DataFrame:
    """The rows, as they are, for which the function that ``make`` returns says true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            if work is None:
                work = make()
            for part in steps(batch, text, limit):
                yield part.filter(pa.array(work(part), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def components(edges: DataFrame, tag: str, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable over undirected links, for every node of
    ``edges``.

    Star contraction: large-star and small-star in turn halve the distance to the least node
    in about each round, whatever the number of links of a node; each round is written to the
    shared folder, and rounds end when no link changes. Only counts reach the driver.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    links = stored(links, tag)
    state = None
    while True:
        # Large star: neighbours above a node are hung on its least neighbour. The least
        # neighbour is an aggregate joined back, so no node's list is ever gathered.
        both = links.union(links.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: what lies below a node, and itself, is hung on the least of them.
        down = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        down = stored(down.distinct(), tag)
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("x"), "m").where("x <> m")
        links = stored(small.union(low.select("u", "m")).toDF("u", "v").distinct(), tag)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(links.select("v", "v").distinct()).toDF("node", "component")


# Bits of the filter below: its size in a task is fixed, whatever the number of keys.
FILTER_BITS = 1 << 24


def _set_bits(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(word, mask): two bits for every key, as those words of a bitmap that are not zero."""
    h = F.xxhash64(F.col(f"`{key}`"))
    bit = F.explode(F.array(F.pmod(h, F.lit(bits)), F.pmod(F.shiftright(h, 32), F.lit(bits))))
    return (
        keys.select(bit.alias("bit"))
        .select(F.shiftright("bit", 5).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 32).cast("int")).alias("mask"))
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
    )


def key_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS):
    """A broadcast bitmap of ``bits`` bits in which every key of ``keys`` has two bits set."""
    import numpy as np

    rows = _set_bits(keys, key, bits).toArrow()
    words = np.zeros(bits // 32, np.uint32)
    words[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().astype(np.uint32)
    return keys.sparkSession.sparkContext.broadcast(words)


def in_filter(hashes: pa.Array, words) -> pa.Array:
    """Which of the keys with these ``xxhash64`` have their bits set in a ``key_filter``."""
    import numpy as np

    h = hashes.to_numpy()
    hit = np.ones(len(h), bool)
    for b in (np.mod(h, FILTER_BITS), np.mod(h >> 32, FILTER_BITS)):
        hit &= (words[b >> 5] >> (b & 31).astype(np.uint32)) & np.uint32(1) == 1
    return pa.array(hit)


def split_by_keys(df: DataFrame, key: str, keys: DataFrame, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose key is surely not in ``keys`` (a column of that name), and all others:
    no shuffle of ``df``, whose rows do not leave the JVM, and few rows too many among the others
    where keys are few against the bits. The words broadcast are ``bits // 32`` at most."""
    hashed, *free_names = free(df, "_h", "_w", "_m", "_x", "_y")
    w, m, x, y = free_names
    words = F.broadcast(_set_bits(keys, key, bits).toDF(w, m))
    own = df.withColumn(hashed, F.xxhash64(F.col(f"`{key}`")))
    hit = F.lit(True)
    for mask, h in ((x, F.col(hashed)), (y, F.shiftright(hashed, 32))):
        bit = F.pmod(h, F.lit(bits))
        own = own.join(words.withColumnRenamed(m, mask), F.shiftright(bit, 5) == F.col(w), "left").drop(w)
        hit = hit & (F.call_function("getbit", F.coalesce(mask, F.lit(0).cast("long")), (bit % 32).cast("int")) == 1)
    mine = [F.col(f"`{c}`") for c in df.columns]
    return own.where(~hit).select(mine), own.where(hit).select(mine)
