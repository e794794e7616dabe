import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from ludomart.operators import (
    batch_ids,
    dedupe_name,
    dedupe_pk,
    dense_id,
    lookup,
    previous_in_order,
    profile,
)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def skewed_rows(n=3000, seed=3):
    """(id, grp, at, val): a third of the rows in one group, some groups NULL."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        grp = "hot" if i % 3 == 0 else None if i % 10 == 1 else f"g{rng.randrange(40)}"
        rows.append((i, grp, rng.randrange(50), float(rng.randrange(100))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_dedupe_pk_is_the_same_on_any_layout(spark, settings, partitions):
    settings(spark__sql__shuffle__partitions=str(partitions))
    rows = [(i % 50, i % 7, f"p{i % 11}") for i in range(1000)] + [(None, 1, "x")]
    want = {}
    for k, a, b in rows:
        if k is not None:
            want[k] = min(want.get(k, (1, "")), (-a, b)) if k in want else (-a, b)
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, "k INT, a INT, b STRING").repartition(partitions)
    got = {r.k: (-r.a, r.b) for r in dedupe_pk(df, "k", [F.col("a").desc()]).collect()}
    assert got == want


def test_dedupe_pk_limits_groups_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = dedupe_pk(df, "k")._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    first = next(i for i, s in enumerate(lines) if "Exchange hashpartitioning" in s)
    assert any("WindowGroupLimit" in s and "Partial" in s for s in lines[first:])


def test_dedupe_name_takes_lowest_and_skips_null(spark):
    df = spark.createDataFrame(
        [("a", 3), ("a", 2), ("A", 1), (None, 0)], "game_name STRING, bgg_game_id INT"
    )
    got = {tuple(r) for r in dedupe_name(df, "game_name", "bgg_game_id").collect()}
    assert got == {("a", 2), ("A", 1)}


def test_lookup_keeps_rows_and_never_matches_null(spark):
    fact = spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, None), (4, "A"), (5, "z")], "id INT, name STRING"
    )
    # A dimension may hold a NULL key and even the text of a made-up probe.
    probes = fact.select(F.concat(F.lit("no key "), F.xxhash64("id").cast("string")), F.lit(9))
    dim = spark.createDataFrame([("a", 1), (None, 7)], "name STRING, v INT").union(probes)
    got = sorted(tuple(r) for r in lookup(fact, dim, "name", ["v"], spread_by=["id"]).collect())
    assert got == [(1, "a", 1), (2, "a", 1), (3, None, None), (4, "A", None), (5, "z", None)]


def test_lookup_spreads_null_keys(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    fact = spark.range(4000).select("id", F.lit(None).cast("string").alias("name"))
    dim = spark.createDataFrame([("a", 1)], "name STRING, v INT")
    out = lookup(fact, dim, "name", ["v"], spread_by=["id"])
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_lookup_splits_a_hot_key(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    n = 60_000
    fact = spark.range(0, n, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("name")
    )
    dim = spark.range(n).select(F.concat(F.lit("k"), "id").alias("name"), F.col("id").alias("v"))
    dim = dim.union(spark.createDataFrame([("hot", -1)], "name STRING, v BIGINT"))
    out = lookup(fact, dim, "name", ["v"], spread_by=["id"])
    rows = out.select(
        F.count(F.lit(1)), F.count_if(F.col("v") == -1), F.count_if(F.col("v") == F.col("id"))
    )
    assert tuple(rows.collect()[0]) == (n, n // 3, n - n // 3)
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_dense_id_counts_in_order(spark, settings, partitions):
    settings(spark__sql__shuffle__partitions=str(partitions))
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "id INT, grp STRING, at INT, val DOUBLE").repartition(5)
    got = [r.id for r in dense_id(df, ["grp", "at", "id"], "n").orderBy("n").collect()]
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2], r[0]))
    assert got == [r[0] for r in want]


def test_dense_id_of_nothing(spark):
    df = spark.createDataFrame([], "id INT")
    assert dense_id(df, ["id"], "n").collect() == []


@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_previous_in_order_equals_lag(spark, settings, partitions):
    settings(
        spark__sql__shuffle__partitions=str(partitions),
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "id INT, grp STRING, at INT, val DOUBLE").repartition(5)
    got = {
        r.id: r.prev
        for r in previous_in_order(df, ["grp"], ["at", "id"], "val", "prev").collect()
    }
    want = {}
    ordered = sorted(rows, key=lambda r: (r[1] or "", r[2], r[0]))
    for _, members in groupby(ordered, key=lambda r: r[1] or ""):
        before = None
        for r in members:
            want[r[0]], before = before, r[3]
    assert got == want


def test_previous_in_order_spreads_a_hot_group(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(8000).select(
        F.lit("one").alias("grp"), F.col("id").alias("at"), F.col("id").cast("double").alias("val")
    )
    out = previous_in_order(df, ["grp"], ["at"], "val", "prev")
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 8000
    assert out.filter("prev = val - 1").count() == 7999


def test_batch_ids(spark):
    df = spark.createDataFrame([(f"{i:03d}",) for i in range(25)] + [(None,)], "k STRING")
    got = {r.batch: r.ids for r in batch_ids(df, "k", 10).collect()}
    assert {b: len(ids) for b, ids in got.items()} == {0: 10, 1: 10, 2: 5}
    assert sum((got[b] for b in sorted(got)), []) == [f"{i:03d}" for i in range(25)]


def test_describe_matches_spark(spark):
    df = spark.createDataFrame([(1, 2.5, "b"), (3, None, "a"), (5, 0.5, None)], "i INT, d DOUBLE, s STRING")
    got = {(r.column_name, r.stat): r.value for r in profile.describe(df).collect()}
    want = {r["summary"]: r for r in df.describe().collect()}
    for column in ("i", "d", "s"):
        for stat in ("count", "min", "max"):
            assert got[column, stat] == want[stat][column]
    assert float(got["i", "mean"]) == 3.0 and float(got["i", "stddev"]) == 2.0
    assert got["s", "mean"] is None
