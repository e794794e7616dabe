"""Versioned publishing: readers see one snapshot whole, killed runs leave no trace for them."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ludomart.operators.quality import QualityError
from ludomart.plans import pipeline
from ludomart.sources import read_table, snapshots, write_table


def publish(spark, root, n, keep=2):
    snapshot = snapshots.begin(spark, root, "t")
    rows = spark.range(n * 10).select("id", F.lit(n).alias("n"))
    seen = write_table(rows, snapshot.path, ["n"], [F.count(F.lit(1)).alias("rows"), F.max("id").alias("top")])
    assert seen == {"rows": n * 10, "top": n * 10 - 1}
    snapshots.commit(spark, snapshot, seen["rows"], keep)
    return snapshot


def test_readers_find_the_newest_and_keep_what_they_found(spark, tmp_path):
    root = f"{tmp_path}/mart"
    with pytest.raises(FileNotFoundError):
        read_table(spark, root, "t")
    publish(spark, root, 1)
    first = read_table(spark, root, "t", "id")
    assert first.columns == ["id"] and first.count() == 10
    publish(spark, root, 2)
    assert first.count() == 10  # resolved before, read after
    assert read_table(spark, root, "t").groupBy("n").count().collect() == [(2, 20)]
    names = sorted(n.name for n in (tmp_path / "mart" / "t").iterdir())
    assert names == [n.snapshot for n in snapshots.history(spark, root, "t") if n.state == "published"]


def test_a_killed_run_is_harmless_and_its_rest_goes(spark, tmp_path):
    root = f"{tmp_path}/mart"
    publish(spark, root, 1)
    killed = snapshots.begin(spark, root, "t")
    assert read_table(spark, root, "t").count() == 10  # before it has written
    spark.range(999).write.parquet(killed.path)
    assert read_table(spark, root, "t").count() == 10  # and after
    publish(spark, root, 2)
    assert read_table(spark, root, "t").count() == 20
    assert spark.read.parquet(killed.path).count() == 0
    assert killed.name in {n.snapshot for n in snapshots.history(spark, root, "t") if n.state == "expired"}


def test_old_snapshots_expire_once(spark, tmp_path):
    root = f"{tmp_path}/mart"
    made = [publish(spark, root, n) for n in (1, 2, 3)]
    assert [spark.read.parquet(s.path).count() for s in made] == [0, 20, 30]
    assert snapshots.expire(spark, root, "t") == []
    assert snapshots.expire(spark, root, "t", keep=1) == [made[1].name]
    assert read_table(spark, root, "t").count() == 30
    assert [n.n_rows for n in snapshots.history(spark, root, "t") if n.state == "published"] == [10, 20, 30]


def test_readers_during_publishing_see_whole_tables(spark, tmp_path):
    root = f"{tmp_path}/mart"
    publish(spark, root, 1, keep=9)

    def read():
        return [read_table(spark, root, "t").agg(F.count(F.lit(1)), F.max("n"), F.min("n")).first() for _ in range(6)]

    with ThreadPoolExecutor(3) as pool:
        readers = [pool.submit(read) for _ in range(2)]
        for n in (2, 3, 4):
            publish(spark, root, n, keep=9)
        for count, top, low in (row for r in readers for row in r.result()):
            assert top == low and count == top * 10


def test_a_failed_gate_keeps_the_old_table(spark, tmp_path):
    root = str(tmp_path)
    time = spark.sql(
        "SELECT timestamp'2020-01-02 03:04:05' AS datetime, 4 AS minute, 3 AS hour, 2 AS day, 1 AS week, 1 AS month,"
        " 2020 AS year, 5 AS weekday"
    )
    assert pipeline.build(spark, "time", time, root) == 1
    for bad in (time.limit(0), time.union(time), time.withColumn("datetime", F.lit(None).cast("timestamp"))):
        with pytest.raises(QualityError):
            pipeline.build(spark, "time", bad, root)
    assert read_table(spark, root, "time").count() == 1
    assert sum(n.state == "expired" for n in snapshots.history(spark, root, "time")) == 3


def test_tables_are_built_in_order_of_what_they_read():
    assert pipeline.stages(pipeline.DEPENDS) == [
        ["bgg_games", "users", "atlas_games"],
        ["reviews", "prices", "lists"],
        ["time"],
    ]
    assert pipeline.stages(["time", "users"]) == [["users", "time"]]
    assert pipeline.stages(["time", "prices"]) == [["prices"], ["time"]]
    assert pipeline.downstream(["lists"]) == ["lists", "time"]
    assert pipeline.downstream(["atlas_games"]) == ["atlas_games", "reviews", "prices", "lists", "time"]
    with pytest.raises(ValueError, match="nothing"):
        pipeline.stages(["nothing"])
