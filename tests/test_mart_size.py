"""What a run of the mart leaves on the disk, and how often its facts are shuffled."""

from __future__ import annotations

from pathlib import Path

import pytest

from ludomart import schemas as S
from ludomart.catalog import queries as Q
from ludomart.plans import facts, pipeline
from ludomart.session import SHUFFLE_CLEANUP, freeing_shuffles
from ludomart.sources import read_json_split, read_table, write_json_arrays

SMALL = "/root/testdata/sf0.001"


def shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    files = blocks.diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if "/shuffle_" in f}


def test_landing_and_pipeline_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    raw = Q.land_dumps(spark, SMALL)
    assert shuffle_files(spark) <= before
    rows = pipeline.run(spark, raw, f"{tmp_path}/mart")
    assert all(rows.values()) and shuffle_files(spark) <= before


def test_the_sessions_own_choice_holds_again(spark, settings):
    settings(**{SHUFFLE_CLEANUP: "false"})
    with pytest.raises(ZeroDivisionError), freeing_shuffles(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        1 / 0
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_files_of_many_ranges_are_read_alike_while_shuffles_are_freed(spark, tmp_path, settings):
    # Pass one over the ranges and the records across their borders are shuffled.
    rows = Q.fx.raw_reviews(spark, SMALL)
    write_json_arrays(rows, str(tmp_path / "json"))
    settings(spark__sql__files__maxPartitionBytes="20000")
    with freeing_shuffles(spark):
        back = read_json_split(spark, str(tmp_path / "json"), S.ATLAS_REVIEWS)
        assert back.rdd.getNumPartitions() > 8
        for _ in range(2):
            assert back.exceptAll(rows).count() == rows.exceptAll(back).count() == 0
            assert back.count() == rows.count()


def lookups_of(df, key: str) -> int:
    """Exchanges for a lookup that ship rows with the column ``key``."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return sum("hashpartitioning(_probe" in a and f"{key}#" in b for a, b in zip(lines, lines[1:], strict=False))


def test_facts_meet_the_names_once(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    assert lookups_of(Q.prices(spark, SMALL), "atlas_price_id") == 1
    assert lookups_of(Q.reviews(spark, SMALL), "review_id") == 2  # by game and by user


def test_ids_by_name_hold_the_names_of_either_source(spark):
    games = spark.createDataFrame([("a", "G2"), ("a", "G1"), ("b", "G3"), (None, "G4")], "game_name STRING, atlas_game_id STRING")
    bgg = spark.createDataFrame([("a", 2), ("c", 5), ("c", 4), (None, 1)], "game_name STRING, bgg_game_id INT")
    found = sorted(map(tuple, facts.ids_by_name(games, bgg).select("game_name", "atlas_game_id", "bgg_game_id").collect()))
    assert found == [("a", "G1", 2), ("b", "G3", None), ("c", None, 4)]


def test_prices_pass_a_working_table_that_is_emptied(spark, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("prices-step-*"))
    pipeline.run(spark, Q.land_dumps(spark, SMALL), f"{tmp_path}/mart")
    steps = set(shared.glob("prices-step-*")) - before
    assert len(steps) == 2 and not any(spark.read.parquet(str(p)).count() for p in steps)
    made, want = read_table(spark, f"{tmp_path}/mart", "prices").select(*S.TABLES["prices"]), Q.prices(spark, SMALL)
    assert made.exceptAll(want).count() == want.exceptAll(made).count() == 0
