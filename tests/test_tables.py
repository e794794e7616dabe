from datetime import datetime

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ludomart import schemas as S
from ludomart.operators import quality
from ludomart.plans import dims, facts, insights, pipeline
from ludomart.session import workspace
from ludomart.sources import read_table, write_csv, write_json_arrays
from ludomart.streaming import incremental_reviews


def frame(spark, schema, *records):
    return spark.createDataFrame([dict(r) for r in records], schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def raw(spark):
    def bgg(i, name, year="1999", at="01/01/2023 00:00:00", rating=5.0):
        return {"bgg_id": i, "name": name, "year_published": year, "datetime_extracted": at,
                "average_rating": rating}

    def atlas(i, name, at="01/01/2023 00:00:00", publisher="P", artists=("x", "y")):
        return {"id": i, "name": name, "datetime_extracted": at, "year_published": 2000,
                "primary_publisher": publisher and {"name": publisher}, "artists": artists}

    def review(i, user, game, at="2020-01-01T10:00:00.000Z", rating=4.0):
        return {"id": i, "createdAt": at, "user_id": user, "game_id": game, "rating": rating}

    def price(i, name, at="2021-02-01T00:00:00.000Z", category="us", value=10.0, store="s"):
        return {"id": i, "updated_at": at, "name": name, "price": value, "currency": "USD",
                "store_name": store, "price_category": category}

    def item(geeklist, game, name, at="Tue, 03 Jan 2023 00:00:00 +0000", user="u"):
        return {"geeklist_id": geeklist, "game_id": game, "name": name, "postdate": at, "user": user,
                "objtype": "thing", "bodytext": "a\nb"}

    return {
        "bgg": frame(
            spark, S.BGG_GAMES,
            bgg(1, "Catan", "1995.0"), bgg(1, "Catan old", at="01/01/2022 00:00:00"),
            bgg(1, "Catan bad", at="soon"), bgg(2, "Catan", "abc"), bgg(3, "catan"),
            bgg(4, None, None), bgg(None, "no id"),
        ),
        "atlas": frame(
            spark, S.ATLAS_GAMES,
            atlas("g1", "Catan"), atlas("g1", "Catan", at="01/01/2022 00:00:00", publisher="old"),
            atlas("g2", "Catan", publisher=None, artists=None), atlas("g3", "Other", artists=("z", None)),
            atlas("g4", None), atlas(None, "no id"),
        ),
        "accounts": frame(
            spark, S.ATLAS_USERS,
            {"username": "ann", "experience": 5, "level": 1}, {"username": "ann", "experience": 9, "level": 2},
            {"username": "bob", "level": 1}, {"username": "cy"}, {"username": None, "level": 3},
        ),
        "profiles": frame(
            spark, S.ATLAS_PROFILES,
            {"id": "u1", "username": "ann", "is_premium": True}, {"id": "u2", "username": "ann"},
            {"id": "u3", "username": "bob"}, {"id": "u3", "username": "bob"}, {"id": "u9", "username": None},
            {"id": None, "username": "cy"},
        ),
        "reviews": frame(
            spark, S.ATLAS_REVIEWS,
            review("r1", "u1", "g1"), review("r1", "u1", "g1", at=None),
            review("r1", "u1", "g1", at="2019-01-01T10:00:00.000Z"), review("r2", "u2", None),
            review("r3", None, "g4"), review("r4", "zz", "gone"), review(None, "u1", "g1"),
            review("r5", "u3", "g2", at="2020-02-01T10:00:00.500Z", rating=2.0),
            review("r6", "u3", "g3", at=None),
        ),
        "prices": frame(
            spark, S.ATLAS_PRICES,
            price("p1", "Catan"), price("p1", "Catan", category="uk"),
            price("p1", "Catan", at="2021-01-31T00:00:00.000Z", category="au"),
            price("p2", "Catan", at="2021-03-01T00:00:00.000Z", value=8.0),
            price("p3", "Brand New Catan (2nd ed.)"), price("p4", None), price("p5", "x", at=None),
        ),
        "lists": frame(
            spark, S.BGG_LISTS,
            item("7", "1", "Catan", at="Tue, 03 Jan 2023 23:00:00 -0500"), item("7", "1", "Catan"),
            item("7", "1", "Catan"), item("x", "1", "Catan"), item("8", "2.0", None), item("9", "3", "Other", at="?"),
        ),
    }


@pytest.fixture(scope="module")
def star(spark, raw):
    bgg, atlas = dims.bgg_details(raw["bgg"]), dims.atlas_details(raw["atlas"])
    users = dims.atlas_users(raw["accounts"], raw["profiles"])
    return {
        "bgg_games": bgg,
        "atlas_games": atlas,
        "users": users,
        "reviews": facts.reviews(raw["reviews"], atlas, bgg, users),
        "prices": facts.prices(raw["prices"], atlas, bgg),
        "lists": facts.lists(raw["lists"], atlas),
    }


def test_columns(star):
    for table, df in star.items():
        assert df.columns == S.TABLES[table], table


def test_bgg_details(star):
    got = rows(star["bgg_games"].select("bgg_game_id", "game_name", "year_published"))
    assert got == [(1, "Catan", 1995), (2, "Catan", None), (3, "catan", 1999), (4, None, None)]


def test_atlas_details(star):
    got = rows(star["atlas_games"].select("atlas_game_id", "game_name", "primary_publisher", "artists"))
    assert got == [
        ("g1", "Catan", "P", "x,y"), ("g2", "Catan", None, ""), ("g3", "Other", "P", "z"),
        ("g4", None, "P", "x,y"),
    ]


def test_users(star):
    got = rows(star["users"].select("user_id", "user_name", "atlas_user_id", "atlas_level", "atlas_premium"))
    assert got == [
        (0, "ann", "u1", 2, True), (1, "ann", "u2", 2, None), (2, "bob", "u3", 1, None),
        (3, "cy", None, None, None),
    ]


def test_reviews(star):
    got = rows(star["reviews"].select("review_id", "review_datetime", "game_name", "atlas_game_id",
                                      "bgg_game_id", "user_id", "year", "month"))
    at = datetime(2020, 1, 1, 10)
    assert got == [
        ("r1", at, "Catan", "g1", 1, 0, 2020, 1),
        ("r2", at, None, None, None, 1, 2020, 1),
        ("r3", at, None, "g4", None, None, 2020, 1),
        ("r4", at, None, "gone", None, None, 2020, 1),
        ("r5", datetime(2020, 2, 1, 10, 0, 0, 500000), "Catan", "g2", 1, 2, 2020, 2),
    ]


def test_prices(star):
    got = rows(star["prices"].select("atlas_price_id", "price_category", "month", "atlas_game_id", "bgg_game_id"))
    assert got == [
        ("p1", "uk", 2, "g1", 1), ("p2", "us", 3, "g1", 1), ("p3", "us", 2, None, None),
        ("p4", "us", 2, None, None),
    ]


def test_lists(star):
    got = rows(star["lists"].select("list_item_id", "geeklist_id", "bgg_game_id", "post_datetime", "atlas_game_id"))
    early, late = datetime(2023, 1, 3), datetime(2023, 1, 4, 4)
    assert got == [(0, 7, 1, early, "g1"), (1, 7, 1, early, "g1"), (2, 7, 1, late, "g1"), (3, 8, 2, early, None)]


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_facts_are_the_same_on_any_layout(raw, star, settings, partitions):
    settings(spark__sql__shuffle__partitions=str(partitions))

    def mixed(df):
        return df.orderBy(F.rand(partitions)).repartition(partitions)

    bgg, atlas = dims.bgg_details(mixed(raw["bgg"])), dims.atlas_details(mixed(raw["atlas"]))
    users = dims.atlas_users(mixed(raw["accounts"]), mixed(raw["profiles"]))
    assert rows(facts.reviews(mixed(raw["reviews"]), atlas, bgg, users)) == rows(star["reviews"])
    assert rows(facts.prices(mixed(raw["prices"]), atlas, bgg)) == rows(star["prices"])
    assert rows(facts.lists(mixed(raw["lists"]), atlas)) == rows(star["lists"])


def test_lookups_without_broadcast(raw, star, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"
    )
    again = facts.reviews(raw["reviews"], star["atlas_games"], star["bgg_games"], star["users"])
    assert rows(again) == rows(star["reviews"])


def test_lists_take_either_name_of_the_list_id(raw):
    renamed = raw["lists"].withColumnRenamed("geeklist_id", "geeklist")
    assert facts.lists_parsed(renamed).count() == facts.lists_parsed(raw["lists"]).count() == 4


def test_every_fact_time_is_in_the_time_table(star):
    stamps = [star["reviews"].select("review_datetime"), star["prices"].select("price_datetime"),
              star["lists"].select("post_datetime")]
    time = dims.time(*stamps)
    assert time.columns == S.TABLES["time"]
    assert time.count() == time.select("datetime").distinct().count() == 6
    for s in stamps:
        assert s.toDF("datetime").join(time, "datetime", "left_anti").count() == 0


def test_quality_report_and_gate(star):
    report = quality.check(star["prices"], quality.TABLE_RULES["prices"])
    got = {(r.check_name, r.column_name): (r.severity, r.passed, r.observed) for r in report.collect()}
    assert got["has_rows", None] == ("error", True, 4)
    assert got["not_null", "atlas_price_id"] == ("error", True, 0)
    assert got["not_null", "atlas_game_id"] == ("warn", False, 2)
    assert quality.gate(report) == 4
    assert quality.summary(report).first().gate_open


@pytest.mark.parametrize("broken", ["rows", "columns", "null"])
def test_gate_stops(star, broken):
    df = {
        "rows": star["prices"].limit(0),
        "columns": star["prices"].drop("url"),
        "null": star["prices"].withColumn("price_datetime", F.lit(None).cast("timestamp")),
    }[broken]
    with pytest.raises(quality.QualityError):
        quality.gate(quality.check(df, quality.TABLE_RULES["prices"]))


def test_quality_check_reads_once(star):
    report = quality.check(star["bgg_games"], quality.TABLE_RULES["bgg_games"])
    text = report._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") + text.count("LocalRelation") == 1


def test_failed_gate_keeps_the_published_table(spark, star, tmp_path):
    pipeline.build(spark, "bgg_games", star["bgg_games"], str(tmp_path))
    with pytest.raises(quality.QualityError):
        pipeline.build(spark, "bgg_games", star["bgg_games"].limit(0), str(tmp_path))
    assert read_table(spark, str(tmp_path), "bgg_games").count() == 4


def test_gate_stops_other_columns_and_repeated_keys(spark, star, tmp_path):
    with pytest.raises(quality.QualityError, match="surplus"):
        pipeline.build(spark, "bgg_games", star["bgg_games"].withColumn("surplus", F.lit(1)), str(tmp_path))
    with pytest.raises(quality.QualityError, match="repeats"):
        pipeline.build(spark, "bgg_games", star["bgg_games"].union(star["bgg_games"]), str(tmp_path))


def test_pipeline_and_audit(spark, raw, tmp_path):
    src, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    write_csv(raw["bgg"], f"{src}/bgg/games.csv")
    write_csv(raw["lists"], f"{src}/bgg/lists.csv")
    write_json_arrays(raw["accounts"], f"{src}/atlas/json_user.json")
    write_json_arrays(raw["profiles"], f"{src}/atlas/users")
    write_json_arrays(raw["atlas"], f"{src}/atlas/games")
    write_json_arrays(raw["reviews"], f"{src}/atlas/reviews")
    write_json_arrays(raw["prices"], f"{src}/atlas/prices", folder="price_category")
    want = {"bgg_games": 4, "users": 4, "atlas_games": 4, "reviews": 5, "prices": 4, "lists": 4, "time": 6}
    assert pipeline.run(spark, src, out) == want
    assert pipeline.run(spark, src, out) == want
    assert pipeline.audit(spark, out).filter("NOT passed AND severity = 'error'").count() == 0


def test_questions(star):
    trend = rows(insights.popularity_trend(star["reviews"]))
    assert trend == [("Catan", 2020, 1, 1, 4.0), ("Catan", 2020, 2, 1, 2.0)]
    changes = rows(insights.price_changes(star["prices"]).select("atlas_price_id", "prev_price", "price_diff"))
    assert changes == [("p1", None, None), ("p2", 10.0, -2.0)]
    best = rows(insights.best_price_ever(star["prices"]).select("bgg_game_id", "price", "atlas_price_id"))
    assert best == [(1, 8.0, "p2")]
    card = rows(insights.game_scorecard(star["reviews"], star["lists"], star["prices"]))
    assert card == [(1, 2, 3.0, 3, "USD", 8.0), (2, None, None, 1, None, None)]
    other = star["prices"].withColumns({"currency": F.lit("AUD"), "price": F.col("price") + 1})
    both = star["prices"].union(other)
    card = rows(insights.game_scorecard(star["reviews"], star["lists"], both).filter("bgg_game_id = 1"))
    assert card == [(1, 2, 3.0, 3, "AUD", 9.0), (1, 2, 3.0, 3, "USD", 8.0)]
    diffs = {r.price_diff for r in insights.price_changes(both).collect()}
    assert diffs == {None, -2.0}
    trending = rows(insights.trending_lists(star["lists"], days=1))
    assert trending == [(1, 1, 2, -1), (2, 0, 1, -1)]
    high = rows(insights.high_rater_profile(star["reviews"], star["users"]))
    assert high == [(1, None, 1, 1, 0.0), (2, None, 1, 1, 1.0), (2, True, 1, 1, 1.0), (None, None, 2, 0, 1.0)]
    top = rows(insights.top_recent_games(star["reviews"], star["atlas_games"], star["bgg_games"], k=1))
    assert [r[:5] for r in top] == [("g1", "Catan", 1, 1, 4.0)]
    both = rows(insights.compare_sources(star["atlas_games"], star["bgg_games"]).select("atlas_game_id", "bgg_game_id"))
    assert both == [("g1", 1), ("g2", 1)]


def test_name_matching(spark, star):
    clean = rows(insights.match_clean_names(star["prices"], star["bgg_games"]).select("atlas_price_id", "bgg_game_id"))
    assert clean == [("p1", 1), ("p2", 1), ("p3", 1), ("p4", None)]
    signs = spark.createDataFrame([(5, "!!"), (6, "Sealed")], "bgg_game_id INT, game_name STRING")
    listing = spark.createDataFrame([("x", "Brand New & Sealed")], "atlas_price_id STRING, game_name STRING")
    assert [r.bgg_game_id for r in insights.match_clean_names(listing, signs).collect()] == [None]
    games = spark.createDataFrame(
        [(5, "Red Sea"), (6, "Red"), (7, "Sea of Red Stars"), (8, "Stars"), (9, "red sea"), (10, "!")],
        "bgg_game_id INT, game_name STRING",
    )
    listed = spark.createDataFrame(
        [("a", "The Red Sea, sealed"), ("b", "a sea of red stars now"), ("c", "redsea"), ("d", None), ("e", "&")],
        "atlas_price_id STRING, game_name STRING",
    )
    got = rows(insights.match_contained_names(listed, games).select("atlas_price_id", "bgg_game_id"))
    assert got == [("a", 5), ("b", 7), ("c", None), ("d", None), ("e", None)]


def test_incremental_reviews_equal_the_batch(spark, raw, star):
    source, target = workspace(spark, "drops"), workspace(spark, "reviews")
    checkpoint = workspace(spark, "stream")
    dimensions = (star["atlas_games"], star["bgg_games"], star["users"])
    # Copies of r1 differ in date; keep the one the batch keeps.
    reviews = raw["reviews"].filter("createdAt IS NULL OR createdAt NOT LIKE '2019%'")
    for n, part in enumerate((reviews.filter("id < 'r4'"), reviews, reviews.limit(0))):
        write_json_arrays(part, f"{source}/{n}", rows_per_file=2)
        incremental_reviews(spark, f"{source}/*", target, checkpoint, *dimensions, files_per_batch=2)
    got = spark.read.parquet(target).select(*S.TABLES["reviews"])
    assert rows(got) == rows(star["reviews"])
    # Reviews without a readable date are kept apart, as they came.
    undated = {r.id for r in reviews.filter("id IS NOT NULL AND createdAt IS NULL").collect()}
    assert {r.id for r in spark.read.json(f"{target}_rejects/*").collect()} == undated == {"r1", "r6"}
    # Nothing is lost or doubled when the stream forgets what it has seen, or when the table
    # has no marker file.
    for marker in Path(target.removeprefix("file:")).glob("_SUCCESS"):
        marker.unlink()
    incremental_reviews(spark, f"{source}/*", target, workspace(spark, "stream"), *dimensions)
    assert spark.read.parquet(target).count() == 5
