import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ludomart import schemas as S
from ludomart.plans import landing
from ludomart.sources import (
    read_csv,
    read_json_arrays,
    read_table,
    read_xml,
    snapshots,
    write_csv,
    write_json_arrays,
    write_table,
)

TRICKY = ['plain', 'a, b', 'He said "hi", ok', 'two\nlines', ' spaced ', "back\\slash", '"', "é"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, t) for i, t in enumerate(TRICKY)] + [(99, None)], "id INT, text STRING"
    )
    write_csv(df, f"{tmp_path}/c")
    assert rows(read_csv(spark, f"{tmp_path}/c", "id INT, text STRING")) == rows(df)


def test_csv_with_doubled_quotes_and_bad_numbers(spark, tmp_path):
    (tmp_path / "g.csv").write_text('id,year,text\n1,1999,"He said ""hi"", ok"\nx,2000,"a\nb"\n')
    got = read_csv(spark, f"{tmp_path}/g.csv", "id INT, year STRING, text STRING")
    assert rows(got) == [(1, "1999", 'He said "hi", ok'), (None, "2000", "a\nb")]


def test_csv_columns_by_header(spark, tmp_path):
    (tmp_path / "l.csv").write_text("name,geeklist,extra\nA,7,x\nB,7.0,y\nC,z,\n")
    got = read_csv(
        spark, f"{tmp_path}/l.csv", "geeklist_id INT, name STRING, year INT", {"geeklist": "geeklist_id"}
    )
    assert rows(got) == [(7, "A", None), (7, "B", None), (None, "C", None)]


def test_csv_of_several_headers_stops(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("id,name,year\n1,A,1999\n")
    (tmp_path / "d" / "b.csv").write_text("year,id,name\n2000,2,B\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, f"{tmp_path}/d", "id INT, name STRING, year INT").collect()


def test_json_numbers_are_read_leniently(spark, tmp_path):
    (tmp_path / "n.json").write_text(
        json.dumps([{"a": "2", "b": 1999.0, "c": "2.5", "d": "true"}, {"a": 7.0, "b": 9007199254740993, "c": 3, "d": False}])
    )
    got = read_json_arrays(spark, f"{tmp_path}/n.json", "a INT, b BIGINT, c DOUBLE, d BOOLEAN")
    assert rows(got) == [(2, 1999, 2.5, True), (7, 9007199254740993, 3.0, False)]


def test_json_folders_come_from_the_data(spark, tmp_path):
    df = spark.createDataFrame([(1, "us"), (2, "au"), (3, None), (4, "us")], "id INT, c STRING")
    write_json_arrays(df, f"{tmp_path}/f", folder="c", chars_per_file=30)
    assert len(list(Path(f"{tmp_path}/f").glob("folder=*"))) == 3
    assert rows(read_json_arrays(spark, f"{tmp_path}/f/*", "id INT, c STRING")) == rows(df)


def test_json_arrays_round_trip_and_file_size(spark, tmp_path):
    df = spark.range(25).select("id", F.array(F.lit("x"), F.lit(None)).alias("tags"))
    write_json_arrays(df.coalesce(2), f"{tmp_path}/j", rows_per_file=5)
    files = list(Path(f"{tmp_path}/j").glob("part-*"))
    sizes = [len(json.loads(f.read_text())) for f in files]
    assert sum(sizes) == 25 and max(sizes) <= 5
    assert rows(read_json_arrays(spark, f"{tmp_path}/j", "id BIGINT, tags ARRAY<STRING>")) == rows(df)


def test_json_objects_arrays_and_missing_fields(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"id": "1", "username": "u"}))
    (tmp_path / "b.json").write_text(json.dumps([{"id": "2", "is_premium": True}, {"id": "3"}], indent=1))
    got = read_json_arrays(spark, f"{tmp_path}/*.json", S.ATLAS_PROFILES).select("id", "username", "is_premium")
    assert rows(got) == [("1", "u", None), ("2", None, True), ("3", None, None)]


def test_table_round_trip_with_null_partition(spark, tmp_path):
    df = spark.createDataFrame([(1, 1999), (2, None), (3, -3500)], "id INT, year INT")
    snapshot = snapshots.begin(spark, str(tmp_path), "t")
    write_table(df, snapshot.path, ["year"])
    snapshots.commit(spark, snapshot, 3)
    assert rows(read_table(spark, str(tmp_path), "t")) == rows(df)
    plan = read_table(spark, str(tmp_path), "t", "id").filter("year = 1999")
    assert "PartitionFilters: [isnotnull(year" in plan._jdf.queryExecution().toString()


def test_write_splits_a_hot_partition_value(spark, settings, tmp_path):
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    )
    df = spark.range(0, 90_000, 1, 8).select("id", F.lit(2000).alias("year"))
    write_table(df, f"{tmp_path}/t", ["year"])
    assert len(list(Path(f"{tmp_path}/t/year=2000").glob("*.parquet"))) > 1
    assert spark.read.parquet(f"{tmp_path}/t").count() == 90_000


GAMES_XML = """<boardgames>
<boardgame objectid="1"><yearpublished>1999</yearpublished><minplayers>2</minplayers>
<maxplayers>4</maxplayers><minplaytime>10</minplaytime><maxplaytime>20</maxplaytime><age>8</age>
<name>Other</name><name primary="true">Main &amp; Co</name>
<boardgameartist>One</boardgameartist>
<boardgamecategory>A</boardgamecategory><boardgamecategory>B</boardgamecategory>
<statistics><ratings><usersrated>7</usersrated><average>6.5</average></ratings></statistics>
</boardgame>
<boardgame><name>No id</name></boardgame>
<boardgame objectid="2"><name>Only</name><maxplayers>many</maxplayers></boardgame>
</boardgames>"""


def test_xml_games(spark, tmp_path):
    (tmp_path / "g.xml").write_text(GAMES_XML)
    games = landing.xml_games(read_xml(spark, f"{tmp_path}/g.xml", "boardgame", S.XML_GAME))
    got = {r.bgg_id: r for r in games.collect()}
    assert set(got) == {1, 2}
    first = got[1]
    assert (first.name, first.artist, first.category, first.designer) == ("Main & Co", "One", "A,B", "")
    assert (first.maxplayers, first.users_rated, first.average_rating) == (4, 7, 6.5)
    assert (got[2].name, got[2].maxplayers, got[2].average_rating) == ("Only", None, None)


def test_xml_list_items(spark):
    text = """<geeklist id="7"><title>best</title>
      <item subtype="boardgame" objectid="1" objectname="A" username="u" postdate="Thu, 01 Dec 2022 00:00:00 +0000"><body>x
y</body></item><item><body>no attributes</body></item></geeklist>"""
    lone = '<geeklist id="8"><title>none</title></geeklist>'
    docs = spark.createDataFrame([(text,), (lone,)], "value STRING")
    got = [tuple(r) for r in landing.xml_list_items(docs).collect()]
    assert got == [
        ("7", "boardgame", "1", "A", "u", "Thu, 01 Dec 2022 00:00:00 +0000", "x\ny")
    ]


def test_explode_prices(spark):
    payload = json.dumps({"us": [{"id": "1", "price": 2.5}, {"id": "2"}], "uk": [], "used": None})
    docs = spark.createDataFrame([(payload,), ("{}",), (None,)], "payload STRING")
    got = rows(landing.explode_prices(docs).select("id", "price", "price_category"))
    assert got == [("1", 2.5, "us"), ("2", None, "us")]


def test_compact_json_by_file_letter(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for stem, ids in {"a1": ["1", "2"], "a2": ["3"], "B1": ["4"], "+p": ["5"], "x y": ["6"], "%z": ["7"], "éa": ["8"]}.items():
        (source / f"{stem}.json").write_text(json.dumps([{"id": i} for i in ids]))
    landing.compact_json(spark, f"{source}/*.json", f"{tmp_path}/out", "id STRING")
    got = spark.read.schema("id STRING, letter STRING").json(f"{tmp_path}/out")
    assert rows(got) == [("1", "a"), ("2", "a"), ("3", "a"), ("4", "B"), ("5", "+"), ("6", "x"), ("7", "%"), ("8", "é")]


def test_count_json_records(spark, tmp_path):
    for path, n in {"users/a.json": 2, "reviews/x/b.json": 3, "reviews/c.json": 1}.items():
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(json.dumps([{"id": str(i)} for i in range(n)]))
    assert rows(landing.count_json_records(spark, str(tmp_path))) == [("reviews", 4), ("users", 2)]


def test_latest_user_profile(spark):
    raw = spark.createDataFrame(
        [
            ("r1", None, "2020-01-01T00:00:00.000Z", ("u", "old", True, None, None), ("g",), 1.0, None),
            ("r2", None, "2021-01-01T00:00:00.000Z", ("u", "tie", True, None, None), ("g",), 1.0, None),
            ("r3", None, "2021-01-01T00:00:00.000Z", ("u", "new", True, None, None), ("g",), 1.0, None),
            ("r4", None, "never", ("u", "bad", True, None, None), ("g",), 1.0, None),
            ("r5", None, None, ("v", "undated", True, None, None), ("g",), 1.0, None),
            ("r6", None, None, None, None, 1.0, None),
        ],
        S.ATLAS_RAW_REVIEWS,
    )
    got = rows(landing.latest_user_profile(raw).select("id", "username"))
    assert got == [("u", "new"), ("v", "undated")]
    split = rows(landing.split_reviews(raw).select("id", "user_id", "game_id"))
    assert split[0] == ("r1", "u", "g") and split[-1] == ("r6", None, None)


def test_truncation_audit(spark):
    users = spark.createDataFrame([("u",), ("v",)], "username STRING")
    reviews = spark.createDataFrame([("u", 4.25)] * 3 + [(None, 4.25)], "username STRING, rating DOUBLE")
    got = landing.truncation_audit(users, reviews, limit=2)
    assert got.count() == 42
    assert rows(got.filter("n_reviews > 0")) == [("u", 4.25, 3, True)]
    assert landing.truncation_audit(users, reviews).filter("truncated").count() == 0


def test_new_ids(spark):
    wanted = spark.createDataFrame([("a",), ("b",)], "game_id STRING")
    landed = spark.createDataFrame([("a",), (None,)], "game_id STRING")
    assert rows(landing.new_ids(wanted, landed, "game_id")) == [("b",)]
