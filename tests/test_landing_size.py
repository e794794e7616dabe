"""What the landing writes, shuffles and parses: bounded files, one sort, one parse."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ludomart import schemas as S
from ludomart.catalog import queries as Q
from ludomart.plans import harvest, landing
from ludomart.sources import read_csv_split, read_json_split, read_xml, write_csv, write_json_arrays, write_xml

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def files(path, ending: str) -> list[Path]:
    return [p for p in Path(path).rglob("part-*") if p.name.endswith(ending)]


def test_packed_dumps_are_smaller_and_read_alike(spark, tmp_path):
    rows = Q.fx.raw_reviews(spark, SMALL)
    sizes = {}
    for packed in (False, True):
        path = f"{tmp_path}/json-{packed}"
        write_json_arrays(rows, path, packed=packed)
        back = read_json_split(spark, path, S.ATLAS_REVIEWS)
        assert back.exceptAll(rows).count() == rows.exceptAll(back).count() == 0
        sizes[packed] = sum(p.stat().st_size for p in files(path, ""))
    assert sizes[True] * 3 < sizes[False]
    path = f"{tmp_path}/csv"
    write_csv(rows, path, packed=True)
    back = read_csv_split(spark, path, S.ATLAS_REVIEWS)
    assert back.exceptAll(rows).count() == rows.exceptAll(back).count() == 0


def test_harvest_and_dumps_are_packed(spark, tmp_path):
    payloads = Q.harvest_payloads(spark, SMALL)
    harvest.run(spark, payloads, f"{tmp_path}/raw", "15/01/2023 10:30:00")
    for root in (payloads, f"{tmp_path}/raw", Q.land_dumps(spark, SMALL)):
        assert files(root, "") and len(files(root, ".gz")) == len(files(root, ""))


@pytest.mark.parametrize("rows, chars, sizes", [(2, 1000, [2, 2, 1]), (9, 20, [2, 2, 1]), (9, 1, [1] * 5), (9, 1000, [5])])
def test_json_arrays_end_at_rows_or_characters(spark, tmp_path, rows, chars, sizes):
    # Each object has ten characters, and twelve bytes.
    df = spark.createDataFrame([("éé",)] * 5, "a STRING").coalesce(1)
    write_json_arrays(df, str(tmp_path / "out"), rows, chars_per_file=chars)
    assert sorted((p.read_text().count("{") for p in files(tmp_path, ".txt")), reverse=True) == sizes


def test_xml_documents_are_bounded(spark, tmp_path):
    games = spark.range(12).coalesce(1).select(F.col("id").cast("string").alias("_objectid"))
    write_xml(games, str(tmp_path / "xml"), "boardgame", "boardgames", rows_per_file=5)
    assert len(files(tmp_path, ".gz")) == 3
    back = read_xml(spark, str(tmp_path / "xml"), "boardgame", "_objectid STRING")
    assert sorted(int(r[0]) for r in back.collect()) == list(range(12))


def test_price_payloads_take_one_exchange_of_the_prices(spark):
    payloads = Q.price_payloads(spark, SMALL)
    text = plan(payloads)
    assert text.count("rangepartitioning") == 1 and "HashAggregate" not in text and "ordered-" not in text
    prices = landing.explode_prices(payloads)
    raw = Q.fx.raw_prices(spark, SMALL).select(*prices.columns)
    assert prices.exceptAll(raw).count() == raw.exceptAll(prices).count() == 0
    most = payloads.select(F.regexp_count("payload", F.lit('"id":')).alias("n")).agg(F.max("n")).first()[0]
    assert most == Q.ROWS_PER_TEXT


def test_records_are_parsed_once_under_a_filter(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":"a","rating":"1.5"},{"id":null},{"rating":2},{"id":7x}]')
    rows = read_json_split(spark, str(tmp_path / "a.json"), "id STRING, rating DOUBLE")
    # An object that cannot be read is a row of NULLs.
    assert sorted(map(tuple, rows.collect()), key=str) == [("a", 1.5), (None, 2.0), (None, None), (None, None)]
    kept = rows.dropna(subset=["id", "rating"])
    assert plan(kept).count("from_json(") == 1
    assert [tuple(r) for r in kept.collect()] == [("a", 1.5)]
