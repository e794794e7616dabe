"""Readers by ranges against the readers that take a file whole."""

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from ludomart import schemas as S
from ludomart.sources import read_csv, read_csv_split, read_json_arrays, read_json_split, write_csv

CELLS = [
    "plain", "", "a, b", 'He said "hi", ok', "two\nlines", "\n", '"', '""', ',"\n",', "\r\n", " spaced ", "back\\slash", "é\n日本",
    "long " * 60, "many\nlines\n" * 25, '",\n"' * 20,
]
SCHEMA = "id INT, text STRING, n DOUBLE"


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()), key=str)


def plain(df):
    return df.withColumn("text", F.replace("text", F.lit("\r\n"), F.lit("\n")))


@pytest.fixture(params=[40, 333, 1 << 20])
def ranges(request, settings):
    settings(
        spark__sql__files__maxPartitionBytes=str(request.param),
        spark__sql__files__openCostInBytes="0",
        spark__sql__files__minPartitionNum="1",
    )
    return request.param


def csv_text(rnd, n, end="\n", quote_all=False):
    def cell(v):
        v = str(v)
        return '"' + v.replace('"', '""') + '"' if quote_all or set(v) & set(',"\r\n') else v

    lines = ["id,text,n", *(",".join(map(cell, (i, rnd.choice(CELLS), rnd.choice([1.5, "", "x"])))) for i in range(n))]
    return end.join(lines) + rnd.choice(["", end, end + end])


def test_one_csv_file_by_ranges(spark, ranges, tmp_path):
    rnd = random.Random(ranges)
    for i, (end, quote_all) in enumerate([("\n", True), ("\n", False), ("\r\n", False)]):
        path = tmp_path / f"{i}.csv"
        path.write_bytes(csv_text(rnd, 40, end, quote_all).encode())
        got = read_csv_split(spark, str(path), SCHEMA)
        with open(path, newline="") as file:
            cells = [r for r in csv.reader(file) if r][1:]
        # The whole-file reader turns a carriage return and newline in quotes to a newline, if
        # records end so; this one keeps them.
        want = sorted((int(i), t or None, 1.5 if n == "1.5" else None) for i, t, n in cells)
        assert sorted((r.id, r.text or None, r.n) for r in got.collect()) == want
        whole = read_csv(spark, str(path), SCHEMA)
        assert rows(plain(got)) == rows(plain(whole))
        if ranges < 100:
            assert got.rdd.getNumPartitions() > 20


def test_csv_folder_of_spark_files_and_aliases(spark, ranges, tmp_path):
    df = spark.createDataFrame([(i, c, float(i)) for i, c in enumerate(CELLS * 3)], SCHEMA).repartition(3)
    write_csv(df, f"{tmp_path}/c", rows_per_file=9)
    assert rows(read_csv_split(spark, f"{tmp_path}/c", SCHEMA)) == rows(read_csv(spark, f"{tmp_path}/c", SCHEMA))
    (tmp_path / "l.csv").write_text('\n\nname,geeklist,extra\nA,7,x\n\nB,7.0,"y\n"\nC,z,\n')
    args = (str(tmp_path / "l.csv"), "geeklist_id INT, name STRING, year INT", {"geeklist": "geeklist_id"})
    assert rows(read_csv_split(spark, *args)) == rows(read_csv(spark, *args)) != []


def test_csv_that_cannot_be_cut_stops(spark, ranges, tmp_path):
    (tmp_path / "q.csv").write_text('id,text\n1,"open\n2,b\n' + "3,c\n" * 20)
    with pytest.raises(Exception, match=r"q\.csv do not pair"):
        read_csv_split(spark, f"{tmp_path}/q.csv", "id INT, text STRING").collect()
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("id,name,year\n1,A,1999\n")
    (tmp_path / "d" / "b.csv").write_text("year,id,name\n2000,2,B\n")
    with pytest.raises(Exception, match="another header in .*[ab].csv"):
        read_csv_split(spark, f"{tmp_path}/d", "id INT, name STRING, year INT").collect()


def test_other_ranges_than_planned_stop(spark, settings, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,n\n" + '1,"a\nb",2\n' * 50)
    settings(spark__sql__files__openCostInBytes="0", spark__sql__files__minPartitionNum="1", spark__sql__files__maxPartitionBytes="100")
    df = read_csv_split(spark, f"{tmp_path}/a.csv", SCHEMA)
    settings(spark__sql__files__maxPartitionBytes="70")
    with pytest.raises(Exception, match="read it again"):
        df.collect()


TEXTS = ["", "}", "{", '"', "]}", "\\", '\\"', '\\\\"}', "[{", "},{", "\n\t", "é日本 ", "a" * 200, '{"a": [1]}' * 15, "\\" * 7 + '"}']
OBJECT = "id INT, text STRING, sub STRUCT<name: STRING, of: STRUCT<x: INT>>, list ARRAY<STRING>, prices MAP<STRING, DOUBLE>"


def objects(rnd, n):
    for i in range(n):
        one = {"id": i, "text": rnd.choice(TEXTS)}
        if rnd.random() < 0.6:
            one["sub"] = {"name": rnd.choice(TEXTS), "of": {"x": i}}
        if rnd.random() < 0.5:
            one["list"] = rnd.sample(TEXTS, 3)
        if rnd.random() < 0.5:
            one["prices"] = {rnd.choice(TEXTS): 1.5}
        yield one


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("ascii_", [True, False])
def test_one_json_array_by_ranges(spark, ranges, tmp_path, indent, ascii_):
    rnd = random.Random(ranges)
    path = tmp_path / "a.json"
    path.write_text(json.dumps(list(objects(rnd, 40)), indent=indent, ensure_ascii=ascii_) + rnd.choice(["", "\n", "  \n\n"]))
    got = read_json_split(spark, str(path), OBJECT)
    assert rows(got) == rows(read_json_arrays(spark, str(path), OBJECT))
    assert got.count() == 40
    if ranges < 100:
        assert got.rdd.getNumPartitions() > 20


def test_json_files_of_each_shape(spark, ranges, tmp_path):
    rnd = random.Random(7)
    one, *rest = objects(rnd, 12)
    texts = {
        "array": json.dumps(rest), "empty": "[]", "spaces": "  [\n ] ", "object": json.dumps(one), "object_line": json.dumps(one) + "\n",
        "lines": "\n".join(json.dumps(o) for o in rest), "bom": "﻿" + json.dumps(rest),
    }
    want = {"array": 11, "object": 1, "object_line": 1, "lines": 11, "bom": 11}
    (tmp_path / "d" / "deep").mkdir(parents=True)
    for name, text in texts.items():
        (tmp_path / "d" / "deep" / f"{name}.json").write_text(text)
    got = read_json_split(spark, f"{tmp_path}/d", OBJECT, recursive=True, file="from")
    count = {r["from"].split("/")[-1][:-5]: r["count"] for r in got.groupBy("from").count().collect()}
    assert count == want
    both = [json.dumps(o, sort_keys=True) for o in [*rest * 3, one, one]]
    ids = sorted(r.id for r in got.collect())
    assert ids == sorted(json.loads(o)["id"] for o in both)


def test_json_scalars_are_lenient_and_bad_objects_null(spark, tmp_path):
    (tmp_path / "n.json").write_text('[{"a": "2", "b": 1999.0}, {"a": 7.0, "b": "x"}, {"a": tru, "b": 1}, {"c": 1}]')
    got = read_json_split(spark, f"{tmp_path}/n.json", "a INT, b BIGINT")
    assert rows(got) == sorted([("2", "1999"), ("7", "None"), ("None", "None"), ("None", "None")])


def test_the_dump_schemas(spark, ranges, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"id": str(i), "rating": "2.5", "description": "}\n{"} for i in range(30)]))
    got = read_json_split(spark, f"{tmp_path}/r.json", S.ATLAS_REVIEWS)
    assert rows(got) == rows(read_json_arrays(spark, f"{tmp_path}/r.json", S.ATLAS_REVIEWS))
