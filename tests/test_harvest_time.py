"""What the harvest reads twice, how full its files are, and what it leaves behind."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ludomart.catalog import queries as Q
from ludomart.plans import harvest
from ludomart.sources import read_json_split, split, write_json_arrays

SMALL = "/root/testdata/sf0.001"


def test_pass_one_opens_no_file_of_one_range(spark, tmp_path, settings):
    text = json.dumps([{"id": str(n), "note": "x" * 50} for n in range(100)])
    with gzip.open(tmp_path / "packed.json.gz", "wt", compresslevel=0) as f:
        f.write(text)
    (tmp_path / "small.json").write_text('[{"id": "s"}]')
    settings(spark__sql__files__maxPartitionBytes="2000")

    def opened() -> int:
        return split._pieces(spark, str(tmp_path), split._JSON, False, cut=True).rdd.getNumPartitions()

    assert opened() == 0
    (tmp_path / "large.json").write_text(text)
    assert opened() > 2
    ids = [r[0] for r in read_json_split(spark, str(tmp_path), "id STRING, note STRING").select("id").collect()]
    assert sorted(ids) == sorted([str(n) for n in range(100)] * 2 + ["s"])


def arrays(path) -> list[tuple[str, list]]:
    return [(p.parent.name, json.loads(gzip.open(p).read())) for p in Path(path).rglob("part-*.gz")]


def test_packed_files_are_filled_over_batches_and_folders(spark, tmp_path, settings):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="3")
    df = spark.range(60).select("id", (F.col("id") % 3).alias("c")).coalesce(1)
    write_json_arrays(df, f"{tmp_path}/few", folder="c", packed=True)
    found = arrays(f"{tmp_path}/few")
    assert sorted(name for name, _ in found) == ["folder=0", "folder=1", "folder=2"]
    assert sorted(r["id"] for _, rows in found for r in rows) == list(range(60))
    write_json_arrays(df, f"{tmp_path}/rows", 7, packed=True)
    assert sorted((len(rows) for _, rows in arrays(f"{tmp_path}/rows")), reverse=True) == [7] * 8 + [4]


@pytest.mark.parametrize("chars", [1, 40, 100])
def test_texts_held_for_files_are_bounded(spark, tmp_path, settings, chars):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="2")
    df = spark.range(100, 140).select("id", (F.col("id") % 20).alias("c")).coalesce(1)
    write_json_arrays(df, f"{tmp_path}/out", folder="c", chars_per_file=chars, packed=True)
    found = arrays(f"{tmp_path}/out")
    assert sorted(r["id"] for _, rows in found for r in rows) == list(range(100, 140))
    # An object has up to 17 characters; 20 folders never wait for one another.
    assert max(len(rows) for _, rows in found) <= max(1, chars // 16)


def test_nested_reviews_are_parsed_once_for_two_dumps(spark, tmp_path, monkeypatch):
    payloads, seen, parse = Q.harvest_payloads(spark, SMALL), [], harvest.raw_reviews
    monkeypatch.setattr(harvest, "raw_reviews", lambda *a: seen.append(a) or parse(*a))
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("reviews-step-*"))
    harvest.run(spark, payloads, f"{tmp_path}/both", "15/01/2023 10:30:00")
    assert len(seen) == 1
    steps = set(shared.glob("reviews-step-*")) - before
    assert len(steps) == 1 and not any(spark.read.parquet(str(p)).count() for p in steps)
    for name in ("atlas/users", "atlas/reviews"):
        harvest.run(spark, payloads, f"{tmp_path}/one", "15/01/2023 10:30:00", [name])
        both, one = ([r for _, rows in arrays(f"{tmp_path}/{d}/{name}") for r in rows] for d in ("both", "one"))
        assert both and sorted(map(str, both)) == sorted(map(str, one))


def test_payloads_are_emptied_after_the_harvest(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("harvest-*"))
    rows = Q.QUERIES["mart_from_harvest"](spark, SMALL)
    assert all(r.n_rows == r.n_keys > 0 for r in rows.collect())
    made = set(shared.glob("harvest-*")) - before
    assert len(made) == 1 and not [p for m in made for p in m.rglob("*.gz")]
