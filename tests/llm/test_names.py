"""Columns of the user that carry an operator's own names, and objects on workers that lack the
package."""

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ludomart.llm import bpe, decontaminate, html_extract, licenses, mixing, ngram_join, quality_knn, runs, sharding, toxicity

OWN = [
    "tokens", "share", "budget", "cap", "weight", "_full", "_rest", "_h", "_H2", "_cell", "_end", "_cut", "_left", "_sum", "_upto", "_key",
    "_row", "_size", "_entry", "_leaf", "_leaf0", "_part", "_page", "_most", "_before", "bytes", "rows", "depth", "prefix", "entry", "h",
    "_id", "_k", "fp", "comp", "component_id", "a", "b", "_text", "_label", "_scan", "_found", "_host", "_shard", "_n", "_texts", "_kinds",
    "with space",
]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"some words of text number {i % 7} are here", "en", f"src{i % 3}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id")) for c in OWN})


def benchmark(spark):
    return spark.createDataFrame([("x", "number 3 are here"), ("y", "no such words")], "item_id string, text string")


def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 7 == 3)) for i in range(40)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "sharding": lambda s, d: sharding.assign(d, limit=300),
    "sharding_pages": lambda s, d: sharding.assign(d, key="lang", limit=300),
    "mixing": lambda s, d: mixing.expand(mixing.mix(d, {"lang": F.col("lang"), "source": F.col("source")}, {"source=src1": 3}, epochs=2)),
    "mixing_tokens": lambda s, d: mixing.mix(d, {"source": F.col("source")}, tokens=F.length("tokens").cast("long")),
    "keep_one": lambda s, d: ngram_join.keep_one(d),
    "licenses": lambda s, d: licenses.scan(d),
    "search": lambda s, d: decontaminate.search(d, benchmark(s), window=3),
    "search_blocks": lambda s, d: decontaminate.search(d, benchmark(s), window=3, block_words=3),
    "remove": lambda s, d: decontaminate.remove(d, benchmark(s), window=3),
    "pages": lambda s, d: html_extract.extract(d.withColumn("html", F.col("text")), key="doc_id", url="source", shard_bytes=200),
    "toxicity": lambda s, d: toxicity.score(d, toxicity.learn(d, labels(s))),
    "clean": lambda s, d: toxicity.clean(d, toxicity.learn(d, labels(s))),
    "quality": lambda s, d: quality_knn.score(d, quality_knn.learn(d, labels(s))),
    "bpe": lambda s, d: bpe.encode(d, bpe.Ranks({bytes([i]): i for i in range(256)}), "."),
    "runs": lambda s, d: runs.detect(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_columns_of_any_name_pass_through(spark, clashing, name):
    out = OPERATORS[name](spark, clashing)
    assert set(OWN) <= set(out.columns)
    rows = out.collect()
    assert rows
    for r in rows:
        assert all(r[c] == f"{c}:{r.doc_id}" for c in OWN)


def test_objects_travel_by_value(spark, clashing, tmp_path):
    lexicon = toxicity.learn(clashing, labels(spark))
    model = quality_knn.learn(clashing, labels(spark))
    code = "import pickle, sys, pyarrow as pa; l, m = pickle.load(open(sys.argv[1], 'rb')); l.matcher()('some words'); m.score(pa.array(['some words']))"
    (tmp_path / "objects").write_bytes(cloudpickle.dumps((lexicon, model)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", f"{code}; assert 'ludomart' not in sys.modules", str(tmp_path / "objects")], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
