"""A training-data pipeline over ``documents``: each stage works on what the one before kept.

Stages are written to the shared folder as Parquet and read again, so a lost executor costs a
task and not the run. All but the last return the columns of ``documents``; a row that no stage
finds fault with goes through to the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludomart.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from ludomart.llm.common import fold_of, stored, table
from ludomart.llm.queries import WEIGHTS, levels

# Share of the tokens that reach the mixture which it takes, once each.
MIXTURE_SHARE = 0.9


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the training fold of the labels, does not
    reject."""
    labels = table(spark, sf_dir, "labels").where(fold_of("doc_id", 5) != 0)
    lexicon = toxicity.learn(docs, labels)
    return toxicity.clean(docs, lexicon)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near copies."""
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture, each at most once: domains, languages and sources by weight,
    with ``MIXTURE_SHARE`` of the tokens there are."""
    # Columns that carry a name of the mixture's own are put aside meanwhile.
    aside = {c: f"_in_{c}" for c in docs.columns if c in (*mixing.NEW, "epoch")}
    own = docs.withColumnsRenamed(aside)
    mixed = mixing.expand(mixing.mix(own, levels(), WEIGHTS, share=MIXTURE_SHARE, epochs=1, seed=17))
    return mixed.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard."""
    return sharding.assign(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixture", mix_sources),
    ("sharding", shard),
]

# The lexicon is learned, which SQL cannot express; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
