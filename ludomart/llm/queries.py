"""The registered queries of the operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludomart.llm import bpe, decontaminate, html_extract, licenses, mixing, ngram_join, nn_descent, prefix_trie, quality_knn, runs, sharding, toxicity, warc
from ludomart.llm.common import fold_of, table
from ludomart.session import workspace


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "warc")
    warc.archive(table(spark, sf_dir, "pages"), path, "page_id", "url", "html")
    records = warc.read(spark, path).where(F.col("record_type").isin("response", "revisit"))
    digest = F.concat(F.lit("sha1:"), warc.base32(F.sha1("payload")))
    number = r"^<urn:record:(-?[0-9]+)>$"
    # The digest of a response is taken of what was read; a revisit has no payload.
    own = F.when(F.col("record_type") == "response", digest).otherwise(F.col("payload_digest"))
    return records.select(
        F.regexp_extract("record_id", number, 1).alias("page_id"),
        F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.substring_index(own, ":", -1).alias("payload_digest"),
        "record_type",
        F.regexp_extract("refers_to", number, 1).alias("refers_to"),
    ).withColumns({c: F.expr(f"try_cast(nullif({c}, '') AS BIGINT)") for c in ("page_id", "refers_to")})


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold_of("doc_id", 5) != 0)
    out = toxicity.score(docs, toxicity.learn(docs, labels), keep=["doc_id"])
    return out.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.link(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )



def op1_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    out = sharding.assign(docs, size="n_bytes")
    return out.select("doc_id", "n_bytes", "shard_id", "shard_depth", "shard_bytes", "shard_rows")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(table(spark, sf_dir, "documents").select("doc_id", "text"))


# The documents have no domain: sources are put into four by the number in their name.
DOMAIN = "CASE WHEN source IS NULL THEN NULL ELSE concat('domain', coalesce(try_cast(regexp_extract(source, '[0-9]+', 0) AS BIGINT), 0) % 4) END"
WEIGHTS = {
    "domain=domain0": 4, "domain=domain1": 3, "domain=domain2": 2, "domain=domain3": 1,
    "lang=en": 4, "lang=de": 2, "lang=fr": 2, "lang=es": 2,
}


def levels() -> dict:
    return {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}


def op3_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as there are, to the weights above, from up to four epochs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = mixing.mix(docs, levels(), WEIGHTS, share=1.0, epochs=4, seed=17)
    return out.select("doc_id", "lang", "source", "n_tokens", "leaf_tokens", "leaf_budget", "copies")


def op8_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(docs, table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold_of("doc_id", 3) != 1)
    out = quality_knn.score(docs, quality_knn.learn(docs, labels), keep=["doc_id"])
    return out.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages, keep=["page_id", "url"])


def with_shared_heads(rows: DataFrame) -> DataFrame:
    """Paths of which up to three first turns, by the crc32 of the id, are those of the
    conversation with the last id before that 20 divides."""
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
    heads = rows.where("conv_id % 20 = 0").select(
        F.col("conv_id").alias("head"), *[F.slice(c, 1, 3).alias(f"head_{c}") for c in ("keys", "words")]
    )
    rows = rows.withColumns({"head": F.expr("conv_id - conv_id % 20"), "h": h}).join(heads, "head", "left")

    def joined(c: str):
        own = F.slice(c, F.col("h") + 1, F.greatest(F.size(c), F.lit(1)))
        return F.when(F.col(f"head_{c}").isNull(), own).otherwise(F.concat(F.slice(f"head_{c}", F.lit(1), F.col("h")), own))

    return rows.select("conv_id", *[joined(c).alias(c) for c in ("keys", "words")])


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prefix_trie.paths(table(spark, sf_dir, "conversations"))
    return prefix_trie.nodes(with_shared_heads(rows)).drop("turn_md5")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"])
    both = bpe.decode(encoded, ranks, keep=["doc_id", "ids"])
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Texts of a tenth of the ids, of which a last part repeats a stretch of words: where and
    of what period follows from the crc32 of the id. The others stay as they are."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.floor(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) / 10).cast("long")

    def tail(w):
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        turned = F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1),
            lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")),
        )
        return F.when(n > 0, F.array_join(turned, " "))

    # One element, so that the words are split once.
    text = F.element_at(F.transform(F.array(words), tail), 1)
    return docs.withColumn("text", F.when(fold_of("doc_id", 10) == 0, text).otherwise(F.col("text")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.detect(with_periodic_tails(docs), keep=["doc_id"])
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    found = found.withColumn(
        "longest",
        F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period")))),
    )
    length, period = F.col("longest.length"), -F.col("longest.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_extendible_sharding,
        op2_ngram_jaccard,
        op3_source_mixture,
        op4_warc_round_trip,
        op5_toxicity,
        op6_nn_descent,
        op7_license_scan,
        op8_suffix_decontamination,
        op9_quality,
        op10_main_text,
        op11_prefix_trie,
        op12_byte_bpe,
        op13_periodic_runs,
    )
}
