"""The pipeline against brute-force versions of its stages."""

import collections

import corpus_pipeline as P
from ludomart.llm import decontaminate, ngram_join, toxicity
from ludomart.llm.common import fold_of, table
from tests.llm.test_llm import alnum_words, jaccard_components

SMALL = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = table(spark, SMALL, "documents").cache()
    before = {r.doc_id: r for r in docs.collect()}
    labels = table(spark, SMALL, "labels").where(fold_of("doc_id", 5) != 0)
    find = (lexicon := toxicity.learn(docs, labels)).matcher()
    want = {d for d, r in before.items() if lexicon.probability(find(r.text or "")[0]) < 0.5}
    columns = docs.columns
    checks = {
        "toxicity": lambda kept: want,
        "near_copies": lambda kept: set(jaccard_components([(d, before[d].text) for d in kept])[1].values()),
        "decontamination": lambda kept: {d for d in kept if not hit(before[d].text)},
    }
    items = [alnum_words(r.text) for r in table(spark, SMALL, "benchmark").collect()]
    windows = {tuple(w[k : k + min(10, len(w))]) for w in items if w for k in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}

    def hit(t):
        w = alnum_words(t)
        return any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    kept = set(before)
    for name, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, SMALL), "t")
        assert docs.columns == columns
        now = collections.Counter(r.doc_id for r in docs.collect())
        assert max(now.values()) == 1 and set(now) <= kept
        if name in checks:
            assert set(now) == checks[name](kept)
        else:
            words = lambda ids: sum(len((before[d].text or "").split()) for d in ids)
            assert 0.6 * words(kept) <= words(now) <= 0.9 * words(kept)
        kept = set(now)
    out = P.run(spark, SMALL).collect()
    assert {r.doc_id for r in out} == kept and all(r.text == before[r.doc_id].text for r in out)
    assert "shard_id" in out[0]


def test_odd_rows_pass_through(spark, documents):
    """Nulls, repeated rows and columns that clash."""
    own = documents.withColumns({"n_tokens": documents.doc_id, "copies": documents.text, "n_chars": documents.doc_id})
    lexicon = toxicity.Lexicon({"alpha3": 9.0}, [], 1.0, -3.0)
    assert toxicity.clean(own, lexicon).columns == own.columns
    assert ngram_join.keep_one(own).columns == own.columns
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontaminate.remove(own, bench).columns == own.columns
    mixed = P.mix_sources(spark, own, "")
    assert mixed.columns == own.columns and all(r.n_tokens == r.doc_id for r in mixed.collect())
    assert P.mix_sources(spark, own.limit(0), "").count() == 0
