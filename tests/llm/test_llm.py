"""Operators against brute force, on small tables with the odd cases."""

import base64
import collections
import gzip
import hashlib
import itertools
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ludomart.llm import (
    decontaminate,
    html_extract,
    licenses,
    mixing,
    ngram_join,
    nn_descent,
    oracle,
    quality_knn,
    sharding,
    toxicity,
    warc,
)
from ludomart.llm import queries as Q
from ludomart.llm.common import components, split_by_keys, stored
from ludomart.llm.words import ALNUM, SPACE, words
from tests.oracle import connect, differences

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = "/root/testdata/sf0.001"


def space_words(t):
    return re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER))


def alnum_words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))


def components_of(ids, links):
    up = {i: i for i in ids}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_queries_equal_their_sql(spark, name):
    assert not differences(connect(SMALL), Q.QUERIES[name](spark, SMALL), oracle.ORACLE[name])


@pytest.mark.parametrize("inside,split", [(SPACE, space_words), (ALNUM, alnum_words)])
def test_words_agree_in_slices(inside, split, monkeypatch):
    texts = ["Ab-c x y", None, "", "  ", "a" * 90 + " b", "one two", ""]
    want = words(pa.array(texts), inside)
    monkeypatch.setattr("ludomart.llm.words.SLICE_BYTES", 10)
    got = words(pa.array(texts), inside)
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(got, want, strict=True))
    assert np.diff(got[1]).tolist() == [len(split(t)) for t in texts]


@pytest.mark.parametrize("inside,split", [(SPACE, space_words), (ALNUM, alnum_words)])
def test_words_agree_with_the_pattern(inside, split):
    texts = ["Ab-c É9 x\x0by z", None, "", "  ", "a" * 70_000 + " b", "a b", "B A", "é\té"]
    h, first = words(pa.array(texts), inside)
    want = [split(t) for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in want]
    names = {}
    for got, w in zip(h.tolist(), itertools.chain(*want), strict=True):
        assert names.setdefault(w, got) == got
    assert len(set(names.values())) == len(names)


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(60)] + [(0, i) for i in range(100, 160)]
    links += [(i, i + 1) for i in range(200, 240)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long"), "t").collect()}
    ids = {x for ab in links if ab[0] != ab[1] for x in ab}
    assert got == {k: v for k, v in components_of({x for ab in links for x in ab}, links).items() if k in ids}


# Sharding


@pytest.mark.parametrize("limit", [1, 900, 5_000, 10**9])
def test_sharding_equals_sql(spark, limit):
    docs = Q.table(spark, SMALL, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    assert not differences(connect(SMALL), sharding.assign(docs, size="n_bytes", limit=limit), oracle.sharding_sql(limit))


def test_one_key_repeated_is_dealt_to_pages(spark):
    df = spark.createDataFrame([(7, "x" * (5 + i % 4)) for i in range(300)] + [(8, "y" * 99), (None, None)], "doc_id long, text string")
    out = sharding.assign(df, limit=40).collect()
    assert len(out) == 302
    size = collections.Counter()
    rows = collections.Counter()
    for r in out:
        size[r.shard_id] += len(r.text or "")
        rows[r.shard_id] += 1
    assert all(size[s] <= 40 or rows[s] == 1 for s in size)
    assert all(r.shard_bytes == size[r.shard_id] and r.shard_rows == rows[r.shard_id] for r in out)


def test_sharding_of_nothing_and_of_clashing_columns(spark, nothing, documents, tmp_path):
    assert sharding.assign(nothing).count() == 0
    out = sharding.assign(documents.withColumn("shard_id", F.lit(5)), limit=2_000)
    assert out.count() == documents.count() and dict(out.dtypes)["shard_id"] == "string"
    sharding.write(documents, str(tmp_path / "s"), limit=2_000)
    assert spark.read.parquet(str(tmp_path / "s")).count() == documents.count()


# Near duplicates


def jaccard_components(rows):
    sets = {}
    for d, t in rows:
        w = space_words(t)
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {d: len(s) for d, s in sets.items()}, components_of(sets, links)


def test_near_duplicates_equal_brute_force(documents, prose, nothing):
    size, comp = jaccard_components(prose)
    out = ngram_join.link(documents).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(d for d, _ in prose)
    assert all((r.n_shingles, r.component_id) == (size[r.doc_id], comp[r.doc_id]) for r in out)
    kept = ngram_join.keep_one(documents)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == set(comp.values())
    assert ngram_join.link(nothing).count() == 0


def test_near_duplicates_of_many_short_texts(spark):
    """Sizes around the bands, where segments are few and often empty, and chains at the limit."""
    rnd = random.Random(5)
    rows = []
    for i in range(400):
        if i % 4 and rows:
            w = rows[rnd.randrange(len(rows))][1].split()
            if rnd.random() < 0.6:
                w.append(f"w{rnd.randrange(30)}")
            else:
                w.insert(0, f"w{rnd.randrange(30)}")
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, " ".join(f"w{rnd.randrange(30)}" for _ in range(rnd.randrange(1, 40)))))
    size, comp = jaccard_components(rows)
    out = ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == {d: (size[d], comp[d]) for d, _ in rows}
    assert len(set(comp.values())) < 380


def test_every_allocation_covers_the_differences():
    for band in range(45):
        most = (int(ngram_join.bands()[band + 1]) - 1) // 3
        n, one, equal = ngram_join.allocation(band)
        assert n + one > most
        # Spoiling is cheapest where one difference does; none of the segments counted is left out.
        left, spoiled = most, min(most, n - one)
        spoiled += min(one, (left - spoiled) // 2)
        assert equal == n - spoiled > 0
    assert any(ngram_join.allocation(b)[1] for b in range(8))


def test_sets_of_a_range_beyond_the_packed_numbers(spark):
    rnd = random.Random(11)
    base = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(60)) for _ in range(20)]
    rows = [(i, f"{base[i % 20]} x{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = [sorted(map(tuple, ngram_join.shared_signatures(docs, 3, packed_sets=n).collect())) for n in (1 << 24, 10)]
    assert out[0] == out[1] and len(out[0]) > 300


def test_most_of_the_rows_share_signatures(spark):
    """A third of the sets are copies with changes of their own, another third shares a passage."""
    rnd = random.Random(12)
    word = lambda: f"w{rnd.randrange(10**6)}"
    text, passage = [word() for _ in range(90)], " ".join(word() for _ in range(55))
    rows = [(i, " ".join([*text[: 3 + i % 40], word(), *text[4 + i % 40 :]])) for i in range(150)]
    rows += [(i, f"{' '.join(word() for _ in range(rnd.randrange(10, 60)))} {passage}") for i in range(150, 300)]
    rows += [(i, " ".join(word() for _ in range(rnd.randrange(80)))) for i in range(300, 450)]
    size, comp = jaccard_components(rows)
    out = ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == {d: (size[d], comp[d]) for d, _ in rows}


def test_near_misses_of_a_large_group_are_not_listed_as_pairs(spark, monkeypatch):
    """All sets share most segments and every two just fail to link, but for a few that do."""
    rnd = random.Random(8)
    word = lambda: f"w{rnd.randrange(10**6)}"
    base = [word() for _ in range(150)]
    rows = [(i, " ".join([*base[: 130 - i // 112], *(word() for _ in range(20 if i >= 112 else 22))])) for i in range(120)]
    rows += [(i, " ".join([*base[:128], *(word() for _ in range(22))])) for i in range(120, 240)]
    made, stored = {}, ngram_join.stored

    def counted(df, tag):
        out = stored(df, tag)
        made[tag] = max(made.get(tag, 0), out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    size, comp = jaccard_components(rows)
    out = ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == {d: (size[d], comp[d]) for d, _ in rows}
    assert 1 < len(set(comp.values())) < 240
    assert made["pairs"] <= 240 and made["left"] <= made["cells"]


def test_sets_that_lead_each_other_meet_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    alike = [(1 + lead, fp, fp, 10, 1) for lead in range(12) for fp in range(100, 108)]
    # A long chain in which each set meets few others stays with its leaders.
    chain = [(300 + k, 300 + k + i, 300 + k + i, 10, 2) for k in range(60) for i in range(2)]
    left = spark.createDataFrame(alike + chain, "sig long, fp long, comp long, n long, g long")
    out = [(r.g, r.sig, r.fp) for r in ngram_join.clusters(left).collect()]
    assert sorted(x for x in out if x[0] == 1) == [(1, 0, fp) for fp in range(100, 108)]
    assert sorted(x for x in out if x[0] == 2) == sorted((2, r[0], r[1]) for r in chain)


def test_links_of_a_cell_in_small_blocks(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    monkeypatch.setattr(ngram_join, "SMALL", 2)
    _, comp = jaccard_components(prose)
    assert all(r.component_id == comp[r.doc_id] for r in ngram_join.link(documents).collect())


def test_documents_are_kept_without_python_workers(documents, prose):
    given = stored(documents, "given")
    kept = ngram_join.keep_one(given)
    assert "InArrow" not in kept._jdf.queryExecution().executedPlan().toString()
    _, comp = jaccard_components(prose)
    want = collections.Counter(d for d, _ in prose if comp[d] == d)
    assert collections.Counter(r.doc_id for r in kept.collect()) == want
    keys = documents.select("doc_id").where("doc_id < 130").distinct()
    # So few bits that other keys hit them too: they may be among the rest, never the other way.
    for bits in (64, 1 << 24):
        sure, rest = split_by_keys(documents, "doc_id", keys, bits)
        assert sure.where("doc_id < 130").isEmpty() and sure.columns == documents.columns
        assert sure.count() + rest.count() == len(prose)
    assert rest.where("doc_id >= 130").isEmpty()


def test_sets_that_differ_by_the_limit_share_a_signature():
    rnd = random.Random(2)
    for n in (1, 2, 3, 4, 7, 9, 15, 40, 90, 300, 1200):
        for _ in range(6):
            base = [f"s{rnd.randrange(10**9)}" for _ in range(n + 4)]
            cut = base[: 4 + -(-3 * n // 4)]
            h = [ngram_join.Sets(pa.array([" ".join(x)])).signatures()[0] for x in (base, cut)]
            assert set(h[0].tolist()) & set(h[1].tolist())


# Mixing


def test_mixture_follows_weights_and_capacities(documents, nothing):
    levels = {"domain": F.lit("d"), "lang": F.when(F.col("doc_id") < 100, "en").otherwise("de"), "source": F.col("source")}
    out = mixing.mix(documents, levels, {"lang=en": 3, "lang=de": 1}, share=0.5, epochs=2, seed=1).collect()
    assert len(out) == documents.count()
    total = sum(r.n_tokens for r in out)
    leaf = {(r.doc_id < 100, r.source): (r.leaf_tokens, r.leaf_budget) for r in out}
    assert all(b <= 2 * t for t, b in leaf.values())
    assert 0 <= total // 2 - sum(b for _, b in leaf.values()) <= 12
    taken = collections.Counter()
    for r in out:
        taken[r.doc_id < 100, r.source] += r.copies * r.n_tokens
    assert all(taken[k] <= leaf[k][1] for k in taken)
    assert mixing.mix(nothing, levels).count() == 0
    whole = mixing.mix(documents, levels, share=1.0).collect()
    assert all(r.copies == 1 or not r.leaf_budget for r in whole if r.n_tokens)
    assert sum(r.copies for r in mixing.mix(documents, levels, budget=0).collect()) == 0
    assert mixing.expand(mixing.mix(documents, levels, share=2.0, epochs=2)).where("n_tokens > 0").count() == 2 * sum(r.n_tokens > 0 for r in out)


# WARC


PAGES = [
    (1, "http://a/x\ny", "<p>é</p>"), (2, None, None), (3, "u", ""), (5, "u", "<p>é</p>"), (4, "u", "<p>é</p>"),
    (5, "u", "<p>é</p>"), (6, "u", "z" * 300_000), (7, "u", "WARC/1.1\r\n\r\n"), (None, "u", "<p>é</p>"),
]


def test_warc_round_trip_and_pushed_filters(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    path = str(tmp_path / "w")
    warc.archive(pages, path, "page_id", "url", "html", file_bytes=2_000)
    out = warc.check_digests(warc.read(spark, path)).collect()
    assert len(out) == len(PAGES) and all(r.intact for r in out)
    kinds = collections.Counter((r.record_id, r.record_type, r.refers_to) for r in out)
    assert kinds["<urn:record:5>", "response", None] == 2
    assert kinds["<urn:record:4>", "revisit", "<urn:record:5>"] == kinds["<urn:record:>", "revisit", "<urn:record:5>"] == 1
    assert kinds["<urn:record:2>", "revisit", "<urn:record:3>"] == 1
    by_id = {r.record_id: r for r in out}
    assert bytes(by_id["<urn:record:6>"].payload) == b"z" * 300_000
    digest = base64.b32encode(hashlib.sha1("<p>é</p>".encode()).digest()).decode()
    assert by_id["<urn:record:4>"].payload_digest == f"sha1:{digest}" and by_id["<urn:record:4>"].payload_bytes == 9
    some = warc.read(spark, path, payload="false").where("record_type = 'revisit' AND record_id LIKE '<urn:record:1%'")
    assert [(r.record_id, r.payload) for r in some.collect()] == [("<urn:record:1>", None)]
    with gzip.open(next((tmp_path / "w").glob("*.warc.gz"))) as f:
        assert f.readline() == b"WARC/1.1\r\n"
    assert not list((tmp_path / "w").glob("_staging*"))
    empty = str(tmp_path / "e")
    warc.archive(pages.limit(0), empty, "page_id", "url", "html")
    assert warc.read(spark, empty).count() == 0


def test_warc_leaves_small_payloads_alone_and_reads_plain_files(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    warc.archive(pages, str(tmp_path / "w"), "page_id", "url", "html", min_bytes=3)
    assert {r.record_id[12:-1]: r.record_type for r in warc.read(spark, str(tmp_path / "w")).collect()} == {
        "1": "response", "2": "response", "3": "revisit", "4": "response",
    }
    (tmp_path / "p").mkdir()
    with open(tmp_path / "p" / "x.warc", "wb") as out:
        for f in (tmp_path / "w").glob("*.warc.gz"):
            out.write(gzip.decompress(f.read_bytes()))
    assert warc.read(spark, str(tmp_path / "p")).where("record_type = 'response'").count() == 3


# Toxicity and quality


@pytest.mark.parametrize(
    "text,want",
    [
        ("You l0ser", "you loser"), ("1d1ot!", "idiot!"), ("трash ｓcum", "trash scum"), ("$cum", "scum"), ("in 2024 or 7", "in 2024 or 7"),
        ("good!! yes", "good!! yes"), ("", ""),
    ],
)
def test_folding(text, want):
    assert toxicity.folded(text.replace("тр", "tr")) == want


def test_terms_exceptions_and_length():
    find = toxicity.Lexicon({"trash": 2.0, "trashy": 3.0}, ["trash can"], 1.0, 0.0).matcher()
    assert find("a trash can and some")[1] == 0
    assert find("such trash")[:2] == (pytest.approx(2 / 2**0.5), 1)
    assert find("trashy trashy")[:2] == (pytest.approx(6 / 2**0.5), 2)
    assert find("untrash")[1] == 0 and find("")[0] == 0.0


def labelled(spark, seed, bad):
    rnd = random.Random(seed)
    rows = []
    for i in range(400):
        w = [rnd.choice(["san", "tor", "mel", "dri"]) + rnd.choice("aeiou") for _ in range(60)]
        y = i % 5 == 0
        rows.append((i, " ".join(bad(rnd, w) if y else w), int(y)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, 1 - y) for i, _, y in rows], "doc_id long, toxic int, quality int")
    return docs, labels


def test_toxicity_on_held_out_rows(spark, documents, nothing):
    def spoil(rnd, w):
        w[rnd.randrange(60)] = rnd.choice(["gromvak", "Gr0mvak", "grоmvakst"])
        return w

    docs, labels = labelled(spark, 1, spoil)
    lexicon = toxicity.learn(docs, labels.where(Q.fold_of("doc_id", 5) != 0))
    out = {r.doc_id: r for r in toxicity.score(docs, lexicon).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert sum(out[i].predicted == y for i, y in truth.items()) >= 398
    assert out[900].predicted == out[901].predicted == 0 and 0 <= out[900].score <= 1
    again = toxicity.score(documents, lexicon)
    assert again.count() == documents.count() and dict(again.dtypes)["score"] == "double"
    assert toxicity.score(nothing, lexicon).count() == 0
    none = toxicity.learn(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert {r.doc_id for r in toxicity.clean(docs, lexicon).collect()} == {i for i, r in out.items() if not r.predicted}


def test_quality_on_held_out_rows(spark, documents, nothing):
    docs, labels = labelled(spark, 2, lambda rnd, w: [x + "&&&" for x in w] if rnd.random() < 0.5 else [w[0]] * 60)
    model = quality_knn.learn(docs, labels.where(Q.fold_of("doc_id", 3) != 1))
    out = {r.doc_id: r for r in quality_knn.score(docs, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert sum(out[i].predicted == y for i, y in truth.items()) >= 396
    assert all(0 <= r.score <= 1 for r in out.values()) and len(out) == 402
    assert quality_knn.score(documents, model).count() == documents.count()
    assert quality_knn.score(nothing, model).count() == 0
    assert quality_knn.learn(docs, labels.limit(0)) is None
    assert {r.score for r in quality_knn.score(docs, None).collect()} == {0.5}


# Vectors


def test_vectors_equal_brute_force(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, rnd.standard_normal(16).tolist()) for i in range(700)]
    for c in range(6):
        centre = rnd.standard_normal(16)
        rows += [(1000 + 100 * c + i, (centre + rnd.standard_normal(16) * 0.11).tolist()) for i in range(30)]
    rows += [(2000 + i, [1.0] * 16) for i in range(40)] + [(2100, [3.0] * 16), (2101, [1.0] * 8), (2102, [0.0] * 16)]
    rows += [(2103, None), (2104, [1.0, None]), (2105, [float("nan")] * 16), (2106, []), (0, rows[0][1])]
    good = [(i, n, np.array(v)) for n, (i, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    links = collections.Counter()
    pairs = []
    for d in (8, 16):
        own = [x for x in good if len(x[2]) == d]
        x = np.stack([v / np.linalg.norm(v) for _, _, v in own])
        for a, b in zip(*np.nonzero(x @ x.T >= 0.9), strict=True):
            if a != b:
                links[own[a][1]] += 1
                pairs.append((own[a][1], own[b][1]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("kept", F.lit(2))
    out = nn_descent.link(df, audit_queries=200).collect()
    comp = components_of(range(len(rows)), pairs)
    least = collections.defaultdict(list)
    for n, (i, _) in enumerate(rows):
        least[comp[n]].append(i)
    want = collections.Counter((i, links[n], min(least[comp[n]])) for n, (i, _) in enumerate(rows))
    assert collections.Counter((r.vec_id, r.n_links, r.component_id) for r in out) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    assert nn_descent.link(df.limit(0)).count() == 0


def test_dense_clusters_side_by_side_are_joined(spark):
    """Lists full of a cluster's own members do not hide the links to the cluster beside it, also
    where another cluster has nearly all links."""
    rnd = np.random.default_rng(9)

    def cluster(first, n, centre):
        noise = rnd.standard_normal((n, 24)) * 0.012
        return [(first + i, (centre + noise[i]).tolist()) for i in range(n)]

    one, way, far = np.eye(24)[:3]
    rows = cluster(0, 40, one) + cluster(100, 40, 0.93 * one + 0.3676 * way) + cluster(1000, 900, far)
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    assert near[:80, :80].mean() > 0.95 and near[:40, :40].all() and not near[:80, 80:].any()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = nn_descent.link(df).collect()
    links = dict(zip([i for i, _ in rows], (near.sum(1) - 1).tolist(), strict=True))
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == {i: (n, 1000 if i >= 1000 else 0) for i, n in links.items()}


def test_audit_names_links_between_components(spark):
    points = [(n, np.array(v).tobytes(), n // 2) for n, v in enumerate([[1.0, 0.0], [0.0, 1.0], [0.96, 0.28], [0.8, 0.6]])]
    df = spark.createDataFrame(points, "node long, v binary, component long")
    found = nn_descent.audit(spark, df.drop("component"), df.select("node", "component"), 0.9, 10)
    assert {(r.a, r.b) for r in found.collect()} == {(0, 2), (2, 0)}
    one = df.selectExpr("node", "0L AS component")
    assert nn_descent.audit(spark, df.drop("component"), one, 0.9, 10).isEmpty()


# Licenses


def test_base_phrases_and_rules(spark, nothing, documents):
    texts = [
        "x Under the MIT-License, under the mit license", "the Apache License, Version 2.0", "CC BY-NC 4.0 cc by nc",
        "under the mit licenses", None, "", "SPDX-License-Identifier: GPL-3.0-only", "Licensed under the BSD 3-Clause License.",
        "licensed under the terms of the MIT license", "terms of trade", "é " * 20_000 + "cc by nc",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit("own"))
    out = [r for r in licenses.scan(df).orderBy("doc_id").collect()]
    for r, t in zip(out, texts, strict=True):
        w = alnum_words(t)
        at = [(i, label) for i in range(len(w)) for label, p in licenses.BASE if w[i : i + len(p.split())] == p.split()]
        want = (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({b for _, b in at})))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert out[6].labels == "gpl-3" and out[7].labels == "bsd-3-clause" and out[9].labels == ""
    assert [s.label for s in out[8].spans] == ["mit"]
    assert licenses.scan(documents).count() == documents.count() and licenses.scan(nothing).count() == 0


def test_spans_equal_brute_force(spark):
    names = ["mit license", "licensed under the mit license", "cc by nc sa 4 0 license", "gnu gpl v3", "subject to the terms of the apache license version 2 0", "spdx license identifier mit", "word"]
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(names) for _ in range(rnd.randrange(1, 7))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: sorted((s.rule, s.start, s.end) for s in r.spans) for r in licenses.scan(df).collect()}
    for i, t in enumerate(texts):
        found = [(p, m.start() - m.end(), n, m.start(), m.end()) for n, (_, p, _, _, e) in enumerate(licenses.rules()) for m in re.finditer(e, f" {t} ")]
        kept = [
            x for x in found
            if not any(y[:3] < x[:3] and ((y[3] <= x[3] and x[4] <= y[4]) or (x[3] <= y[3] and y[4] <= x[4])) for y in found)
        ]
        assert got[i] == sorted((x[2], x[3], x[4]) for x in kept)


def least_match(node):
    """A short text that a parsed expression matches."""
    out = ""
    for op, arg in node:
        if str(op) == "LITERAL":
            out += chr(arg)
        elif str(op) == "IN":
            out += chr(arg[0][1][0] if str(arg[0][0]) == "RANGE" else arg[0][1]) if str(arg[0][0]) != "NEGATE" else "x"
        elif str(op) in ("MAX_REPEAT", "MIN_REPEAT"):
            out += least_match(arg[2]) * arg[0]
        elif str(op) == "SUBPATTERN":
            out += least_match(arg[-1])
        elif str(op) == "BRANCH":
            out += least_match(arg[1][0])
        elif str(op) == "NOT_LITERAL":
            out += "x"
        else:
            assert str(op) in ("ASSERT", "ASSERT_NOT"), op
    return out


def test_a_text_with_nothing_but_a_match_is_found(spark):
    rules = licenses.rules()
    texts = [least_match(re._parser.parse(e)) for *_, e in rules] + ["This tool is released under the GPL version 3"]
    assert len(rules) == 320 and all(re.search(e, f" {t} ") for (*_, e), t in zip(rules, texts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in licenses.scan(df).collect()}
    lost = [t for i, t in enumerate(texts) if not out[i].spans or not out[i].labels]
    assert not lost
    assert out[320].labels == "gpl-3"


def test_phrases_of_ones_own_need_no_other_word(spark):
    own = (("free", "free of all rights"), ("é", "É à"))
    df = spark.createDataFrame([(0, "It is FREE-of all rights."), (1, "x É, à y"), (2, "free of rights")], "doc_id long, text string")
    assert {r.doc_id: (r.base_labels, r.n_base) for r in licenses.scan(df, base=own).collect()} == {0: ("free", 1), 1: ("é", 1), 2: ("", 0)}


# Decontamination


def test_decontamination_equals_brute_force(spark, documents, prose, nothing):
    long = alnum_words(prose[-3][1])
    items = [(1, " ".join(long[50:75])), (2, " ".join(alnum_words(prose[60][1])[5:25])), (2, prose[60][1]), (10, "one"), (11, None), (12, "?!"), (13, "never there at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = [(str(i), w[k : k + min(10, len(w))]) for i, t in items if (w := alnum_words(t)) for k in range(max(1, len(w) - 9))]

    def brute(t):
        w, hit, ids = alnum_words(t), set(), set()
        for i, win in windows:
            for k in range(len(w) - len(win) + 1):
                if w[k : k + len(win)] == win:
                    hit.update(range(k, k + len(win)))
                    ids.add(i)
        return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)

    want = {d: brute(t) for d, t in prose}
    for block in (1 << 20, 30):  # one pass, and one for each item
        out = decontaminate.report(documents, bench, block_words=block).collect()
        assert len(out) == len(prose)
        assert all(tuple(r)[1:] == want[r.doc_id] for r in out)
        kept = decontaminate.remove(documents, bench, block_words=block)
        assert kept.columns == documents.columns
        assert {r.doc_id for r in kept.collect()} == {d for d, w in want.items() if not w[4]}
    assert sum(w[4] for w in want.values()) > 15
    assert decontaminate.report(nothing, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.report(documents, bench.limit(0)).collect())


def test_frequent_words_of_texts_and_items_are_not_paired():
    texts = [" ".join(f"the x{i}" for i in range(k, k + 100)) for k in range(100)]
    items = [" ".join(f"the y{k}q{i}" for i in range(15)) for k in range(100)] + [texts[3], texts[3]]
    part = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    for pairs in (True, False):
        work = decontaminate._search(decontaminate.Items(list(range(102)), items, 10), pairs)
        tracemalloc.start()
        out = work(part, "text", None)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 30e6
        # Windows of text 3 are in those that share five numbers with it.
        assert [bool(x) for x in out["hit_starts"].to_pylist()] == [abs(k - 3) <= 95 for k in range(100)]
        assert [x == ["100", "101"] for x in out["hit_items"].to_pylist()] == [pairs and abs(k - 3) <= 95 for k in range(100)]


def test_suffix_array_orders_suffixes():
    rnd = np.random.default_rng(1)
    seq = rnd.integers(1, 4, 300).astype(np.uint64)
    order, head = decontaminate.suffix_array(seq, 8)
    keys = [tuple(seq[i : i + 8].tolist()) for i in order]
    assert keys == sorted(keys)
    assert head.tolist() == [True] + [a != b for a, b in itertools.pairwise(keys)]


def test_longest_match(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "x c d y")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "z c d e f q " + "w " * 10)], "item_id long, text string")
    assert {r.doc_id: r.longest_match for r in decontaminate.search(docs, bench).collect()} == {1: 4, 2: 2}


# Pages


@pytest.mark.parametrize(
    "html,want",
    [
        ("<body><nav>Menu</nav><article><h1>A &amp; b</h1><p>one\n two<br>three<p>four <b>five</b>!</article><footer>f</footer>", "A & b one two three four five!"),
        ("<main><header><h1>T</h1></header><p>x</p><div class='comments'><p>c</p></div><aside>s</aside></main><p>out</p>", "T x"),
        ("<article>a<script>var x='</p>'</script><style>p{}</style><!-- c --><form>f</form>b<div class='cookie-notice'>n</div></article>", "a b"),
        ("<div id='sidebar'>s</div><div class='content'><p>text</p></div>", "text"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"),
        ("", ""), (None, ""), ("plain &lt;b&gt; &#233;", "plain <b> é"), ("<div class='ad'>x", "x"), ("<div class='ad'>x</div>y", "y"),
    ],
)
def test_main_text(spark, html, want):
    df = spark.createDataFrame([(1, "http://h/a", html)], "page_id long, url string, html string").withColumn("text", F.lit(9))
    assert [(r.text, r.n_chars) for r in html_extract.extract(df).collect()] == [(want, len(want))]


LONG = " ".join(f"w{i}" for i in range(20))


@pytest.mark.parametrize(
    "html,want",
    [
        ("<html><head><title>t</title><meta charset=utf-8><body><p>text</p>", "text"),
        ("<head><title>t</title><link rel=x><p>a<p>b", "a b"), ("<head><title>t</title>plain", "plain"),
        ("<article class='post has-sidebar'><p>a</p></article>", "a"), ("<div class='content with-sidebar'>a</div>", "a"),
        ("<div class='comments-open'>a</div><p class='no-comments'>b", "a b"), ("<article class='comment'>a</article>", "a"),
        (f"<div class='widget'>{LONG}<div class='ad'>x</div></div><p>y", "y"), (f"<div class='widget'>{LONG}<div class='ad'>x</div></div>", LONG),
        (f"<p>{' '.join(LONG.split()[:8])}</p><div class='comments'>{LONG} {LONG}</div>", " ".join(LONG.split()[:8])),
        ("<main><p>a</p><ol class='commentlist'><li>c</ol><div class='user-comments'>d</div><article class='comment'>e</article></main>", "a"),
        ("<div class='content'><p>all the text</p></div><article>teaser</article>", "all the text teaser"),
        (f"<article>a</article><div class='comments'>{LONG}</div>", "a"),
        ("<p>a<span class='share-links'>b</span>c</p><div class='site-footer'>d</div><div class='side-bar'>e</div>", "ac"),
    ],
)
def test_hints_and_open_heads_lose_no_text(html, want):
    assert " ".join(t for t, _ in html_extract.blocks(html)) == want


def test_repeated_runs_are_boilerplate_where_markup_is_silent(spark):
    same = " ".join(f"boiler{i}" for i in range(20))
    rows = [(i, "http://h/a", f"<div>{same}</div><div>own text of page {i}</div><div>start{i} {same}</div>") for i in range(5)]
    rows += [(10, "http://other/a", f"<div>{same}</div>"), (11, None, None), (12, "http://h/z", f"<article>{same}</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {**{i: f"own text of page {i} start{i}" for i in range(5)}, 10: same, 11: "", 12: same}
    assert html_extract.extract(df.limit(0)).count() == 0
    repeated = df.where("page_id = 1").union(df.where("page_id = 1"))
    assert {r.text for r in html_extract.extract(repeated).collect()} == {f"{same} own text of page 1 start1 {same}"}


def test_menus_and_footers_without_markup(spark):
    menu = "<ul><li>Home<li>About us<li>Contact</ul>"
    rows = [(i, "http://h/a", f"{menu}<div><p>own {i}</p><p>words {i}</p></div><div>all rights kept {i % 1}</div>") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_extract.extract(df).collect()} == {i: f"own {i} words {i}" for i in range(5)}
    # On two pages they are no boilerplate yet.
    assert "Home About us Contact own 1" in html_extract.extract(df.where("page_id < 2")).where("page_id = 1").first().text


def naive_main_text(rows, k, least):
    pages = {i: (url.split("/")[2], html_extract.blocks(html)) for i, url, html in rows}
    runs, short = {}, {}
    for host, page in pages.values():
        stream = " ".join(t for t, _ in page).split()
        name = "\n".join(t for t, _ in page)
        for j in range(len(stream) - k + 1):
            runs.setdefault((host, *stream[j : j + k]), set()).add(name)
        for t, _ in page:
            if len(t.split()) < k:
                short.setdefault((host, t), set()).add(name)
    out = {}
    for i, (host, page) in pages.items():
        stream = " ".join(t for t, _ in page).split()
        found = [j for j in range(len(stream) - k + 1) if len(runs[(host, *stream[j : j + k])]) > 1]
        gone = {x for j in found for x in range(j, j + k)}
        kept, at = [], 0
        for t, kind in page:
            own = t.split()
            place = range(at, at + len(own))
            at += len(own)
            within = {x for j in found if j >= place[0] and j + k <= at for x in range(j, j + k)}
            if kind or not (gone.issuperset(place) or (len(own) < k and len(short[host, t]) >= least)):
                kept += [w for j, w in zip(place, own, strict=True) if kind or j not in within]
        out[i] = " ".join(kept)
    return out


@pytest.mark.parametrize("shard_bytes", [60, 1 << 20])
def test_repeats_over_all_shards_of_a_host_as_by_brute_force(spark, shard_bytes):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(9)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 9))) for _ in range(12)]
    rows = []
    for i in range(60):
        tags = rng.choices(["p", "div", "li", "article"], weights=[4, 4, 4, 1], k=rng.randint(0, 6))
        text = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(vocabulary, k=rng.randint(1, 7))) for _ in tags]
        rows.append((i, f"http://h{i % 2}/x", "".join(f"<{t}>{x}</{t}>" for t, x in zip(tags, text, strict=True))))
    rows += [(100, *rows[3][1:]), (101, *rows[4][1:])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df, min_words=4, shard_bytes=shard_bytes).collect()}
    assert got == naive_main_text(rows, 4, html_extract.MIN_PAGES)


def test_votes_equal_plain_ones_whatever_the_block():
    rng = random.Random(3)
    texts = [" ".join(rng.choices("ab cd ef gh ij kl mn".split(), k=rng.randint(0, 12))) for _ in range(300)]
    texts[20:60] = [texts[20]] * 40  # more copies than neighbours: ties
    column = pa.array(texts, pa.string())
    count, style = quality_knn.counts(column), quality_knn.styles(column)
    label = np.array([i % 3 == 0 for i in range(300)])
    model = quality_knn.Model(count, style, label, 16, 15, 1)
    whole = model.score(column)
    x = quality_knn.matrix(count, style, model.idf)
    for i in range(0, 300, 7):
        z = model.project(x[i : i + 1])[0]
        sims = [round(float(np.dot(z, v)), 12) for v in model.vectors]
        near = sorted(range(300), key=lambda j: (-sims[j], j))[:15]
        weight = [max(sims[j], 1e-6) ** 4 for j in near]
        assert abs(whole[i] - sum(w for w, j in zip(weight, near, strict=True) if label[j]) / sum(weight)) < 1e-9
        assert model.score(column.slice(i, 1))[0] == whole[i]
