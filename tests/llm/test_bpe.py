"""Merge replay against the tiktoken library."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ludomart.llm import bpe
from ludomart.llm import queries as Q

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")
SMALL = "/root/testdata/sf0.001"


def library(name):
    with open(public.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rnd = random.Random(5)
    tokens = [b.decode() for b in library("byte_bpe_50k.tiktoken").token_byte_values() if b.decode("utf-8", "ignore").encode() == b]
    texts = [None, "", " ", "a", "  x   ", "\n\n\n   \n", "don't I'LL we've", "<|endoftext|>", "日本語", "👩‍👩‍👧‍👦"]
    texts += ["aaaaaaaa", "xx" * 500, " " * 1000, "abc" * 3000, "é" * 99, "\x1c\x85  ﻿", "z" * 60_000]
    texts += ["".join(rnd.choice(tokens) for _ in range(rnd.randrange(1, 40))) for _ in range(400)]
    texts += ["".join(rnd.choice("ab \n-=.") for _ in range(rnd.randrange(1, 80))) for _ in range(400)]
    return texts + texts[:30]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
@pytest.mark.parametrize("block,kept", [(1 << 20, 1 << 20), (64, 200)])
def test_ids_are_those_of_the_library_and_decode_to_the_text(spark, name, block, kept):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").withColumn("ids", F.lit("own")).repartition(3)
    ranks = bpe.read_ranks(public.path(name))
    out = bpe.encode(df, ranks, public.PATTERN, block_bytes=block, kept_bytes=kept)
    assert out.columns == ["n", "text", "ids"]
    rows = bpe.decode(out, ranks).collect()
    want = library(name)
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == want.encode_ordinary(texts[r.n] or ""), texts[r.n]
        assert bytes(r.decoded) == (texts[r.n] or "").encode()


def test_a_vocabulary_whose_later_merge_enables_an_earlier_one(spark):
    # "ab" has a later rank than "abc", which (ab, c) also gives; "bc" is no token.
    order = [bytes([b]) for b in range(256)] + [b"abc", b"ab", b"xx", b"xxx", b"xxxx"]
    tokens = {t: i for i, t in enumerate(order)}
    own = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=tokens, special_tokens={})
    texts = ["abcabcab abc", "ababc", "x" * 11, "xxxxx abx", "cab"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = bpe.encode(df, bpe.Ranks(tokens), r"\S+|\s+").collect()
    assert [r.ids for r in got] == [own.encode_ordinary(t) for t in texts]


def test_nothing_null_lists_and_foreign_ids(spark):
    ranks = bpe.Ranks({bytes([b]): b for b in range(256)} | {b"ab": 300})
    empty = spark.createDataFrame([], "text string")
    assert bpe.decode(bpe.encode(empty, ranks, "."), ranks).count() == 0
    lists = spark.createDataFrame([(1, [300, 99]), (2, None), (3, [])], "n int, ids array<int>")
    got = {r.n: bytes(r.decoded) for r in bpe.decode(lists, ranks).collect()}
    assert got == {1: b"abc", 2: b"", 3: b""}
    with pytest.raises(Exception, match="no token"):
        bpe.decode(spark.createDataFrame([([299],)], "ids array<int>"), ranks).collect()


def test_query(spark):
    want = library("byte_bpe_50k.tiktoken")
    texts = {r.doc_id: r.text or "" for r in Q.table(spark, SMALL, "documents").collect()}
    rows = Q.op12_byte_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = want.encode_ordinary(texts[r.doc_id])
        sha = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_long_lists_merge_as_single_positions_do(monkeypatch):
    """Vocabularies at random, in which later merges make earlier ones possible and pairs overlap."""
    rng = random.Random(5)
    for _ in range(60):
        single = [bytes([b]) for b in range(256)]
        more: set[bytes] = set()
        while len(more) < 40:
            more.add(bytes(rng.choices(b"abc", k=rng.randint(2, 6))))
        tokens = [*single, *rng.sample(sorted(more), 40)]
        v = bpe.Ranks({t: i for i, t in enumerate(tokens)}).plain()
        pair_ranks = dict(zip(v["pairs"].tolist(), v["merged"].tolist(), strict=True))
        pieces = [bytes(rng.choices(b"abc", k=rng.randint(1, 30))) for _ in range(60)]
        made = []
        for long_list in (1, 4, 1 << 40):
            monkeypatch.setattr(bpe, "LONG_LIST", long_list)
            made.append(bpe.replay(pieces, v, pair_ranks))
        assert made[0] == made[1] == made[2]
        assert [b"".join(tokens[i] for i in ids) for ids in made[0]] == pieces
