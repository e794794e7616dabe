"""The trie against one built turn by turn."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ludomart.llm import prefix_trie as T


def trie_of(conversations):
    """{(depth, smallest member): the other columns} of {id: [(role, text), ...]}."""
    members, kids, ends = {}, {}, {}
    for c, turns in sorted(conversations.items()):
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
            if d:
                kids.setdefault(tuple(turns[: d - 1]), set()).add(tuple(turns[:d]))
        ends.setdefault(tuple(turns), []).append(c)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = kids.get(path, ())
        leaves[path] = sum(leaves[k] for k in below) if below else 1
        words = len(path[-1][1].split()) if path else 0
        saved[path] = (len(members[path]) - 1) * words + sum(saved[k] for k in below)
    return {
        (len(p), m[0]): (
            members[p[:-1]][0] if p else None,
            len(m),
            len(kids.get(p, ())),
            leaves[p],
            saved[p],
            hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest(),
        )
        for p, m in members.items()
    }


def conversations(seed):
    rnd = random.Random(seed)
    turn = lambda: (rnd.choice(["user", "bot", ""]), " ".join(["w"] * rnd.randrange(4)) + rnd.choice("ab"))
    out = {}
    common = [turn() for _ in range(6)]
    for c in range(120):
        out[c * 7 - 30] = common[: rnd.randrange(7)] + [turn() for _ in range(rnd.randrange(5))]
    for c in range(1000, 1090):  # copies
        out[c] = list(common)
    deep = [turn() for _ in range(150)]
    for c in range(2000, 2006):
        out[c] = deep[: rnd.randrange(140, 150)] + [turn() for _ in range(3)]
    out[3000], out[3001] = [("user", "alone")], []
    return {c: t for c, t in out.items() if t or c == 3001}


def rows_of(spark, convs):
    rows = [(c, i * 2, r, t, "own") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(4).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, label string")


def collected(df):
    rows = df.collect()
    got = {
        (r.depth, r.conv_id): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        for r in rows
    }
    assert len(got) == len(rows)
    return got


# Turns a task and entries of the last task: one range, many, and several levels of ranges.
@pytest.mark.parametrize("turns,last", [(10**6, 10**6), (40, 10**6), (25, 400)])
@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, turns, last, seed):
    convs = conversations(seed)
    paths = T.paths(rows_of(spark, convs))
    empty = paths.limit(1).select(F.lit(3001).cast("long").alias("conv_id"), F.slice("keys", 1, 0).alias("keys"), F.slice("words", 1, 0).alias("words"))
    assert collected(T.nodes(paths.unionByName(empty), turns, last)) == trie_of(convs)


def test_nulls_ties_repeated_rows_and_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(
        [
            (1, 5, "user", "late"), (1, None, None, "a b"), (1, 0, "bot", None),
            (2, None, "", "a b"), (2, 1, "bot", ""),
            (3, 1, "x", "q"), (3, 1, "x", "q"),
            (4, 1, "x", "one"), (4, 1, "y", "two"), (5, 2, "y", "two"), (5, 2, "x", "one"),
            (None, 1, "user", "nobody"),
        ],
        schema,
    )
    got = collected(T.nodes(T.paths(df)))
    tied = sorted([("x", "one"), ("y", "two")], key=lambda t: hashlib.md5(f"{len(t[0])}:{t[0]}{t[1]}".encode()).hexdigest())
    convs = {1: [("", "a b"), ("bot", ""), ("user", "late")], 2: [("", "a b"), ("bot", "")], 3: [("x", "q")] * 2, 4: tied, 5: tied}
    assert got == trie_of(convs)
    assert T.nodes(T.paths(df.limit(0))).count() == 0
    md5 = {r.conv_id: r.turn_md5 for r in T.nodes(T.paths(df)).where("depth = 2").collect()}
    assert bytes(md5[3]) == hashlib.md5(b"1:xq").digest()


def test_roles_and_texts_are_kept_apart(spark):
    df = spark.createDataFrame([(1, 0, "ab", "c"), (2, 0, "a", "bc")], "conv_id long, turn long, role string, text string")
    assert T.nodes(T.paths(df)).where("depth = 1").count() == 2
