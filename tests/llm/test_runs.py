"""Periodic runs against a search of every period."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ludomart.llm import runs


def every_run(words, least=12):
    best = {}
    for q in range(1, len(words) // 2 + 1):
        x = 0
        while x < len(words) - q:
            y = x
            while y < len(words) - q and words[y] == words[y + q]:
                y += 1
            if y - x >= q and y - x + q >= least:
                best.setdefault((x, y + q), q)
            x = max(y, x + 1)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(seed, count=70):
    """Texts over few words with planted repetitions, also of texts that are periodic."""
    rnd = random.Random(seed)
    out = [None, "", "  ", "a " * 30, "ab " * 11, "ab\t" * 12, "A a " * 9, "é ê " * 8]
    for _ in range(count):
        k = rnd.choice([1, 2, 2, 3, 5, 50])
        w = [str(rnd.randrange(k)) for _ in range(rnd.randrange(0, rnd.choice([20, 60, 300])))]
        for _ in range(rnd.randrange(0, 5)):
            if w:
                a, p, m = rnd.randrange(len(w)), rnd.randrange(1, 61), rnd.randrange(1, 150)
                w[a:a] = (w[a : a + p] * m)[:m]
        if w and rnd.random() < 0.5:  # copies of a text of a short period, side by side
            p = rnd.randrange(2, 8)
            root = [str(rnd.randrange(2)) for _ in range(p)]
            a = rnd.randrange(len(w))
            w[a:a] = (root * 20)[: rnd.randrange(9 * p - 2, 14 * p)] * rnd.choice([2, 2, 3])
        if rnd.random() < 0.2:
            a, b = ["x"], ["x", "y"]
            for _ in range(rnd.randrange(4, 11)):
                a, b = b, b + a
            w += b
        out.append(" ".join((w * rnd.choice([1, 1, 1, 2, 3]))[:600]))
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_every_run_is_found(seed):
    texts = repetitive(seed)
    raw, begin, size, h, first = runs.split(pa.array(texts, pa.string()))
    found = runs.find(h, first)
    text = runs._collapsed(raw, begin, size, first, found).to_pylist()
    for i, t in enumerate(texts):
        words = (t or "").split()
        want = every_run(words)
        assert [tuple(r) for r in found[found[:, 0] == i][:, 1:].tolist()] == want
        assert text[i] == collapsed(words, want)


@pytest.mark.parametrize("p", [2, 3, 5])
def test_two_copies_of_a_periodic_text(p):
    """No position between the copies of such a text is selected at the scale of its length."""
    root = [f"w{i}" for i in range(p)]
    for n in range(9 * p - 1, 40 * p, 3):
        u = (root * 60)[:n]
        words = ["x", *u, *u, "y"]
        _, _, _, h, first = runs.split(pa.array([" ".join(words)]))
        assert [tuple(r) for r in runs.find(h, first)[:, 1:].tolist()] == every_run(words)


def test_a_long_text_with_a_long_period(spark):
    rnd = random.Random(2)
    stretch = [str(rnd.randrange(10**6)) for _ in range(40_000)]
    words = ["head", *stretch, *stretch, *stretch[:7], "tail", *["x"] * 50_000]
    df = spark.createDataFrame([(1, " ".join(words))], "n int, text string")
    (row,) = runs.detect(df).collect()
    assert [tuple(r) for r in row.runs] == [(1, 80_007, 40_000), (80_009, 50_000, 1)]
    assert row.collapsed == " ".join(["head", *stretch, "tail", "x"])


def test_frames(spark):
    texts = repetitive(9, 40)
    rows = [(i, t, "own") for i, t in enumerate(texts)] + [(0, texts[0], "own")]
    df = spark.createDataFrame(rows, "n int, text string, runs string").withColumn("start", F.lit(1))
    out = runs.detect(df.repartition(3))
    assert out.columns == ["n", "text", "start", "runs", "collapsed"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        words = (texts[r.n] or "").split()
        want = every_run(words)
        assert [tuple(x) for x in r.runs] == want and r.collapsed == collapsed(words, want)
    assert runs.detect(df.limit(0)).count() == 0
    short = runs.detect(spark.createDataFrame([("b a a a c d c d",)], "text string"), least=3, keep=[])
    assert short.first() == ([(1, 3, 1), (4, 4, 2)], "b a c d")
