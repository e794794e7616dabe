"""Toxicity by a weighted lexicon.

A text is folded first: lower case, look-alike letters of other scripts and full-width forms to
Latin, digits and signs that stand for letters inside a word to those letters. An Aho-Corasick
automaton finds the terms of the lexicon in the folded text, in one pass whatever their number;
a term counts at the start of a word, or anywhere as a whole word. Exception phrases, found by
the same automaton, cover terms that lie inside them. The weights of what remains are summed
and normalised by length, and a logistic curve turns that into a score from 0 to 1.

The lexicon is learned from labelled rows, at most ``sample_rows`` of them (the lowest md5 of
seed and id, so the choice does not hang on the layout): beginnings of words, and whole words,
that labelled texts of the two kinds hold at very different rates. Exceptions are words that
begin as a term does and are common in clean texts. Document counts are one aggregate.

Defined results: a null or empty text has no words and the score of a text without terms;
repeated rows are scored each for itself; rows without a label, or labels without a row, teach
nothing; without labels of both kinds nothing is learned and the score is 0; other columns pass
through and a column named as a new one is replaced.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField

from ludomart.llm.common import keep_where, share, shared, with_columns

SAMPLE_ROWS = 20_000
LEXICON_TERMS = 4_000
PREFIX = (4, 8)
# Twice the log likelihood ratio that a term needs: about one word in 30,000 has it by chance.
EVIDENCE = 16.0

# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(
    zip(
        "авекмнорстухіјѕԁһӏԛԝьєαβεικνορτυχγηωℓıɑɡƖ",
        "abekmhopctyxijsdhlqwbeabeiknoptuxynwliagl",
        strict=True,
    )
)
# Digits and signs that stand for a letter between letters.
STANDINS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "€": "e"}


def _table() -> dict[int, str]:
    out = {ord(a): b for a, b in LOOKALIKES.items()}
    out |= {ord(a.upper()): b for a, b in LOOKALIKES.items() if len(a.upper()) == 1 and not a.upper().isascii()}
    out |= {c: chr(c - 0xFEE0).lower() for c in range(0xFF01, 0xFF5F)}  # full-width forms
    for c in (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD):  # invisible characters
        out[c] = ""
    for base in (0x1D400, 0x1D434, 0x1D468, 0x1D5A0, 0x1D5D4, 0x1D608, 0x1D63C, 0x1D670):
        for i in range(52):  # mathematical alphabets
            out[base + i] = chr(97 + i % 26)
    return out


FOLD = _table()


def fold(text: str) -> str:
    """The text as terms are looked for: same words, plain small letters."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).translate(FOLD)
    return text.lower()


def _is_word(c: str) -> bool:
    return c.isalnum()


# A letter or digit after a stand-in, and a run of word characters and stand-ins.
MASKED = re.compile(r"[013457893@$!|€][^\W\d_]|[^\W\d_][013457893@$!|€]\w")
RUN = re.compile(r"[\w@$!|€]+")


def unmask(text: str) -> str:
    """Stand-ins replaced in words that hold one next to a letter; marks at the end of a word
    stay, and so do numbers and texts without such a word."""
    if not MASKED.search(text):
        return text

    def swap(m: re.Match) -> str:
        word = m.group()
        core = word.rstrip("!|$@€")
        if core.isalpha() or not MASKED.search(core):
            return word
        return "".join(STANDINS.get(c, c) for c in core) + word[len(core) :]

    return RUN.sub(swap, text)


def folded(text: str) -> str:
    return unmask(fold(text))


@dataclass
class Lexicon:
    """Terms with weights, exception phrases, and the curve from density to score."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    slope: float = 0.0
    offset: float = -math.inf

    def matcher(self) -> Callable[[str], tuple[float, int, int]]:
        """From a text to (density, terms found, words)."""
        import ahocorasick

        auto = ahocorasick.Automaton()
        for t, w in self.terms.items():
            auto.add_word(t, (len(t), w))
        for e in self.exceptions:
            phrase = folded(e)
            if phrase:
                auto.add_word(phrase, (len(phrase), None))
        if len(auto):
            auto.make_automaton()
        def score(text: str) -> tuple[float, int, int]:
            n_words = len(text.split())
            if not len(auto) or not text:
                return 0.0, 0, n_words
            text = folded(text)
            found, spared = [], []
            for end, (size, weight) in auto.iter(text):
                start = end + 1 - size
                if start and _is_word(text[start - 1]):
                    continue
                if weight is None:
                    if end + 1 == len(text) or not _is_word(text[end + 1]):
                        spared.append((start, end + 1))
                else:
                    found.append((start, end + 1, weight))
            # Of terms that begin at one place the strongest counts, once.
            best: dict[int, tuple[float, int]] = {}
            for start, end, weight in found:
                if any(a <= start and end <= b for a, b in spared):
                    continue
                if weight > best.get(start, (0.0, 0))[0]:
                    best[start] = (weight, end)
            total = sum(w for w, _ in best.values())
            return total / math.sqrt(max(n_words, 1)), len(best), n_words

        return score

    def probability(self, density: float) -> float:
        x = self.slope * density + self.offset
        return 1.0 / (1.0 + math.exp(-x)) if x > -500 else 0.0


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int, seed: int) -> DataFrame:
    """Labelled rows (folded text, label), at most ``rows``."""
    ids = (
        labels.where(F.col(label).isNotNull() & F.col(f"`{key}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias("_id"))
        .agg(F.max(label).cast("int").alias("_label"))
        .orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_id").cast("string"))), "_id")
        .limit(rows)
    )
    own = docs.select(F.col(f"`{key}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    # The ids are at most as many as the sample has rows.
    return own.join(F.broadcast(ids), "_id").select("_id", "_text", "_label")


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    terms: int = LEXICON_TERMS,
    exceptions: Iterable[str] = (),
    seed: int = 5,
) -> Lexicon:
    """A lexicon of at most ``terms`` terms from the labelled rows given (training rows only)."""
    sample = _sample(docs, labels, key, text, label, sample_rows, seed)
    lo, hi = PREFIX

    def features(batches):
        word = re.compile(r"\w+")
        for batch in batches:
            rows = ([], [], [])
            for t, y in zip(batch.column("_text").to_pylist(), batch.column("_label").to_pylist(), strict=True):
                seen = set()
                for w in set(word.findall(folded(t))):
                    seen.update(w[:k] for k in range(lo, min(hi, len(w)) + 1))
                    seen.add(w + " ")
                seen = sorted(seen)
                rows[0].extend(seen)
                rows[1].extend([y] * len(seen))
                rows[2].extend([1] * len(seen))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64())],
                names=["term", "y", "n"],
            )

    sizes = {r["_label"]: r["n"] for r in sample.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Lexicon()
    counts = (
        sample.mapInArrow(features, "term string, y int, n bigint")
        .groupBy("term")
        .agg(F.sum(F.when(F.col("y") == 1, F.col("n"))).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n"))).alias("b"))
        .na.fill(0)
    )

    def part(x, total):  # x log (x / expected), 0 for 0
        return F.when(x > 0, x * F.log(x / total)).otherwise(0.0)

    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    all_ = a + b
    gain = 2 * (
        part(a, all_ * n1 / (n1 + n0))
        + part(b, all_ * n0 / (n1 + n0))
        + part(n1 - a, (n1 + n0 - all_) * n1 / (n1 + n0))
        + part(n0 - b, (n1 + n0 - all_) * n0 / (n1 + n0))
    )
    ratio = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))
    strong = counts.withColumns({"gain": gain, "ratio": ratio}).where(
        (F.col("gain") >= EVIDENCE) & (F.col("ratio") > math.log(20))
    )
    kept = strong.orderBy(F.desc("gain"), "term").limit(terms).collect()
    by_term = {r["term"]: r for r in kept}
    chosen: dict[str, float] = {}
    for t, r in by_term.items():
        # A longer beginning adds nothing to a shorter one that is as telling.
        short = [t.rstrip()[:k] for k in range(lo, len(t.rstrip()) + (t[-1] == " "))]
        if any(s != t and s in by_term and by_term[s]["ratio"] >= r["ratio"] - 1.0 for s in short):
            continue
        chosen[t.rstrip() if t.rstrip() not in chosen else t] = float(r["ratio"])
    lexicon = Lexicon(chosen, list(exceptions))
    lexicon.exceptions += _exceptions(counts, chosen, n1, n0)
    _fit(lexicon, sample)
    return lexicon


def _exceptions(counts: DataFrame, terms: dict[str, float], n1: int, n0: int) -> list[str]:
    """Whole words that begin with a term and are about as frequent in clean texts as in
    others; as many as there are terms at most."""
    if not terms:
        return []
    table = counts.sparkSession.createDataFrame([(t,) for t in terms], "stem string")
    words = counts.where(F.col("term").endswith(" ")).withColumn("word", F.rtrim("term"))
    lo, hi = PREFIX
    stems = F.transform(F.sequence(F.lit(lo), F.lit(hi)), lambda k: F.substring("word", F.lit(1), k))
    words = words.withColumn("stem", F.explode(F.array_distinct(stems)))
    clean = words.join(F.broadcast(table), "stem").where(
        (F.col("b") >= 2) & (F.col("b") / n0 >= F.col("a") / n1 / 2)
    )
    found = clean.groupBy("word").agg(F.max("b").alias("b")).orderBy(F.desc("b"), "word").limit(len(terms))
    return [r["word"] for r in found.collect()]


def _fit(lexicon: Lexicon, sample: DataFrame) -> None:
    """The logistic curve over the densities of the sample: two numbers by Newton's method on
    a histogram of the densities."""
    sent = share(sample.sparkSession, lexicon)

    def densities(batches):
        score = shared(sent).matcher()
        for batch in batches:
            x = [score(t)[0] for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.round(x, 3), pa.float64()), batch.column("_label")], names=["x", "y"]
            )

    rows = (
        sample.mapInArrow(densities, "x double, y int").groupBy("x", "y").agg(F.count("*").alias("n")).orderBy("x", "y").collect()
    )
    x = np.array([r["x"] for r in rows])
    y = np.array([r["y"] for r in rows], float)
    n = np.array([r["n"] for r in rows], float)
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], 1)
    penalty = np.diag([0.05, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (n * (p - y)) + penalty @ w
        hess = (design * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ design + penalty + 1e-9 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        w -= step if size < 4 else step * (4 / size)
        if size < 1e-8:
            break
    lexicon.slope, lexicon.offset = float(max(w[0], 0.0)), float(w[1])


FIELDS = [
    StructField("toxic_terms", IntegerType()),
    StructField("n_words", LongType()),
    StructField("score", DoubleType()),
    StructField("predicted", IntegerType()),
]


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or their columns ``keep``) with toxic_terms, n_words, score, predicted."""
    sent = share(docs.sparkSession, lexicon)

    def make() -> Callable[[pa.RecordBatch], dict[str, pa.Array]]:
        own = shared(sent)
        find = own.matcher()

        def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
            got = [find(t or "") for t in part.column(text).to_pylist()]
            p = [own.probability(d) for d, _, _ in got]
            return {
                "toxic_terms": pa.array([k for _, k, _ in got], pa.int32()),
                "n_words": pa.array([n for _, _, n in got], pa.int64()),
                "score": pa.array(p, pa.float64()),
                "predicted": pa.array([int(x >= 0.5) for x in p], pa.int32()),
            }

        return work

    return with_columns(docs, text, FIELDS, make, keep)


def clean(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    sent = share(docs.sparkSession, lexicon)

    def make() -> Callable[[pa.RecordBatch], list]:
        own = shared(sent)
        find = own.matcher()
        return lambda part: [own.probability(find(t or "")[0]) < 0.5 for t in part.column(text).to_pylist()]

    return keep_where(docs, text, make)
