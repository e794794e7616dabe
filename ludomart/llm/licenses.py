"""License scans by ordered signature rules, in native DataFrame functions only.

A rule is a regular expression over the words of a text, with a keyword that the text has to
hold before the expression runs, a priority and a label. Where two detections overlap so that
one lies inside the other, the one of the better priority stays, or the longer one, or the one
whose rule comes first. One row is looked at by itself: no shuffle and no Python worker.

Defined results: a null or empty text has no words and no detection; repeated rows are scored
each for itself; other columns pass through; an empty table gives an empty table. A row's
spans are held in one array, which its own text bounds.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludomart.llm.common import free

# Word characters are digits, letters, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases whose places are counted, as labels and their words.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Label, keywords (one has to occur), name of the license over lower-case words, identifier. A
# version follows as separate words ("2 0"), as punctuation is no word.
FAMILIES = (
    ("mit", "mit|expat|x11", "(?:mit|expat|x11)", "mit"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version)?(?: v)? ?2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version)? 1 1", "apache 1 1"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd)", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)", "bsd 4 clause"),
    ("0bsd", "bsd", "(?:0bsd|zero clause bsd|bsd zero clause)", "0bsd"),
    ("gpl-2", "gpl|general public", "(?:gnu gpl|gpl|gnu general public license|general public license)(?: version)?(?: v| )?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "gpl|general public", "(?:gnu gpl|gpl|gnu general public license|general public license)(?: version)?(?: v| )?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "lgpl|lesser general", "(?:gnu lgpl|lgpl|(?:gnu )?lesser general public license)(?: version)?(?: v| )?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", "lgpl|lesser general", "(?:gnu lgpl|lgpl|(?:gnu )?lesser general public license)(?: version)?(?: v| )?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3", "agpl|affero", "(?:gnu agpl|agpl|(?:gnu )?affero general public license)(?: version)?(?: v| )?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl-1.3", "documentation|gfdl", "(?:gnu )?free documentation license(?: version)?(?: 1 3)?", "gfdl 1 3(?: only| or later)?"),
    ("mpl-1.1", "mpl|mozilla", "(?:mpl|mozilla public license)(?: version)? ?1 1", "mpl 1 1"),
    ("mpl-2", "mpl|mozilla", "(?:mpl|mozilla public license)(?: version)? ?2(?: 0)?", "mpl 2 0"),
    ("epl-1", "epl|eclipse", "(?:epl|eclipse public license)(?: version)? ?(?:v )?1(?: 0)?", "epl 1 0"),
    ("epl-2", "epl|eclipse", "(?:epl|eclipse public license)(?: version)? ?(?:v )?2(?: 0)?", "epl 2 0"),
    ("eupl-1.2", "eupl|european union", "(?:eupl|european union public licen[sc]e)(?: version)?(?: v)? ?1 2", "eupl 1 2"),
    ("cddl-1", "cddl|common development", "(?:cddl|common development and distribution license)(?: version)? ?1(?: 0)?", "cddl 1 0"),
    ("cpl-1", "common public|cpl", "common public license(?: version)?(?: 1 0)?", "cpl 1 0"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("boost-1", "boost|bsl", "boost(?: software)?(?: license)?(?: version)?(?: 1(?: 0)?)?", "bsl 1 0"),
    ("artistic-2", "artistic", "artistic(?: license)?(?: version)? 2(?: 0)?", "artistic 2 0"),
    ("python-2", "python|psf", "(?:psf|python software foundation)(?: license)?(?: version)? 2(?: 0)?", "(?:psf|python) 2 0"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("ofl-1.1", "font|ofl", "(?:sil )?open font license(?: version)?(?: 1 1)?", "ofl 1 1"),
    ("odbl-1", "odbl|open database", "(?:odbl|open database license)(?: version)?(?: v)?(?: 1 0)?", "odbl 1 0"),
    ("odc-by-1", "odc|open data", "(?:odc by|open data commons attribution license)(?: version)?(?: v)?(?: 1 0)?", "odc by 1 0"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtf", "wtfpl(?: version)?(?: 2)?", "wtfpl"),
    ("ms-pl", "microsoft|ms pl", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft|ms rl", "microsoft reciprocal license", "ms rl"),
    ("cc0-1", "cc0|cc zero|creative commons", "(?:cc0|cc zero|creative commons zero)(?: 1 0)?", "cc0 1 0"),
    ("cc-by", "cc by|creative commons", "(?:cc by|creative commons attribution)(?: international)?(?: [1-4] [0-9])?", "cc by [1-4] [0-9]"),
    ("cc-by-sa", "cc by|creative commons", "(?:cc by sa|creative commons attribution share ?alike)(?: international)?(?: [1-4] [0-9])?", "cc by sa [1-4] [0-9]"),
    ("cc-by-nd", "cc by|creative commons", "(?:cc by nd|creative commons attribution no ?deriv(?:s|atives))(?: international)?(?: [1-4] [0-9])?", "cc by nd [1-4] [0-9]"),
    ("cc-by-nc", "cc by|creative commons", "(?:cc by nc|creative commons attribution non ?commercial)(?: international)?(?: [1-4] [0-9])?", "cc by nc [1-4] [0-9]"),
    ("cc-by-nc-sa", "cc by|creative commons", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: international)?(?: [1-4] [0-9])?", "cc by nc sa [1-4] [0-9]"),
    ("cc-by-nc-nd", "cc by|creative commons", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:s|atives))(?: international)?(?: [1-4] [0-9])?", "cc by nc nd [1-4] [0-9]"),
)

# Priority, weight, keywords (one has to occur), expression around a name {n} or an
# identifier {i}. A lower priority number wins.
SIGNATURES = (
    (0, 1.0, "spdx", "spdx license identifier {i}"),
    (1, 0.95, "under", "(?:licensed|released|distributed|available|provided|published|used) (?:to you )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{n}(?: licen[sc]e)?"),
    (1, 0.95, "subject to|governed|covered|complies", "(?:subject to|governed by|covered by|complies with) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{n}(?: licen[sc]e)?"),
    (2, 0.9, "under", "under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{n} licen[sc]e"),
    (2, 0.9, "under", "under (?:the )?terms (?:and conditions )?of (?:the )?{n}"),
    (3, 0.8, "licen", "licen[sc]e(?:d|s)?(?: is| type| name)? (?:the )?{n}"),
    (3, 0.8, "licen", "(?:the )?{n} licen[sc]e(?: agreement)?"),
    (4, 0.6, "copyright", "copyright (?:c )?(?:[0-9]{{4}} )?(?:[^ ]+ ){{0,6}}{n}(?: licen[sc]e)?"),
)

# Places of a phrase have this weight.
BASE_WEIGHT = 0.95


def rules() -> list[tuple[str, int, float, str, str]]:
    """(keyword, priority, weight, label, expression) for every family and signature."""
    out = []
    for label, keyword, name, identifier in FAMILIES:
        for priority, weight, _, around in SIGNATURES:
            body = around.format(n=name, i=identifier)
            out.append((keyword, priority, weight, label, f"(?<= ){body}(?= )"))
    return out


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once: a column that is named twice would be
    computed twice, and one named in a lambda for every element."""
    return F.transform(F.array(value), body)[0]


def _gated(text: Column, base: tuple) -> Column:
    """Whether a text holds, in any case, the words of a keyword of a family and of a signature,
    or of a phrase: every rule needs the first two. Words may be parted by anything in the text,
    so each is looked for by itself. Lower case of letters beyond ASCII may add a match and
    takes none away, but for words that have such letters: these are not asked for."""

    def holds(low: Column, phrases: set[str]) -> Column:
        def all_words(phrase: str) -> Column:
            return reduce(and_, [F.contains(low, F.lit(w)) for w in phrase.split() if w.isascii()], F.lit(True))

        return reduce(or_, [all_words(p) for p in sorted(phrases)], F.lit(False))

    around = {k for _, _, keyword, _ in SIGNATURES for k in keyword.split("|")}
    names = {k for _, keyword, _, _ in FAMILIES for k in keyword.split("|")}
    phrases = {phrase for _, phrase in base}
    return _let(F.lower(text), lambda low: (holds(low, around) & holds(low, names)) | holds(low, phrases))


def _words_in(piece: Column) -> Column:
    """Words of a piece that begins and ends with a space."""
    return (F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit(""))) - 1).cast("long")


def _base_places(norm: Column, n_words: Column, base: tuple) -> Column:
    """Of the phrases that occur: label, places, first and last start. A text that is split
    at a phrase has one piece more than places."""

    def places(label: str, phrase: str) -> Column:
        size = len(phrase.split())
        return _let(
            F.split(norm, f"(?<= ){phrase}(?= )", -1),
            lambda p: F.struct(
                F.lit(label).alias("label"),
                (F.size(p) - 1).cast("long").alias("n"),
                _words_in(p[0]).alias("first"),
                (n_words - _words_in(F.element_at(p, -1)) - size).alias("last"),
            ),
        )

    cut = [places(*x) for x in base]
    return F.filter(F.array(*cut), lambda x: x["n"] > 0)


HIT = "rule:int,priority:int,weight:double,label:string,start:int,end:int"


def _detections(norm: Column) -> Column:
    """Every place of every rule whose keyword the text holds."""
    table = F.array(
        *[
            F.struct(
                F.lit(i).alias("rule"),
                F.array(*map(F.lit, keyword.split("|"))).alias("keywords"),
                F.lit(priority).alias("priority"),
                F.lit(weight).alias("weight"),
                F.lit(label).alias("label"),
                F.lit(expr).alias("expr"),
            )
            for i, (keyword, priority, weight, label, expr) in enumerate(rules())
        ]
    )
    hits = F.filter(
        table,
        lambda r: F.exists(r["keywords"], lambda k: F.contains(norm, k))
        & F.call_function("rlike", norm, r["expr"]),
    )

    def places(r: Column) -> Column:
        # Place j begins after the pieces up to j and the matches before it.
        cut = F.struct(
            F.call_function("split", norm, r["expr"], F.lit(-1)).alias("p"),
            F.call_function("regexp_extract_all", norm, r["expr"], F.lit(0)).alias("m"),
        )

        def place(c: Column, j: Column) -> Column:
            before = F.length(F.array_join(F.slice(c["p"], F.lit(1), j + 1), ""))
            matched = F.slice(c["m"], F.lit(1), j)
            start = before + F.length(F.array_join(matched, ""))
            return F.struct(
                r["rule"], r["priority"], r["weight"], r["label"], start, start + F.length(c["m"][j])
            ).cast(f"struct<{HIT}>")

        return _let(
            cut, lambda c: F.transform(F.sequence(F.lit(0), F.size(c["m"]) - 1), lambda j: place(c, j))
        )

    return F.flatten(F.transform(hits, places))


def _kept(found: Column) -> Column:
    """Without the detections that lie inside, or around, one that comes before them by
    priority, length and order of the rules."""

    def order(x: Column) -> Column:
        return F.struct(x["priority"], x["start"] - x["end"], x["rule"])

    def inside(x: Column, y: Column) -> Column:
        return (y["start"] <= x["start"]) & (x["end"] <= y["end"])

    return F.filter(
        found, lambda x: ~F.exists(found, lambda y: (inside(x, y) | inside(y, x)) & (order(y) < order(x)))
    )


def scan(df: DataFrame, text: str = "text", base: tuple = BASE) -> DataFrame:
    """``df`` with n_words, n_base, first_word, last_word, base_labels, spans, labels, score.

    ``spans`` are the detections that stay: rule, priority, weight, label, and start and end
    as characters of the text's words in lower case, each with one space before it. A column
    of ``df`` that has one of these names is replaced.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    words = F.regexp_extract_all(F.translate(raw, upper, lower), F.lit(f"({WORD})"), F.lit(1))
    norm = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))

    def all_of(n: Column) -> Column:
        n_words = _words_in(n)
        return _let(
            F.struct(_base_places(n, n_words, base).alias("b"), _let(_detections(n), _kept).alias("s")),
            lambda x: F.struct(
                F.aggregate(x["b"], F.lit(0).cast("long"), lambda a, y: a + y["n"]).alias("n"),
                F.array_min(F.transform(x["b"], lambda y: y["first"])).alias("first"),
                F.array_max(F.transform(x["b"], lambda y: y["last"])).alias("last"),
                F.transform(x["b"], lambda y: y["label"]).alias("base"),
                x["s"].alias("spans"),
            ),
        )

    none = F.lit(None).cast(
        f"struct<n:bigint,first:bigint,last:bigint,base:array<string>,spans:array<struct<{HIT}>>>"
    )
    (scan_,) = free(df, "_scan")
    df = df.withColumn(scan_, F.when(_gated(raw, base), _let(norm, all_of)).otherwise(none))
    labels = F.coalesce(f"{scan_}.base", F.array().cast("array<string>"))
    spans = F.coalesce(f"{scan_}.spans", F.array().cast(f"array<struct<{HIT}>>"))
    strongest = F.greatest(
        F.coalesce(F.array_max(F.transform(spans, lambda x: x["weight"])), F.lit(0.0)),
        F.when(F.col(f"{scan_}.n") > 0, F.lit(BASE_WEIGHT)).otherwise(F.lit(0.0)),
    )
    return df.withColumns(
        {
            "n_words": F.regexp_count(raw, F.lit(WORD)).cast("long"),
            "n_base": F.coalesce(f"{scan_}.n", F.lit(0).cast("long")),
            "first_word": F.col(f"{scan_}.first"),
            "last_word": F.col(f"{scan_}.last"),
            "base_labels": F.array_join(F.array_sort(F.array_distinct(labels)), ","),
            "spans": spans,
            "labels": F.array_join(
                F.array_sort(F.array_union(labels, F.transform(spans, lambda x: x["label"]))), ","
            ),
            "score": strongest.cast("double"),
        }
    ).drop(scan_)
