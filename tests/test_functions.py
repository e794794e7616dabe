from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ludomart.functions import (
    calendar,
    clean_name,
    join_list,
    lenient_int,
    parse_dmy,
    parse_iso,
    parse_rfc822,
    primary_name,
)


def values(spark, kind, inputs, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_parse_dmy(spark):
    got = values(spark, "STRING", ["31/12/2022 23:59:59", "2022-12-31", "", None, "31/02/2022 00:00:00"], parse_dmy)
    assert got == [datetime(2022, 12, 31, 23, 59, 59), None, None, None, None]


def test_parse_iso_reads_the_zone(spark):
    got = values(
        spark,
        "STRING",
        ["2022-12-31T23:59:59.123Z", "2022-12-31T23:59:59.123+02", "soon", None],
        lambda c: parse_iso(c).cast("string"),
    )
    assert got == ["2022-12-31 23:59:59.123", "2022-12-31 21:59:59.123", None, None]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Sat, 31 Dec 2022 23:59:59 +0000", "2022-12-31 23:59:59"),
        ("Sat, 31 Dec 2022 23:59:59 -0500", "2023-01-01 04:59:59"),
        ("Sat, 31 Dec 2022 23:59:59 +0500", "2022-12-31 18:59:59"),
        ("Thu, 1 Dec 2022 00:00:00 +0000", "2022-12-01 00:00:00"),
        ("Thu, 01 Dec 2022 00:00:00 +0000", "2022-12-01 00:00:00"),
        ("yesterday", None),
        (None, None),
    ],
)
def test_parse_rfc822(spark, text, want):
    assert values(spark, "STRING", [text], lambda c: parse_rfc822(c).cast("string")) == [want]


def test_calendar(spark):
    df = spark.sql("SELECT timestamp_ntz'2023-01-01 13:05:00' AS t").select(*calendar(F.col("t")))
    # A Sunday, in the last ISO week of the year before.
    assert tuple(df.first()) == (5, 13, 1, 52, 1, 2023, 1)


def test_lenient_int(spark):
    got = values(spark, "STRING", ["1999", "1999.0", "-3500", "abc", "", None, "99999999999"], lenient_int)
    assert got == [1999, 1999, -3500, None, None, None, None]


def test_join_list(spark):
    got = values(spark, "ARRAY<STRING>", [["a", "b"], ["a", None, "c"], [], None], join_list)
    assert got == ["a,b", "a,c", "", ""]


def test_primary_name(spark):
    names = [
        [("A", None), ("B", "true")],
        [("A", "true"), ("B", "true")],
        [("A", None), ("B", None)],
        [("A", None), ("", "true")],
        [],
        None,
    ]
    got = values(
        spark, "ARRAY<STRUCT<_VALUE: STRING, _primary: STRING>>", names, primary_name
    )
    assert got == ["B", "B", "A", "A", None, None]


def test_clean_name(spark):
    names = ["Ticket-to-Ride (2nd Ed.) Brand New & Sealed!", "Ägypten  II", "Sealed", "Unsealed", None]
    assert values(spark, "STRING", names, clean_name) == [
        "ticket to ride", "ägypten ii", "", "unsealed", None,
    ]
