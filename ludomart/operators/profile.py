"""Profiles of a frame in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def describe(df: DataFrame) -> DataFrame:
    """Rows (column_name, stat, value): count, mean, stddev, min, max as text.

    Covers numeric and text columns, like ``DataFrame.describe``; mean and stddev
    have five decimals and are NULL for text. One aggregate over one scan.
    """
    fields = [
        f for f in df.schema.fields if isinstance(f.dataType, T.NumericType | T.StringType)
    ]
    aggs, cells = [], []
    for i, f in enumerate(fields):
        col = F.col(f.name)
        numeric = isinstance(f.dataType, T.NumericType)
        aggs += [F.count(col).alias(f"n{i}"), F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}")]
        if numeric:
            aggs += [F.avg(col).alias(f"mean{i}"), F.stddev_samp(col).alias(f"sd{i}")]
        stats = {
            "count": F.col(f"n{i}").cast("string"),
            "mean": F.format_string("%.5f", f"mean{i}") if numeric else F.lit(None),
            "stddev": F.format_string("%.5f", f"sd{i}") if numeric else F.lit(None),
            "min": F.col(f"lo{i}").cast("string"),
            "max": F.col(f"hi{i}").cast("string"),
        }
        cells += [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(stat).alias("stat"),
                value.cast("string").alias("value"),
            )
            for stat, value in stats.items()
        ]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def schema_rows(df: DataFrame) -> DataFrame:
    """Rows (column_name, data_type, n_values): the schema and how filled each column is."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col(f.name).alias("n_values"),
                    )
                    for f in df.schema.fields
                ]
            )
        )
    )


def first_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by key: a top-n per task, then a merge of those."""
    return df.orderBy(key).limit(n)
