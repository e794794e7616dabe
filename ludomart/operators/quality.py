"""Quality rules as rows, all rules of a table from one aggregate."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    """A table failed a rule of severity ``error``."""


@dataclass(frozen=True)
class Rules:
    """What a table has to satisfy. ``warn_not_null`` columns are reported only."""

    table: str
    columns: int
    not_null: tuple[str, ...] = ()
    warn_not_null: tuple[str, ...] = ()
    ranges: Mapping[str, Column] = field(default_factory=dict)


# Column counts and required columns of the seven tables.
TABLE_RULES = {
    "bgg_games": Rules("bgg_games", 18, ("bgg_game_id",)),
    "users": Rules("users", 11, ("user_id", "user_name")),
    "atlas_games": Rules("atlas_games", 18, ("atlas_game_id",)),
    "reviews": Rules(
        "reviews", 10, ("review_id", "review_datetime"), ("user_id", "atlas_game_id", "rating")
    ),
    "prices": Rules("prices", 14, ("atlas_price_id", "price_datetime"), ("atlas_game_id",)),
    "lists": Rules(
        "lists", 11, ("list_item_id", "post_datetime"), ("geeklist_id", "bgg_game_id")
    ),
    "time": Rules("time", 8, ("datetime",)),
}


# The key of each table.
TABLE_KEYS = {
    "bgg_games": "bgg_game_id",
    "users": "user_id",
    "atlas_games": "atlas_game_id",
    "reviews": "review_id",
    "prices": "atlas_price_id",
    "lists": "list_item_id",
    "time": "datetime",
}


def same_columns(table: str, columns: list[str], expected: list[str]) -> None:
    """Raise unless a frame has the columns of its table and no other."""
    if sorted(columns) != sorted(expected):
        raise QualityError(
            f"{table}: columns missing {sorted(set(expected) - set(columns))},"
            f" not expected {sorted(set(columns) - set(expected))}"
        )


def unique_gate(df: DataFrame, table: str) -> None:
    """Raise if a key of the table is repeated."""
    key = TABLE_KEYS[table]
    found = pk_unique(df, table, key).first()
    if not found.passed:
        raise QualityError(f"{table}: {found.n_repeats} repeats of {key}")


def metrics(rules: Rules) -> list[Column]:
    """Row count, NULL counts and range violations, as aggregates of one pass."""
    return [
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in (*rules.not_null, *rules.warn_not_null)],
        *[F.count_if(~ok).alias(f"_range_{name}") for name, ok in rules.ranges.items()],
    ]


def gate_metrics(rules: Rules, columns: int, seen: Mapping[str, int]) -> int:
    """Raise if values of ``metrics`` fail a rule of severity ``error``, else the number of rows."""
    failed = [] if seen["_rows"] else [f"{rules.table}: has_rows observed 0"]
    if columns != rules.columns:
        failed.append(f"{rules.table}: column_count observed {columns}")
    failed += [f"{rules.table}: not_null {c} observed {seen[f'_null_{c}']}" for c in rules.not_null if seen[f"_null_{c}"]]
    if failed:
        raise QualityError("; ".join(failed))
    return seen["_rows"]


def check(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows (table_name, check_name, column_name, severity, passed, observed, expected).

    ``df`` is read once, for the aggregates of ``metrics``.
    """
    nulls = [(c, "error") for c in rules.not_null] + [(c, "warn") for c in rules.warn_not_null]
    counts = df.agg(*metrics(rules))

    def row(name: str, column: str | None, severity: str, passed: Column, seen: Column, want):
        return F.struct(
            F.lit(rules.table).alias("table_name"),
            F.lit(name).alias("check_name"),
            F.lit(column).cast("string").alias("column_name"),
            F.lit(severity).alias("severity"),
            passed.alias("passed"),
            seen.cast("long").alias("observed"),
            F.lit(want).cast("long").alias("expected"),
        )

    width = F.lit(len(df.columns))
    checks = [
        row("has_rows", None, "error", F.col("_rows") > 0, F.col("_rows"), None),
        row("column_count", None, "error", width == rules.columns, width, rules.columns),
    ]
    for column, severity in nulls:
        seen = F.col(f"_null_{column}")
        checks.append(row("not_null", column, severity, seen == 0, seen, 0))
    for name in rules.ranges:
        seen = F.col(f"_range_{name}")
        checks.append(row("range", name, "warn", seen == 0, seen, 0))
    return counts.select(F.inline(F.array(*checks)))


def summary(report: DataFrame) -> DataFrame:
    """Checks passed and failed per table; ``gate_open`` looks at errors only."""
    return report.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        (F.count_if(~F.col("passed") & (F.col("severity") == "error")) == 0).alias("gate_open"),
    )


def gate(report: DataFrame) -> int:
    """Raise if an error rule failed, else return the number of rows of the table.

    The report has one row per rule, so it is small on any data.
    """
    rows = report.collect()
    failed = [
        f"{r.table_name}: {r.check_name} {r.column_name or ''} observed {r.observed}"
        for r in rows
        if not r.passed and r.severity == "error"
    ]
    if failed:
        raise QualityError("; ".join(failed))
    return next(r.observed for r in rows if r.check_name == "has_rows")


def pk_unique(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows whose key is a repeat of another's."""
    return df.agg(F.count(key).alias("n_keys"), F.countDistinct(key).alias("n_distinct")).select(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("column_name"),
        (F.col("n_keys") - F.col("n_distinct")).alias("n_repeats"),
        (F.col("n_keys") == F.col("n_distinct")).alias("passed"),
    )


def coverage(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Share of fact rows that carry each dimension key, from one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(k).alias(f"_with_{k}") for k in keys]
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit(k).alias("column_name"),
                        F.col("_rows").alias("n_rows"),
                        F.col(f"_with_{k}").alias("n_with_key"),
                        (F.col(f"_with_{k}") / F.col("_rows")).alias("share"),
                    )
                    for k in keys
                ]
            )
        )
    )
