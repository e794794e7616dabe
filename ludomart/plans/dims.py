"""The four dimensions: raw frame in, table frame out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludomart.functions import calendar, join_list, lenient_int, parse_dmy
from ludomart.operators import dedupe_pk, dense_id

# Raw column -> table column.
BGG_NAMES = {
    "bgg_id": "bgg_game_id",
    "maxplayers": "max_players",
    "maxplaytime": "max_playtime",
    "age": "min_age",
    "minplayers": "min_players",
    "minplaytime": "min_playtime",
    "name": "game_name",
    "users_rated": "num_ratings",
}


def bgg_details(raw: DataFrame) -> DataFrame:
    """One row per game; of several crawls the latest extraction stays."""
    games = raw.withColumnsRenamed(BGG_NAMES).withColumns(
        {
            "year_published": lenient_int(F.col("year_published")),
            "datetime_extracted": parse_dmy(F.col("datetime_extracted")),
        }
    )
    return dedupe_pk(games, "bgg_game_id", [F.col("datetime_extracted").desc_nulls_last()])


def atlas_details(raw: DataFrame) -> DataFrame:
    """One row per game of the second source; nested names flattened."""
    # Raw field -> table column.
    games = raw.select(
        F.col("id").alias("atlas_game_id"),
        F.col("name").alias("game_name"),
        "url",
        parse_dmy(F.col("datetime_extracted")).alias("datetime_extracted"),
        "year_published",
        "min_players",
        "max_players",
        "min_playtime",
        "max_playtime",
        "min_age",
        F.col("primary_publisher.name").alias("primary_publisher"),
        F.col("primary_designer.name").alias("primary_designer"),
        join_list(F.col("artists")).alias("artists"),
        F.col("num_user_ratings").alias("num_ratings"),
        F.col("average_user_rating").alias("average_rating"),
        F.col("num_user_complexity_votes").alias("num_complexity"),
        "average_learning_complexity",
        "average_strategy_complexity",
    )
    return dedupe_pk(games, "atlas_game_id", [F.col("datetime_extracted").desc_nulls_last()])


def user_accounts(raw: DataFrame) -> DataFrame:
    """Account list, one row per user name; of copies the most experienced stays."""
    # Raw field -> table column.
    accounts = raw.select(
        F.col("username").alias("user_name"),
        "url",
        "description",
        F.col("gold").alias("atlas_gold"),
        F.col("experience").alias("atlas_exp"),
        F.col("level").alias("atlas_level"),
    )
    return dedupe_pk(accounts, "user_name", [F.col("atlas_exp").desc_nulls_last()])


def user_profiles(raw: DataFrame) -> DataFrame:
    """Profiles seen with reviews, one row per id."""
    # Raw field -> table column.
    profiles = raw.select(
        F.col("id").alias("atlas_user_id"),
        F.col("is_premium").alias("atlas_premium"),
        F.col("is_partner").alias("atlas_partner"),
        F.col("is_moderator").alias("atlas_moderator"),
        F.col("username").alias("user_name"),
    )
    return dedupe_pk(profiles, "atlas_user_id")


def join_users(accounts: DataFrame, profiles: DataFrame) -> DataFrame:
    """Accounts left join profiles on the name.

    A name held by several ids gives one row per id, so the profiles can be the
    lopsided side, which an outer join may not split. Hence an inner join, where
    AQE splits either side, and the accounts without a profile beside it.
    """
    matched = accounts.join(profiles, "user_name")
    columns = accounts.columns + [c for c in profiles.columns if c != "user_name"]
    alone = accounts.join(profiles.select("user_name").distinct(), "user_name", "left_anti")
    return matched.select(*columns).unionByName(alone, allowMissingColumns=True)


def atlas_users(raw_accounts: DataFrame, raw_profiles: DataFrame) -> DataFrame:
    """Users with the surrogate ``user_id`` 0..n-1 in order of (name, id)."""
    users = join_users(user_accounts(raw_accounts), user_profiles(raw_profiles))
    return dense_id(users, ["user_name", "atlas_user_id"], "user_id")


def time(*datetimes: DataFrame) -> DataFrame:
    """Calendar rows for every distinct value of the given one-column frames. Each map
    task sends its distinct values only, over one exchange for all frames."""
    every = datetimes[0].toDF("datetime")
    for more in datetimes[1:]:
        every = every.union(more)
    ts = F.col("datetime")
    return every.distinct().select(ts, *calendar(ts))
