"""The three facts: raw frame and dimensions in, table frame out.

Each fact is parsed first and gets its keys after; the parsed half is its own
function because some questions need no keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludomart.functions import lenient_int, parse_iso, parse_rfc822
from ludomart.operators import dedupe_name, dedupe_pk, dense_id, lookup
from ludomart.schemas import TABLES


def reviews_parsed(raw: DataFrame) -> DataFrame:
    """One row per review id. Rows without id or date are dropped before the
    dedupe, so that a copy without a date cannot displace a dated one."""
    # Raw field -> table column.
    rows = raw.select(
        F.col("id").alias("review_id"),
        F.col("createdAt").alias("created"),
        F.col("user_id").alias("atlas_user_id"),
        F.col("game_id").alias("atlas_game_id"),
        "rating",
        "description",
    ).dropna(subset=["review_id", "created"])
    stamped = rows.withColumn("review_datetime", parse_iso(F.col("created"))).drop("created")
    return dedupe_pk(
        stamped, "review_id", [F.col("review_datetime").desc_nulls_last()]
    ).withColumns({"year": F.year("review_datetime"), "month": F.month("review_datetime")})


def reviews_named(raw: DataFrame, games: DataFrame) -> DataFrame:
    """Reviews with the game name, by game id."""
    return lookup(
        reviews_parsed(raw), games, "atlas_game_id", ["game_name"], spread_by=["review_id"]
    )


def reviews(raw: DataFrame, games: DataFrame, bgg: DataFrame, users: DataFrame) -> DataFrame:
    """Reviews with game name, the other source's id by name, and ``user_id``. The name and
    what hangs on it are put together among the games, so the reviews meet the games once."""
    ids = dedupe_name(bgg, "game_name", "bgg_game_id")
    own = games.select("atlas_game_id", "game_name")
    named = lookup(own, ids, "game_name", ["bgg_game_id"], spread_by=["atlas_game_id"])
    columns = ["game_name", "bgg_game_id"]
    keyed = lookup(reviews_parsed(raw), named, "atlas_game_id", columns, spread_by=["review_id"])
    with_user = lookup(keyed, users, "atlas_user_id", ["user_id"], spread_by=["review_id"])
    return with_user.select(*TABLES["reviews"])


def prices_parsed(raw: DataFrame) -> DataFrame:
    """One row per price id: the newest, then the first category in order."""
    # Raw field -> table column.
    rows = raw.select(
        F.col("id").alias("atlas_price_id"),
        F.col("updated_at").alias("updated"),
        F.col("name").alias("game_name"),
        "price",
        "currency",
        "msrp",
        "url",
        "store_name",
        "country",
        "price_category",
    ).dropna(subset=["atlas_price_id", "updated"])
    stamped = rows.withColumn("price_datetime", parse_iso(F.col("updated"))).drop("updated")
    order = [F.col("price_datetime").desc_nulls_last(), F.col("price_category").asc_nulls_first()]
    return dedupe_pk(stamped, "atlas_price_id", order).withColumns(
        {"year": F.year("price_datetime"), "month": F.month("price_datetime")}
    )


def ids_by_name(games: DataFrame, bgg: DataFrame) -> DataFrame:
    """The lowest id of each source by name, for the names of either."""
    atlas_ids = dedupe_name(games, "game_name", "atlas_game_id")
    return atlas_ids.join(dedupe_name(bgg, "game_name", "bgg_game_id"), "game_name", "full")


def prices_keyed(parsed: DataFrame, ids: DataFrame) -> DataFrame:
    """Parsed prices with ``ids_by_name``, which they meet once for both sources."""
    columns = ["atlas_game_id", "bgg_game_id"]
    keyed = lookup(parsed, ids, "game_name", columns, spread_by=["atlas_price_id"])
    return keyed.select(*TABLES["prices"])


def prices(raw: DataFrame, games: DataFrame, bgg: DataFrame) -> DataFrame:
    """Prices with the ids of both sources, by exact name."""
    return prices_keyed(prices_parsed(raw), ids_by_name(games, bgg))


def lists_parsed(raw: DataFrame) -> DataFrame:
    """List items with a list id and a readable date. Takes either column name that
    the harvest has used for the list id."""
    # Raw field -> table column.
    rows = raw.withColumnsRenamed(
        {
            "geeklist": "geeklist_id",
            "game_id": "bgg_game_id",
            "name": "game_name",
            "user": "bgg_user_name",
            "postdate": "post_datetime",
            "bodytext": "description",
        }
    )
    typed = rows.withColumns(
        {
            "post_datetime": parse_rfc822(F.col("post_datetime")),
            "geeklist_id": lenient_int(F.col("geeklist_id")),
            "bgg_game_id": lenient_int(F.col("bgg_game_id")),
        }
    ).dropna(subset=["geeklist_id", "post_datetime"])
    return typed.withColumns({"year": F.year("post_datetime"), "month": F.month("post_datetime")})


# Business key of a list item.
LIST_ITEM_ORDER = ["geeklist_id", "post_datetime", "bgg_game_id", "bgg_user_name"]


def lists(raw: DataFrame, games: DataFrame) -> DataFrame:
    """List items with ``list_item_id`` 0..n-1 and the other source's id by name."""
    return lists_keyed(lists_parsed(raw), games)


def lists_keyed(parsed: DataFrame, games: DataFrame) -> DataFrame:
    """Parsed list items with ids. They are read twice, as their order is sampled first."""
    numbered = dense_id(parsed, LIST_ITEM_ORDER, "list_item_id")
    atlas_ids = dedupe_name(games, "game_name", "atlas_game_id")
    keyed = lookup(
        numbered, atlas_ids, "game_name", ["atlas_game_id"], spread_by=["list_item_id"]
    )
    return keyed.select(*TABLES["lists"])
