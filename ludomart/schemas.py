"""Fixed schemas of the raw dumps, so that no read runs an inference job."""

from __future__ import annotations

# Field names and types of the raw dumps.
BGG_GAMES = """
    bgg_id INT, maxplayers INT, maxplaytime INT, age INT, minplayers INT, minplaytime INT,
    name STRING, year_published STRING, artist STRING, category STRING, compilation STRING,
    designer STRING, family STRING, mechanic STRING, publisher STRING, users_rated INT,
    average_rating DOUBLE, datetime_extracted STRING
"""
BGG_LISTS = """
    geeklist_id STRING, objtype STRING, game_id STRING, name STRING, user STRING,
    postdate STRING, bodytext STRING
"""
ATLAS_USERS = """
    username STRING, url STRING, description STRING, gold DOUBLE, experience BIGINT, level INT
"""
ATLAS_PROFILES = """
    id STRING, username STRING, is_premium BOOLEAN, is_partner BOOLEAN, is_moderator BOOLEAN
"""
ATLAS_GAMES = """
    id STRING, name STRING, url STRING, datetime_extracted STRING, year_published INT,
    min_players INT, max_players INT, min_playtime INT, max_playtime INT, min_age INT,
    primary_publisher STRUCT<name: STRING>, primary_designer STRUCT<name: STRING>,
    artists ARRAY<STRING>, num_user_ratings BIGINT, average_user_rating DOUBLE,
    num_user_complexity_votes BIGINT, average_learning_complexity DOUBLE,
    average_strategy_complexity DOUBLE
"""
ATLAS_REVIEWS = """
    id STRING, createdAt STRING, date STRING, user_id STRING, game_id STRING, rating DOUBLE,
    description STRING
"""
ATLAS_RAW_REVIEWS = """
    id STRING, createdAt STRING, date STRING,
    user STRUCT<id: STRING, username: STRING, is_premium: BOOLEAN, is_partner: BOOLEAN,
                is_moderator: BOOLEAN>,
    game STRUCT<id: STRING>, rating DOUBLE, description STRING
"""
ATLAS_PRICES = """
    id STRING, updated_at STRING, name STRING, price DOUBLE, currency STRING, msrp DOUBLE,
    url STRING, store_name STRING, country STRING, price_category STRING
"""
PRICE_PAYLOAD = """
    MAP<STRING, ARRAY<STRUCT<id: STRING, updated_at: STRING, name: STRING, price: DOUBLE,
        currency: STRING, msrp: DOUBLE, url: STRING, store_name: STRING, country: STRING>>>
"""

# Multi-value XML elements are arrays by schema: inference would make a struct of a
# lone child.
_XML_VALUES = (
    "boardgameartist",
    "boardgamecategory",
    "boardgamecompilation",
    "boardgamedesigner",
    "boardgamefamily",
    "boardgamemechanic",
    "boardgamepublisher",
)
XML_GAME = (
    "_objectid STRING, name ARRAY<STRUCT<_VALUE: STRING, _primary: STRING>>, maxplayers STRING,"
    " maxplaytime STRING, age STRING, minplayers STRING, minplaytime STRING, yearpublished STRING, "
    + ", ".join(f"{v} ARRAY<STRING>" for v in _XML_VALUES)
    + ", statistics STRUCT<ratings: STRUCT<usersrated: STRING, average: STRING>>"
)
XML_LIST = """
    _id STRING, item ARRAY<STRUCT<_subtype: STRING, _objectid: STRING, _objectname: STRING,
        _username: STRING, _postdate: STRING, body: STRING>>
"""

# Columns of the seven tables in write order, and their partitioning.
TABLES = {
    "bgg_games": [
        "bgg_game_id", "max_players", "max_playtime", "min_age", "min_players", "min_playtime",
        "game_name", "year_published", "artist", "category", "compilation", "designer", "family",
        "mechanic", "publisher", "num_ratings", "average_rating", "datetime_extracted",
    ],
    "users": [
        "user_name", "url", "description", "atlas_gold", "atlas_exp", "atlas_level",
        "atlas_user_id", "atlas_premium", "atlas_partner", "atlas_moderator", "user_id",
    ],
    "atlas_games": [
        "atlas_game_id", "game_name", "url", "datetime_extracted", "year_published",
        "min_players", "max_players", "min_playtime", "max_playtime", "min_age",
        "primary_publisher", "primary_designer", "artists", "num_ratings", "average_rating",
        "num_complexity", "average_learning_complexity", "average_strategy_complexity",
    ],
    "reviews": [
        "game_name", "atlas_game_id", "review_id", "review_datetime", "rating", "description",
        "year", "month", "bgg_game_id", "user_id",
    ],
    "prices": [
        "game_name", "atlas_price_id", "price_datetime", "price", "currency", "msrp", "url",
        "store_name", "country", "price_category", "year", "month", "atlas_game_id",
        "bgg_game_id",
    ],
    "lists": [
        "game_name", "geeklist_id", "objtype", "bgg_game_id", "bgg_user_name", "post_datetime",
        "description", "list_item_id", "year", "month", "atlas_game_id",
    ],
    "time": ["datetime", "minute", "hour", "day", "week", "month", "year", "weekday"],
}
# Columns that partition the tables.
PARTITIONS = {
    "bgg_games": ["year_published"],
    "users": ["atlas_level"],
    "atlas_games": ["year_published"],
    "reviews": ["year", "month"],
    "prices": ["year", "month"],
    "lists": ["year", "month"],
    "time": ["year", "month"],
}
