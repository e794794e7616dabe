"""Harvested payloads (XML, JSON, maps of lists) to the raw frames of the mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludomart.functions import join_list, primary_name
from ludomart.operators import dedupe_pk
from ludomart.schemas import PRICE_PAYLOAD, XML_LIST
from ludomart.sources import read_json_split

# The rating scale, 0 to 5 in quarter steps.
RATING_STEP = 0.25
RATING_CELLS = 21
# Fixed value: the harvest cannot page past this many reviews per user and rating.
PAGE_LIMIT = 900


def stamp_extracted(df: DataFrame, at: str) -> DataFrame:
    """Add the extraction time (``dd/MM/yyyy HH:mm:ss`` text), given by the caller so
    that a rerun gives the same rows."""
    return df.withColumn("datetime_extracted", F.lit(at))


def xml_games(games: DataFrame) -> DataFrame:
    """Rows of ``schemas.XML_GAME`` to the columns of the games dump. Elements without
    attributes (no id) are no games."""

    def values(tag: str) -> Column:
        return join_list(F.col(tag))

    return games.filter(F.col("_objectid").isNotNull()).select(
        F.col("_objectid").try_cast("int").alias("bgg_id"),
        F.col("maxplayers").try_cast("int").alias("maxplayers"),
        F.col("maxplaytime").try_cast("int").alias("maxplaytime"),
        F.col("age").try_cast("int").alias("age"),
        F.col("minplayers").try_cast("int").alias("minplayers"),
        F.col("minplaytime").try_cast("int").alias("minplaytime"),
        primary_name(F.col("name")).alias("name"),
        F.col("yearpublished").alias("year_published"),
        values("boardgameartist").alias("artist"),
        values("boardgamecategory").alias("category"),
        values("boardgamecompilation").alias("compilation"),
        values("boardgamedesigner").alias("designer"),
        values("boardgamefamily").alias("family"),
        values("boardgamemechanic").alias("mechanic"),
        values("boardgamepublisher").alias("publisher"),
        F.col("statistics.ratings.usersrated").try_cast("int").alias("users_rated"),
        F.col("statistics.ratings.average").try_cast("double").alias("average_rating"),
    )


def xml_list_items(documents: DataFrame, text: str = "value") -> DataFrame:
    """One row per item of each list document, given as text."""
    return list_items(documents.select(F.from_xml(F.col(text), XML_LIST).alias("list")).select("list.*"))


def list_items(lists: DataFrame) -> DataFrame:
    """One row per item of each list of ``schemas.XML_LIST``, the list id pushed down. Items
    without attributes are skipped."""
    return (
        lists.select(F.col("_id").alias("geeklist_id"), F.explode("item").alias("item"))
        .filter(
            F.coalesce(
                F.col("item._subtype"),
                F.col("item._objectid"),
                F.col("item._objectname"),
                F.col("item._username"),
                F.col("item._postdate"),
            ).isNotNull()
        )
        .select(
            "geeklist_id",
            F.col("item._subtype").alias("objtype"),
            F.col("item._objectid").alias("game_id"),
            F.col("item._objectname").alias("name"),
            F.col("item._username").alias("user"),
            F.col("item._postdate").alias("postdate"),
            F.col("item.body").alias("bodytext"),
        )
    )


def union_parts(*parts: DataFrame) -> DataFrame:
    """Batches of a harvest under one another, by column name."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    return every


def split_reviews(raw: DataFrame) -> DataFrame:
    """Nested user and game objects of raw reviews replaced by their ids."""
    return raw.withColumns({"user_id": F.col("user.id"), "game_id": F.col("game.id")}).drop(
        "user", "game"
    )


def latest_user_profile(raw: DataFrame) -> DataFrame:
    """Each user's profile as of their latest review, ties to the highest review id.
    Reviews without a readable date come last."""
    profiles = raw.select(
        "user.*",
        F.try_to_timestamp(F.col("date")).alias("_date"),
        F.col("id").alias("_review"),
    )
    order = [F.col("_date").desc_nulls_last(), F.col("_review").desc_nulls_last()]
    return dedupe_pk(profiles, "id", order).drop("_date", "_review")


def distinct_game_ids(reviews: DataFrame) -> DataFrame:
    """Ids of the games that have reviews."""
    return reviews.filter(F.col("game_id").isNotNull()).select("game_id").distinct()


def new_ids(wanted: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Ids wanted and not landed yet."""
    return wanted.join(landed.select(key).filter(F.col(key).isNotNull()), key, "left_anti")


def explode_prices(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """Payload text (map category -> list of prices) to price rows tagged with the category."""
    by_category = payloads.select(
        F.explode(F.from_json(F.col(text), PRICE_PAYLOAD)).alias("price_category", "items")
    )
    return by_category.select(F.inline("items"), "price_category")


def users_with_name(users: DataFrame) -> DataFrame:
    """Harvested users that have a name."""
    return users.filter(F.col("username").isNotNull())


def rating_grid(users: DataFrame) -> DataFrame:
    """Every user with every rating of the scale. Each row is exploded into the fixed
    scale, which needs no join."""
    cells = F.sequence(F.lit(0), F.lit(RATING_CELLS - 1))
    return users.select("username", F.explode(cells).alias("_cell")).select(
        "username", (F.col("_cell") * F.lit(RATING_STEP)).alias("rating")
    )


def truncation_audit(users: DataFrame, reviews: DataFrame, limit: int = PAGE_LIMIT) -> DataFrame:
    """Reviews per user and rating cell, flagged where the harvest may have stopped short.

    Reviews are counted per cell before the join.
    """
    counts = (
        reviews.filter(F.col("username").isNotNull())
        .groupBy("username", "rating")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n = F.coalesce("n", F.lit(0))
    return (
        rating_grid(users)
        .join(counts, ["username", "rating"], "left")
        .select("username", "rating", n.alias("n_reviews"), (n > limit).alias("truncated"))
    )


def file_letter(path: Column) -> Column:
    """First character of the name of the file at ``path``. Spark gives the name as
    in a URL, but for plus signs."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.substring(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), 1, 1)


def compact_json(
    spark: SparkSession, source: str, target: str, schema: str, letter: Column | None = None
) -> None:
    """Many small JSON files into JSON lines per first letter of the file name.

    Written to another folder, so a rerun never reads its own output. JSON lines
    split, unlike arrays. ``rebalance`` keeps a letter's files few and still spreads
    a letter that holds most rows.
    """
    rows = read_json_split(spark, source, schema, file="_path")
    rows = rows.withColumn("letter", file_letter(F.col("_path")) if letter is None else letter).drop("_path")
    rows.hint("rebalance", "letter").write.mode("overwrite").partitionBy("letter").json(target)


def count_json_records(spark: SparkSession, root: str) -> DataFrame:
    """Records per dataset folder in a tree of JSON files."""
    records = read_json_split(spark, root, "id STRING", recursive=True, file="_path")
    below = F.substring_index("_path", root.rstrip("/") + "/", -1)
    return (
        records.select(F.substring_index(below, "/", 1).alias("dataset"))
        .groupBy("dataset")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
