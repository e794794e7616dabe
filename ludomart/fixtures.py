"""Test tables shaped as the raw dumps.

``SHAPES`` are plain SQL over the given tables and run in Spark and in the SQL
oracle alike; every one covers its whole tables. ``raw_*`` below turn them into
what the dumps hold (text dates, nested objects, lists) on the Spark side only,
so the oracle never sees the text that the mart has to parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

SHAPES = {
    # Two crawls of every item; the second has another rating and at times no readable date.
    "shape_bgg_games": """
        SELECT p_partkey AS bgg_id, CAST(2 + p_size % 9 AS INT) AS maxplayers,
               CAST(p_size * 2 AS INT) AS maxplaytime, CAST(6 + p_size % 13 AS INT) AS age,
               CAST(1 + p_size % 4 AS INT) AS minplayers, CAST(p_size AS INT) AS minplaytime,
               p_name AS name,
               CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN 'unknown'
                    WHEN p_partkey % 10 = 2 THEN concat(1980 + p_partkey % 45, '.0')
                    ELSE CAST(1980 + p_partkey % 45 AS STRING) END AS year_published,
               p_brand AS artist, p_type AS category, CAST(NULL AS STRING) AS compilation,
               concat('Designer "', p_brand, '", ', p_type) AS designer, p_type AS family,
               concat(p_type, ',', p_brand) AS mechanic, concat(p_brand, chr(10), 'Ltd') AS publisher,
               CAST(p_partkey % 7 AS INT) AS users_rated, p_retailprice AS average_rating,
               CAST('2023-01-15 10:30:00' AS TIMESTAMP) AS extracted
        FROM part
        UNION ALL
        SELECT p_partkey, CAST(2 + p_size % 9 AS INT), CAST(p_size * 2 AS INT),
               CAST(6 + p_size % 13 AS INT), CAST(1 + p_size % 4 AS INT), CAST(p_size AS INT), p_name,
               CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN 'unknown'
                    WHEN p_partkey % 10 = 2 THEN concat(1980 + p_partkey % 45, '.0')
                    ELSE CAST(1980 + p_partkey % 45 AS STRING) END,
               p_brand, p_type, CAST(NULL AS STRING), concat('Designer "', p_brand, '", ', p_type),
               p_type, concat(p_type, ',', p_brand), concat(p_brand, chr(10), 'Ltd'),
               CAST(p_partkey % 7 AS INT), p_retailprice + 1,
               CASE WHEN p_size % 5 = 0 THEN NULL
                    ELSE CAST('2023-01-16 08:00:00' AS TIMESTAMP) END
        FROM part""",
    "shape_atlas_games": """
        SELECT concat('G', p_partkey) AS id,
               CASE WHEN p_partkey % 4 = 0 THEN concat(p_name, ' (2nd ed.)') ELSE p_name END AS name,
               concat('/game/', p_partkey) AS url,
               CASE WHEN p_size % 6 = 0 THEN NULL
                    ELSE CAST('2023-02-01 00:00:00' AS TIMESTAMP) END AS extracted,
               CAST(1980 + p_partkey % 45 AS INT) AS year_published,
               CAST(1 + p_size % 4 AS INT) AS min_players, CAST(p_size % 9 AS INT) AS max_players,
               CAST(p_size AS INT) AS min_playtime, CAST(p_size * 3 AS INT) AS max_playtime,
               CAST(p_size AS INT) AS min_age,
               CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_brand END AS publisher,
               CASE WHEN p_size % 8 = 0 THEN NULL ELSE p_type END AS designer,
               CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END AS artist1,
               CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_type END AS artist2,
               p_partkey % 11 AS num_user_ratings, p_retailprice / 8 AS average_user_rating,
               p_partkey % 5 AS num_votes, p_retailprice / 4 AS learning,
               p_retailprice / 2 AS strategy
        FROM part""",
    "shape_accounts": """
        SELECT CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 0 THEN NULL ELSE c_name END
                   AS username,
               concat('u/', c_custkey) AS url, c_mktsegment AS description, c_acctbal AS gold,
               c_custkey % 1000 AS experience, CAST(c_nationkey AS INT) AS level
        FROM customer""",
    # A third of the orders review one item, and some name no item or an unknown one.
    "shape_reviews": """
        SELECT CAST(o_orderkey AS STRING) AS id, o_orderdate AS created,
               concat(chr(CAST(97 + o_custkey % 26 AS INT)), o_custkey) AS user_id,
               CASE WHEN o_custkey % 3 = 0 THEN concat('guest', o_custkey)
                    ELSE concat('Customer#', lpad(CAST(o_custkey AS STRING), 9, '0')) END AS username,
               o_totalprice > 250000 AS is_premium, o_custkey % 5 = 0 AS is_partner,
               o_custkey % 50 = 0 AS is_moderator,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN NULL
                    WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
                        THEN concat('X', o_orderkey)
                    WHEN o_orderstatus = 'P' THEN 'G1'
                    ELSE concat('G', o_orderkey % (o_custkey + 1)) END AS game_id,
               CAST((CAST(floor(o_totalprice) AS BIGINT) % 21) * 0.25 AS DOUBLE) AS rating,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS description
        FROM orders""",
    "shape_prices": """
        SELECT concat(l_orderkey, '-', l_linenumber) AS id, l_shipdate AS updated,
               CASE WHEN l_linenumber % 3 = 0 THEN concat(p_name, ' Brand New & Sealed')
                    ELSE p_name END AS name,
               l_extendedprice / l_quantity AS price,
               CASE WHEN n_regionkey = 0 THEN 'AUD' WHEN n_regionkey = 1 THEN 'CAD'
                    WHEN n_regionkey = 3 THEN 'GBP' ELSE 'USD' END AS currency,
               p_retailprice AS msrp, concat('/buy/', l_partkey, '/', l_suppkey) AS url,
               s_name AS store_name, n_name AS country,
               CASE WHEN l_returnflag = 'A' THEN 'us' WHEN l_returnflag = 'N' THEN 'uk'
                    ELSE 'used' END AS price_category
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey""",
    # Lists hold twenty items; some items have no readable date.
    "shape_lists": """
        SELECT CAST(floor(event_id / 20) AS INT) AS geeklist_id, 'thing' AS objtype,
               CAST(p_partkey AS INT) AS game_id, p_name AS name, concat('user', user_id) AS username,
               CASE WHEN event_type = 'error' AND value < 2 THEN NULL ELSE ts END AS posted,
               concat(event_type, ': ', props, chr(10), '"', value >= 10, '", and so on') AS bodytext,
               event_type = 'view' AS western
        FROM events JOIN part ON p_partkey = event_id % (user_id + 1)""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, as it is scanned."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = SHAPES[name]
    words = set(sql.replace("(", " ").split())
    frames = {t: table(spark, sf_dir, t) for t in TABLES if t in words}
    for t in frames:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}} AS {t}").replace(
            f"JOIN {t} ", f"JOIN {{{t}}} AS {t} "
        )
    return spark.sql(sql, **frames)


def _dmy(ts: str, missing: str = "not a date") -> Column:
    return F.coalesce(F.date_format(ts, "dd/MM/yyyy HH:mm:ss"), F.lit(missing))


def _iso(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def raw_bgg_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = _shape(spark, sf_dir, "shape_bgg_games")
    return games.withColumns(
        {"bgg_id": F.col("bgg_id").cast("int"), "datetime_extracted": _dmy("extracted")}
    ).drop("extracted")


def raw_atlas_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    artists = F.array("artist1", "artist2")
    return _shape(spark, sf_dir, "shape_atlas_games").select(
        "id",
        "name",
        "url",
        _dmy("extracted").alias("datetime_extracted"),
        "year_published",
        "min_players",
        "max_players",
        "min_playtime",
        "max_playtime",
        "min_age",
        F.when(F.col("publisher").isNotNull(), F.struct(F.col("publisher").alias("name"))).alias(
            "primary_publisher"
        ),
        F.struct(F.col("designer").alias("name")).alias("primary_designer"),
        F.when(F.col("artist1").isNotNull() | F.col("artist2").isNotNull(), artists).alias("artists"),
        "num_user_ratings",
        "average_user_rating",
        F.col("num_votes").alias("num_user_complexity_votes"),
        F.col("learning").alias("average_learning_complexity"),
        F.col("strategy").alias("average_strategy_complexity"),
    )


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(spark, sf_dir, "shape_accounts")


def raw_nested_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as harvested, with user and game objects."""
    return _shape(spark, sf_dir, "shape_reviews").select(
        "id",
        _iso("created").alias("createdAt"),
        _iso("created").alias("date"),
        F.struct(
            F.col("user_id").alias("id"), "username", "is_premium", "is_partner", "is_moderator"
        ).alias("user"),
        F.struct(F.col("game_id").alias("id")).alias("game"),
        "rating",
        "description",
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(spark, sf_dir, "shape_reviews").select(
        "id",
        _iso("created").alias("createdAt"),
        _iso("created").alias("date"),
        "user_id",
        "game_id",
        "rating",
        "description",
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(spark, sf_dir, "shape_prices").select(
        "id",
        _iso("updated").alias("updated_at"),
        "name",
        "price",
        "currency",
        "msrp",
        "url",
        "store_name",
        "country",
        "price_category",
    )


def raw_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates are written in two zones; a missing one becomes unreadable text."""
    style = "EEE, dd MMM yyyy HH:mm:ss"
    utc = F.concat(F.date_format("posted", style), F.lit(" +0000"))
    west = F.concat(F.date_format(F.expr("posted - INTERVAL 5 HOURS"), style), F.lit(" -0500"))
    return _shape(spark, sf_dir, "shape_lists").select(
        F.col("geeklist_id").cast("string").alias("geeklist_id"),
        "objtype",
        F.col("game_id").cast("string").alias("game_id"),
        "name",
        F.col("username").alias("user"),
        F.coalesce(F.when(F.col("western"), west).otherwise(utc), F.lit("some day")).alias("postdate"),
        "bodytext",
    )
