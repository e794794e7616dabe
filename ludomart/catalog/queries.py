"""One query per operator, over whole tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludomart import fixtures as fx
from ludomart import schemas as S
from ludomart.functions import (
    calendar,
    join_list,
    lenient_int,
    parse_dmy,
    parse_iso,
    parse_rfc822,
    primary_name,
)
from ludomart.operators import batch_ids, dedupe_name, dedupe_pk, dense_id, lookup, profile, quality
from ludomart.operators.ordering import ordered_blocks, sorted_ranges
from ludomart.plans import dims, facts, harvest, insights, landing, pipeline
from ludomart.session import empty, freeing_shuffles, tune, workspace
from ludomart.sources import (
    read_csv_split,
    read_json_split,
    read_table,
    read_xml,
    write_csv,
    write_json_arrays,
    write_table,
    write_xml,
)
from ludomart.sources.sinks import PACKED
from ludomart.streaming import incremental_reviews as stream_reviews

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name, less a trailing underscore (for names that
    would hide an operator). Times leave as wall-clock UTC, the type the given tables
    have."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        df = fn(spark, sf_dir)
        return df.withColumns(
            {
                f.name: F.col(f.name).cast("timestamp_ntz")
                for f in df.schema.fields
                if isinstance(f.dataType, T.TimestampType)
            }
        )

    QUERIES[fn.__name__.rstrip("_")] = run
    return fn


# --- table frames over the test tables -------------------------------------------------


def bgg_games(spark: SparkSession, d: str) -> DataFrame:
    return dims.bgg_details(fx.raw_bgg_games(spark, d))


def atlas_games(spark: SparkSession, d: str) -> DataFrame:
    return dims.atlas_details(fx.raw_atlas_games(spark, d))


def profiles(spark: SparkSession, d: str) -> DataFrame:
    return landing.latest_user_profile(fx.raw_nested_reviews(spark, d))


def users(spark: SparkSession, d: str) -> DataFrame:
    return dims.atlas_users(fx.raw_accounts(spark, d), profiles(spark, d))


def reviews(spark: SparkSession, d: str) -> DataFrame:
    return facts.reviews(
        fx.raw_reviews(spark, d), atlas_games(spark, d), bgg_games(spark, d), users(spark, d)
    )


def reviews_by_game(spark: SparkSession, d: str) -> DataFrame:
    """Reviews without the user key, for questions that do not need it."""
    named = facts.reviews_named(fx.raw_reviews(spark, d), atlas_games(spark, d))
    ids = dedupe_name(bgg_games(spark, d), "game_name", "bgg_game_id")
    return lookup(named, ids, "game_name", ["bgg_game_id"], spread_by=["review_id"])


def prices(spark: SparkSession, d: str) -> DataFrame:
    return facts.prices(fx.raw_prices(spark, d), atlas_games(spark, d), bgg_games(spark, d))


def lists(spark: SparkSession, d: str) -> DataFrame:
    return facts.lists(fx.raw_lists(spark, d), atlas_games(spark, d))


def time(spark: SparkSession, d: str) -> DataFrame:
    return dims.time(
        facts.reviews_parsed(fx.raw_reviews(spark, d)).select("review_datetime"),
        facts.prices_parsed(fx.raw_prices(spark, d)).select("price_datetime"),
        facts.lists_parsed(fx.raw_lists(spark, d)).select("post_datetime"),
    )


FRAMES = {
    "bgg_games": bgg_games,
    "users": users,
    "atlas_games": atlas_games,
    "reviews": reviews,
    "prices": prices,
    "lists": lists,
    "time": time,
}


# --- scans and sinks -------------------------------------------------------------------


@query
def scan_csv(spark, d):
    path = workspace(spark, "csv")
    write_csv(fx.table(spark, d, "part"), path)
    schema = (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
        " p_retailprice DOUBLE"
    )
    return read_csv_split(spark, path, schema)


@query
def scan_csv_multiline(spark, d):
    """The documents as CSV files without a bound on their rows; ranges of them are read."""
    path = workspace(spark, "csv")
    write_csv(fx.table(spark, d, "documents"), path, rows_per_file=0)
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    return read_csv_split(spark, path, schema)


@query
def scan_json_array(spark, d):
    path = workspace(spark, "json")
    write_json_arrays(fx.raw_accounts(spark, d), path)
    return read_json_split(spark, path, S.ATLAS_USERS)


@query
def scan_json_glob(spark, d):
    path = workspace(spark, "json")
    write_json_arrays(fx.raw_reviews(spark, d), path)
    return read_json_split(spark, f"{path}/*.txt", S.ATLAS_REVIEWS)


@query
def scan_json_nested_glob(spark, d):
    root = workspace(spark, "json")
    write_json_arrays(fx.raw_prices(spark, d), root, folder="price_category")
    rows = read_json_split(spark, f"{root}/*/*.txt", S.ATLAS_PRICES, file="folder")
    return rows.withColumn("folder", F.regexp_extract("folder", r"folder=([^/]+)/[^/]+$", 1))


@query
def scan_parquet(spark, d):
    return fx.table(spark, d, "part").select(
        F.col("p_partkey").alias("bgg_game_id"), F.col("p_name").alias("game_name")
    )


@query
def sink_parquet_by_col(spark, d):
    path = workspace(spark, "table")
    write_table(bgg_games(spark, d), path, S.PARTITIONS["bgg_games"])
    return spark.read.parquet(path).select(*S.TABLES["bgg_games"])


@query
def sink_parquet_by_month(spark, d):
    path = workspace(spark, "table")
    write_table(facts.prices_parsed(fx.raw_prices(spark, d)), path, S.PARTITIONS["prices"])
    return spark.read.parquet(path)


# --- projections and filters -----------------------------------------------------------


@query
def project_alias(spark, d):
    return fx.raw_accounts(spark, d).select(
        F.col("username").alias("user_name"),
        "url",
        "description",
        F.col("gold").alias("atlas_gold"),
        F.col("experience").alias("atlas_exp"),
        F.col("level").alias("atlas_level"),
    )


@query
def project_nested_field(spark, d):
    return fx.raw_atlas_games(spark, d).select(
        F.col("id").alias("atlas_game_id"),
        F.col("primary_publisher.name").alias("primary_publisher"),
        F.col("primary_designer.name").alias("primary_designer"),
    )


@query
def rename_columns(spark, d):
    return fx.raw_bgg_games(spark, d).withColumnsRenamed(dims.BGG_NAMES)


@query
def derive_columns(spark, d):
    return fx.raw_prices(spark, d).select("id", "updated_at").withColumns(
        {
            "price_datetime": parse_iso(F.col("updated_at")),
            "year": F.year(parse_iso(F.col("updated_at"))),
            "month": F.month(parse_iso(F.col("updated_at"))),
        }
    ).drop("updated_at")


@query
def drop_column(spark, d):
    return fx.table(spark, d, "customer").drop("c_acctbal", "c_nationkey")


@query
def cast_lenient(spark, d):
    return fx.raw_bgg_games(spark, d).select(
        "bgg_id", lenient_int(F.col("year_published")).alias("year_published")
    )


@query
def drop_null_keys(spark, d):
    return fx.raw_accounts(spark, d).dropna(subset=["username"]).select("username", "url")


@query
def filter_is_null(spark, d):
    return fx.raw_reviews(spark, d).filter(F.col("game_id").isNull()).select("id", "user_id")


@query
def stamp_extracted(spark, d):
    games = fx.table(spark, d, "part").select(F.col("p_partkey").alias("bgg_id"))
    return landing.stamp_extracted(games, "15/01/2023 10:30:00")


# --- joins -----------------------------------------------------------------------------


@query
def join_users_left(spark, d):
    return dims.join_users(
        dims.user_accounts(fx.raw_accounts(spark, d)), dims.user_profiles(profiles(spark, d))
    )


@query
def lookup_game_name(spark, d):
    return facts.reviews_named(fx.raw_reviews(spark, d), atlas_games(spark, d)).select(
        "review_id", "atlas_game_id", "game_name"
    )


@query
def lookup_by_name(spark, d):
    ids = dedupe_name(atlas_games(spark, d), "game_name", "atlas_game_id")
    priced = facts.prices_parsed(fx.raw_prices(spark, d)).select("atlas_price_id", "game_name")
    return lookup(priced, ids, "game_name", ["atlas_game_id"], spread_by=["atlas_price_id"])


@query
def replace_with_surrogate(spark, d):
    keyed = lookup(
        facts.reviews_parsed(fx.raw_reviews(spark, d)),
        users(spark, d),
        "atlas_user_id",
        ["user_id"],
        spread_by=["review_id"],
    )
    return keyed.drop("atlas_user_id").select("review_id", "user_id", "rating")


@query
def antijoin_new_ids(spark, d):
    wanted = landing.distinct_game_ids(fx.raw_reviews(spark, d))
    landed = prices(spark, d).select(F.col("atlas_game_id").alias("game_id"))
    return landing.new_ids(wanted, landed, "game_id")


@query
def crossjoin_rating_grid(spark, d):
    return landing.rating_grid(landing.users_with_name(fx.raw_accounts(spark, d)))


@query
def join_time_dim(spark, d):
    posted = facts.lists_parsed(fx.raw_lists(spark, d))
    time = dims.time(posted.select("post_datetime"))
    return (
        posted.join(
            time.select("datetime", "weekday", "hour"), F.col("post_datetime") == F.col("datetime")
        )
        .groupBy("weekday", "hour")
        .agg(F.count(F.lit(1)).alias("n_items"))
    )


# --- aggregates, dedupe, set operations ------------------------------------------------


@query
def dedupe_pk_(spark, d):
    return dedupe_pk(
        fx.table(spark, d, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"
        ),
        ["l_orderkey", "l_linenumber"],
        [F.col("l_shipdate").desc(), F.col("l_partkey").desc()],
    )


@query
def dedupe_name_lookup(spark, d):
    return dedupe_name(bgg_games(spark, d), "game_name", "bgg_game_id")


@query
def distinct_datetimes(spark, d):
    return fx.table(spark, d, "orders").select(F.col("o_orderdate").alias("datetime")).distinct()


@query
def count_rows(spark, d):
    return fx.table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def count_nulls(spark, d):
    raw = fx.raw_reviews(spark, d)
    return raw.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in raw.columns]
    )


@query
def describe_profile(spark, d):
    return profile.describe(fx.table(spark, d, "lineitem"))


@query
def profile_tables(spark, d):
    """Every number and text of all seven tables."""
    return landing.union_parts(
        *[profile.describe(frame(spark, d)).withColumn("table_name", F.lit(t)) for t, frame in FRAMES.items()]
    )


@query
def union_all_datetimes(spark, d):
    return (
        fx.table(spark, d, "orders").select(F.col("o_orderdate").alias("datetime"))
        .union(fx.table(spark, d, "lineitem").select("l_shipdate"))
        .union(fx.table(spark, d, "events").select("ts"))
        .groupBy("datetime")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query
def union_parts(spark, d):
    part = fx.table(spark, d, "part")
    first = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    second = fx.table(spark, d, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("gold")
    )
    return landing.union_parts(second, first)


@query
def peek_top5(spark, d):
    return profile.first_rows(bgg_games(spark, d), "bgg_game_id").select(
        "bgg_game_id", "game_name", "year_published", "average_rating"
    )


@query
def schema_rows(spark, d):
    return profile.schema_rows(bgg_games(spark, d))


# --- keys ------------------------------------------------------------------------------


@query
def dense_user_id(spark, d):
    return users(spark, d).select("user_id", "user_name", "atlas_user_id")


@query
def dense_list_item_id(spark, d):
    numbered = dense_id(
        facts.lists_parsed(fx.raw_lists(spark, d)), facts.LIST_ITEM_ORDER, "list_item_id"
    )
    return numbered.select("list_item_id", "geeklist_id", "post_datetime", "bgg_user_name")


# --- scalar functions ------------------------------------------------------------------


@query
def parse_ts_dmy(spark, d):
    return fx.raw_bgg_games(spark, d).select(
        "bgg_id", "average_rating", parse_dmy(F.col("datetime_extracted")).alias("extracted")
    )


@query
def parse_ts_iso(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return fx.table(spark, d, "events").select("event_id", parse_iso(text).alias("parsed"))


@query
def parse_ts_rfc822(spark, d):
    return fx.raw_lists(spark, d).select(
        "geeklist_id", "user", parse_rfc822(F.col("postdate")).alias("posted")
    )


@query
def calendar_parts(spark, d):
    return fx.table(spark, d, "events").select("event_id", *calendar(F.col("ts")))


@query
def join_list_column(spark, d):
    return fx.raw_atlas_games(spark, d).select("id", join_list(F.col("artists")).alias("artists"))


@query
def primary_name_(spark, d):
    part = fx.table(spark, d, "part")

    def name(text, primary):
        return F.struct(text.alias("_VALUE"), primary.cast("string").alias("_primary"))

    plain = name(F.col("p_brand"), F.lit(None))
    marked = name(F.col("p_name"), F.lit("true"))
    other = name(F.col("p_type"), F.when(F.col("p_size") > 25, F.lit("true")))
    names = F.when(F.col("p_size") > 40, F.array(plain, marked)).otherwise(F.array(plain, other))
    return part.select("p_partkey", primary_name(names).alias("name"))


# --- tables ----------------------------------------------------------------------------


@query
def dim_bgg_details(spark, d):
    return bgg_games(spark, d)


@query
def dim_atlas_users(spark, d):
    return users(spark, d)


@query
def dim_atlas_details(spark, d):
    return atlas_games(spark, d)


@query
def fact_reviews(spark, d):
    return reviews(spark, d)


@query
def fact_prices(spark, d):
    return prices(spark, d)


@query
def fact_lists(spark, d):
    return lists(spark, d)


@query
def dim_time(spark, d):
    return time(spark, d)


def land_dumps(spark: SparkSession, d: str) -> str:
    """The raw dumps as the harvest leaves them; their folder."""
    root = workspace(spark, "raw")
    csv = {"bgg/games.csv": fx.raw_bgg_games(spark, d), "bgg/lists.csv": fx.raw_lists(spark, d)}
    arrays = {
        "atlas/json_user.json": fx.raw_accounts(spark, d),
        "atlas/users": profiles(spark, d),
        "atlas/games": fx.raw_atlas_games(spark, d),
        "atlas/reviews": fx.raw_reviews(spark, d),
    }
    with freeing_shuffles(spark), ThreadPoolExecutor(len(csv) + len(arrays) + 1) as pool:
        jobs = [pool.submit(write_csv, df, f"{root}/{path}", packed=True) for path, df in csv.items()]
        jobs += [pool.submit(write_json_arrays, df, f"{root}/{path}", packed=True) for path, df in arrays.items()]
        # A folder for each category, as many as the column has.
        by_category = {"folder": "price_category", "packed": True}
        jobs.append(pool.submit(write_json_arrays, fx.raw_prices(spark, d), f"{root}/atlas/prices", **by_category))
        for job in jobs:
            job.result()
    return root


def published(spark: SparkSession, d: str) -> str:
    """Run the whole pipeline over the dumps; the folder of the published tables."""
    out = workspace(spark, "mart")
    pipeline.run(spark, land_dumps(spark, d), out)
    return out


@query
def mart_summary(spark, d):
    out = published(spark, d)
    counts = [
        read_table(spark, out, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for t in S.TABLES
    ]
    return landing.union_parts(*counts)


# --- quality ---------------------------------------------------------------------------


@query
def dq_report(spark, d):
    return quality.check(prices(spark, d), quality.TABLE_RULES["prices"])


@query
def dq_gate_summary(spark, d):
    reports = [quality.check(frame(spark, d), quality.TABLE_RULES[t]) for t, frame in FRAMES.items()]
    return quality.summary(landing.union_parts(*reports))


@query
def dq_audit_tables(spark, d):
    return pipeline.audit(spark, published(spark, d))


@query
def dq_pk_unique(spark, d):
    """The keys of all seven tables, and those of a raw dump, in which prices are repeated."""
    raw_ids = fx.raw_prices(spark, d).select(F.col("id").alias("atlas_price_id"))
    return landing.union_parts(
        quality.pk_unique(raw_ids, "raw_prices", "atlas_price_id"),
        *[quality.pk_unique(frame(spark, d), t, quality.TABLE_KEYS[t]) for t, frame in FRAMES.items()],
    )


@query
def dq_range_rules(spark, d):
    """Dirty values that are kept: of both game tables, ratings and prices."""
    games = {
        "max_players": F.col("max_players") > 0,
        "min_age": F.col("min_age").between(0, 21),
        "year_published": F.col("year_published") >= 1990,
        "players": F.col("min_players") <= F.col("max_players"),
    }
    ranges = {
        "atlas_games": games,
        "bgg_games": games,
        "reviews": {"rating": F.col("rating").between(0, 5) & (F.col("rating") * 4 % 1 == 0)},
        "prices": {"price": F.col("price") > 0, "msrp": F.col("price") <= F.col("msrp")},
    }
    return landing.union_parts(
        *[quality.check(FRAMES[t](spark, d), quality.Rules(t, len(S.TABLES[t]), ranges=r)) for t, r in ranges.items()]
    )


@query
def dq_join_coverage(spark, d):
    return landing.union_parts(
        quality.coverage(
            reviews(spark, d), "reviews", ["game_name", "atlas_game_id", "bgg_game_id", "user_id"]
        ),
        quality.coverage(prices(spark, d), "prices", ["atlas_game_id", "bgg_game_id"]),
        quality.coverage(lists(spark, d), "lists", ["atlas_game_id", "bgg_game_id"]),
    )


# --- questions -------------------------------------------------------------------------


@query
def popularity_trend(spark, d):
    return insights.popularity_trend(
        facts.reviews_named(fx.raw_reviews(spark, d), atlas_games(spark, d))
    )


@query
def top_recent_games(spark, d):
    # The keys do not change the latest date, so it is taken before they are looked up.
    newest = facts.reviews_parsed(fx.raw_reviews(spark, d)).agg(F.max("review_datetime"))
    return insights.top_recent_games(
        reviews_by_game(spark, d), atlas_games(spark, d), bgg_games(spark, d), as_of=newest.scalar()
    )


@query
def high_rater_profile(spark, d):
    parsed = facts.reviews_parsed(fx.raw_reviews(spark, d))
    return insights.high_rater_profile(parsed, users(spark, d), user="atlas_user_id")


@query
def price_changes(spark, d):
    return insights.price_changes(prices(spark, d))


@query
def best_price_ever(spark, d):
    return insights.best_price_ever(prices(spark, d))


@query
def trending_lists(spark, d):
    return insights.trending_lists(facts.lists_parsed(fx.raw_lists(spark, d)))


@query
def compare_sources(spark, d):
    return insights.compare_sources(atlas_games(spark, d), bgg_games(spark, d))


@query
def game_scorecard(spark, d):
    return insights.game_scorecard(
        reviews_by_game(spark, d), facts.lists_parsed(fx.raw_lists(spark, d)), prices(spark, d)
    )


@query
def match_clean_names(spark, d):
    return insights.match_clean_names(
        facts.prices_parsed(fx.raw_prices(spark, d)), bgg_games(spark, d)
    )


@query
def match_contained_names(spark, d):
    return insights.match_contained_names(
        facts.prices_parsed(fx.raw_prices(spark, d)), bgg_games(spark, d)
    )


# --- harvest ---------------------------------------------------------------------------


@query
def xml_games(spark, d):
    """The parts as game elements, with one, two or no values in the lists."""
    path = workspace(spark, "xml")

    def tag(text):
        return F.when(text.isNotNull(), F.array(text)).otherwise(F.array().cast("array<string>"))

    text = {c: F.col(c).cast("string") for c in ("p_size", "p_partkey", "p_retailprice")}
    two = F.array(F.col("p_type"), F.col("p_brand"))
    names = F.array(
        F.struct(F.col("p_brand").alias("_VALUE"), F.lit(None).cast("string").alias("_primary")),
        F.struct(F.col("p_name").alias("_VALUE"), F.lit("true").alias("_primary")),
    )
    games = (
        fx.table(spark, d, "part")
        .select(
            text["p_partkey"].alias("_objectid"),
            names.alias("name"),
            text["p_size"].alias("maxplayers"),
            text["p_size"].alias("maxplaytime"),
            text["p_size"].alias("age"),
            text["p_size"].alias("minplayers"),
            text["p_size"].alias("minplaytime"),
            F.when(F.col("p_size") > 10, F.lit("1999")).otherwise(F.lit("soon")).alias("yearpublished"),
            tag(F.col("p_brand")).alias("boardgameartist"),
            two.alias("boardgamecategory"),
            tag(F.lit(None).cast("string")).alias("boardgamecompilation"),
            tag(F.concat("p_name", F.lit(" & <sons>"))).alias("boardgamedesigner"),
            two.alias("boardgamefamily"),
            tag(F.col("p_type")).alias("boardgamemechanic"),
            tag(F.col("p_name")).alias("boardgamepublisher"),
            F.struct(
                F.struct(text["p_size"].alias("usersrated"), text["p_retailprice"].alias("average"))
                .alias("ratings")
            ).alias("statistics"),
        )
    )
    write_xml(games, path, "boardgame", "boardgames")
    return landing.xml_games(read_xml(spark, path, "boardgame", S.XML_GAME))


# Items per list document and prices per payload, so that no key's rows have to fit one
# text. Rows are cut by their written position, which is the same on every attempt.
ROWS_PER_TEXT = 500
PAYLOADS_PER_FILE = 20


def in_texts(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with ``_block`` and ``_text``, which hold ROWS_PER_TEXT rows at most."""
    blocks = ordered_blocks(df, keys)
    return blocks.withColumn("_text", F.expr(f"_pos div {ROWS_PER_TEXT}"))


def list_documents(spark: SparkSession, d: str) -> DataFrame:
    """(_id, item): lists with their items."""
    item = F.struct(
        F.col("objtype").alias("_subtype"),
        F.col("game_id").alias("_objectid"),
        F.col("name").alias("_objectname"),
        F.col("user").alias("_username"),
        F.col("postdate").alias("_postdate"),
        F.col("bodytext").alias("body"),
    )
    return (
        in_texts(fx.raw_lists(spark, d), "geeklist_id", "user")
        .groupBy("geeklist_id", "_block", "_text")
        .agg(F.collect_list(item).alias("item"))
        .select(F.col("geeklist_id").alias("_id"), "item")
    )


@query
def xml_list_items(spark, d):
    lists = list_documents(spark, d)
    documents = lists.select(F.to_xml(F.struct("_id", "item"), {"rowTag": "geeklist"}).alias("value"))
    return landing.xml_list_items(documents)


def harvest_payloads(spark: SparkSession, d: str) -> str:
    """XML and nested JSON as the two sources hand them out; their folder."""
    root = workspace(spark, "harvest")
    games = fx.raw_bgg_games(spark, d).filter(F.col("datetime_extracted").startswith("15/"))
    value = F.struct(F.col("name").alias("_VALUE"), F.lit("true").alias("_primary"))
    tags = {"artist": "artist", "category": "category", "designer": "designer", "family": "family", "mechanic": "mechanic", "publisher": "publisher"}
    xml = games.select(
        F.col("bgg_id").alias("_objectid"),
        F.array(value).alias("name"),
        *["maxplayers", "maxplaytime", "age", "minplayers", "minplaytime"],
        F.col("year_published").alias("yearpublished"),
        *[F.array(c).alias(f"boardgame{tag}") for c, tag in tags.items()],
        F.struct(F.struct(F.col("users_rated").alias("usersrated"), F.col("average_rating").alias("average")).alias("ratings")).alias("statistics"),
    )
    payloads = price_payloads(spark, d).write.options(**PACKED).option("maxRecordsPerFile", PAYLOADS_PER_FILE)
    arrays = {"users": fx.raw_accounts, "games": fx.raw_atlas_games, "reviews": fx.raw_nested_reviews}
    jobs = [
        lambda: payloads.text(f"{root}/atlas/prices"),
        lambda: write_xml(xml, f"{root}/bgg/games", "boardgame", "boardgames"),
        lambda: write_xml(list_documents(spark, d), f"{root}/bgg/lists", "geeklist", "lists"),
        *[lambda t=t: write_json_arrays(arrays[t](spark, d), f"{root}/atlas/{t}", packed=True) for t in arrays],
    ]
    # The prices, which come first, beside all others one after the other.
    with freeing_shuffles(spark), ThreadPoolExecutor(2) as pool:
        for job in [pool.submit(job) for job in jobs]:
            job.result()
    return root


@query
def mart_from_harvest(spark, d):
    """From XML and nested JSON through the dumps to the published tables: rows of each, its
    distinct keys, and a sum over the names or dates that came all the way."""
    raw, out = workspace(spark, "raw"), workspace(spark, "mart")
    payloads = harvest_payloads(spark, d)
    harvest.run(spark, payloads, raw, "15/01/2023 10:30:00")
    empty(spark, payloads)  # the dumps are written, and nothing reads these again
    pipeline.run(spark, raw, out)
    carried = {t: F.length("game_name") for t in S.TABLES if "game_name" in S.TABLES[t]}
    carried |= {"users": F.length("user_name"), "time": F.unix_timestamp("datetime")}
    counts = [
        read_table(spark, out, t).agg(
            F.lit(t).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct(quality.TABLE_KEYS[t]).alias("n_keys"),
            F.sum(carried[t].cast("long")).alias("carried"),
        )
        for t in S.TABLES
    ]
    return landing.union_parts(*counts)


@query
def land_csv(spark, d):
    """Two harvest batches, one without the years, to one CSV dump and back."""
    path = workspace(spark, "csv")
    games = fx.raw_bgg_games(spark, d)
    early = games.filter(F.col("datetime_extracted").startswith("15/")).drop("year_published")
    late = games.filter(~F.col("datetime_extracted").startswith("15/"))
    write_csv(landing.union_parts(late, early), path)
    columns = [f"{c.name} {c.dataType.simpleString()}" for c in landing.union_parts(late, early).schema]
    return read_csv_split(spark, path, ", ".join(columns))


@query
def split_reviews(spark, d):
    return landing.split_reviews(fx.raw_nested_reviews(spark, d))


@query
def latest_user_profile(spark, d):
    return profiles(spark, d)


@query
def distinct_game_ids(spark, d):
    return landing.distinct_game_ids(fx.raw_reviews(spark, d))


def price_payloads(spark: SparkSession, d: str) -> DataFrame:
    """(payload): maps of category to prices, as text."""
    raw = fx.raw_prices(spark, d)
    price = F.struct(*[c for c in raw.columns if c != "price_category"])

    def payload(categories: list[str], prices: list[str]) -> str:
        by_category: dict[str, list[str]] = {}
        for category, text in zip(categories, prices, strict=True):
            by_category.setdefault(category, []).append(text)
        return "{" + ",".join(f"{json.dumps(c)}:[{','.join(t)}]" for c, t in by_category.items()) + "}"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last rows of a batch wait for those of the next one.
        categories, prices = [], []
        for batch in batches:
            categories += batch.column(0).to_pylist()
            prices += batch.column(1).to_pylist()
            full = len(prices) // ROWS_PER_TEXT * ROWS_PER_TEXT
            cuts = [slice(lo, lo + ROWS_PER_TEXT) for lo in range(0, full, ROWS_PER_TEXT)]
            yield pa.RecordBatch.from_pydict({"payload": pa.array([payload(categories[c], prices[c]) for c in cuts], pa.string())})
            categories, prices = categories[full:], prices[full:]
        if prices:
            yield pa.RecordBatch.from_pydict({"payload": [payload(categories, prices)]})

    # Texts are cut in the task that sorts the rows, so nothing is shuffled again or written first.
    rows = sorted_ranges(raw, ["name", "id"]).select("price_category", F.to_json(price).alias("price"))
    return rows.mapInArrow(join, "payload STRING")


@query
def explode_prices(spark, d):
    return landing.explode_prices(price_payloads(spark, d))


@query
def truncation_audit(spark, d):
    by_user = fx.raw_nested_reviews(spark, d).select(
        F.col("user.username").alias("username"), "rating"
    )
    accounts = landing.users_with_name(fx.raw_accounts(spark, d))
    return landing.truncation_audit(accounts, by_user, limit=2)


@query
def compact_json(spark, d):
    source, target = workspace(spark, "json"), workspace(spark, "compact")
    write_json_arrays(fx.raw_reviews(spark, d), source)
    # The letter is that of the files, which Spark has named "part-...".
    landing.compact_json(spark, source, target, S.ATLAS_REVIEWS)
    return spark.read.schema(S.ATLAS_REVIEWS + ", letter STRING").json(target)


@query
def users_with_name(spark, d):
    return landing.users_with_name(fx.raw_accounts(spark, d))


@query
def batch_ids_(spark, d):
    ids = landing.distinct_game_ids(fx.raw_reviews(spark, d))
    return batch_ids(ids, "game_id", 10).select("batch", F.concat_ws(",", "ids").alias("ids"))


@query
def count_json_records(spark, d):
    root = workspace(spark, "tree")
    write_json_arrays(fx.raw_accounts(spark, d).withColumn("id", F.col("url")), f"{root}/users")
    write_json_arrays(fx.raw_atlas_games(spark, d), f"{root}/games")
    write_json_arrays(fx.raw_reviews(spark, d), f"{root}/reviews/all")
    return landing.count_json_records(spark, root)


# --- stream ----------------------------------------------------------------------------


@query
def incremental_reviews(spark, d):
    """Reviews land in two drops that overlap by a year; the second call sees the rest."""
    source, target = workspace(spark, "drops"), workspace(spark, "reviews")
    checkpoint = workspace(spark, "stream")
    raw = fx.raw_reviews(spark, d)
    dimensions = (atlas_games(spark, d), bgg_games(spark, d), users(spark, d))
    for n, drop in enumerate((F.col("createdAt") < "1999", F.col("createdAt") >= "1998")):
        write_json_arrays(raw.filter(drop), f"{source}/{n}")
        stream_reviews(spark, f"{source}/*", target, checkpoint, *dimensions)
    return spark.read.parquet(target).select(*S.TABLES["reviews"])
