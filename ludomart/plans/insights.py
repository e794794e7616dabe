"""The questions the mart is for. Inputs are table frames, published or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ludomart.functions import clean_name
from ludomart.operators import dedupe_name, lookup, previous_in_order


def _newest(df: DataFrame, column: str) -> Column:
    """Latest time of the frame, as a scalar subquery."""
    return df.agg(F.max(column)).scalar()


def popularity_trend(reviews: DataFrame) -> DataFrame:
    """Reviews and mean rating per game name and month."""
    return (
        reviews.filter(F.col("game_name").isNotNull())
        .groupBy("game_name", "year", "month")
        .agg(F.count(F.lit(1)).alias("n_reviews"), F.avg("rating").alias("avg_rating"))
    )


def top_recent_games(
    reviews: DataFrame,
    atlas: DataFrame,
    bgg: DataFrame,
    days: int = 365,
    k: int = 10,
    as_of: Column | None = None,
) -> DataFrame:
    """The ``k`` most reviewed games of the last ``days``, with details of both sources.

    The last ``days`` end with the latest review, or at ``as_of``. The condition on the
    year prunes partitions of a published table. Counts are cut to ``k`` rows before
    the dimensions are joined, and used once: filtering the dimensions by them too
    would count the reviews again.
    """
    newest = _newest(reviews, "review_datetime") if as_of is None else as_of
    since = newest - F.expr(f"INTERVAL {days} DAYS")
    top = (
        reviews.filter(
            (F.col("review_datetime") > since)
            & (F.col("year") >= F.year(since))
            & F.col("game_name").isNotNull()
        )
        .groupBy("atlas_game_id", "game_name", "bgg_game_id")
        .agg(F.count(F.lit(1)).alias("n_reviews"), F.avg("rating").alias("avg_rating"))
        .orderBy(F.desc("n_reviews"), F.desc("avg_rating"), "atlas_game_id")
        .limit(k)
    )
    details = atlas.select(
        "atlas_game_id",
        F.col("year_published").alias("atlas_year"),
        "primary_publisher",
        F.col("min_players").alias("atlas_min_players"),
        F.col("max_players").alias("atlas_max_players"),
    )
    other = bgg.select(
        "bgg_game_id",
        F.col("year_published").alias("bgg_year"),
        "designer",
        F.col("average_rating").alias("bgg_rating"),
    )
    return top.join(details, "atlas_game_id", "left").join(other, "bgg_game_id", "left").select(
        "atlas_game_id",
        "game_name",
        "bgg_game_id",
        "n_reviews",
        "avg_rating",
        "atlas_year",
        "primary_publisher",
        "atlas_min_players",
        "atlas_max_players",
        "bgg_year",
        "designer",
        "bgg_rating",
    )


def high_rater_profile(
    reviews: DataFrame, users: DataFrame, min_rating: float = 4.0, user: str = "user_id"
) -> DataFrame:
    """Reviews, users and share of high ratings per level and premium flag.

    ``user`` is the column of both that names a user; with the source's own id the fact
    needs no lookup. Reviews are counted per user before the join, so the join and the
    count of users see one row per user. Unmatched reviews form the NULL group.
    """
    per_user = reviews.groupBy(user).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("rating") >= min_rating).alias("n_high")
    )
    traits = users.select(
        user, F.col("user_id").alias("_known"), "atlas_level", "atlas_premium"
    ).filter(F.col(user).isNotNull())
    return (
        per_user.join(traits, user, "left")
        .groupBy("atlas_level", "atlas_premium")
        .agg(
            F.sum("n").alias("n_reviews"),
            F.count("_known").alias("n_users"),
            (F.sum("n_high") / F.sum("n")).alias("high_share"),
        )
    )


def price_changes(prices: DataFrame) -> DataFrame:
    """Each price with the one before it of the same game, store and currency."""
    listed = prices.filter(F.col("bgg_game_id").isNotNull()).select(
        "atlas_price_id", "bgg_game_id", "store_name", "currency", "price_datetime", "price"
    )
    return previous_in_order(
        listed,
        ["bgg_game_id", "store_name", "currency"],
        ["price_datetime", "atlas_price_id"],
        "price",
        "prev_price",
    ).withColumn("price_diff", F.col("price") - F.col("prev_price"))


def best_price_ever(prices: DataFrame) -> DataFrame:
    """Lowest price per game and currency, the earliest of equals.

    Prices in different currencies do not compare. Each map task sends one row per
    game and currency (group limit below the exchange).
    """
    window = Window.partitionBy("bgg_game_id", "currency").orderBy(
        F.col("price").asc_nulls_last(), "price_datetime", "atlas_price_id"
    )
    return (
        prices.filter(F.col("bgg_game_id").isNotNull())
        .withColumn("_rn", F.row_number().over(window))
        .filter("_rn = 1")
        .select(
            "bgg_game_id", "currency", "price", "store_name", "price_datetime", "atlas_price_id"
        )
    )


def trending_lists(lists: DataFrame, days: int = 7) -> DataFrame:
    """Mentions per game in the last ``days``, in the ``days`` before, and the change, of
    games mentioned in either. The condition on the year prunes a published table."""
    newest = _newest(lists, "post_datetime")
    now = newest - F.expr(f"INTERVAL {days} DAYS")
    before = newest - F.expr(f"INTERVAL {2 * days} DAYS")
    posted = F.col("post_datetime")
    return (
        lists.filter((posted > before) & (F.col("year") >= F.year(before)))
        .groupBy("bgg_game_id")
        .agg(
            F.count_if(posted > now).alias("n_now"),
            F.count_if(posted <= now).alias("n_before"),
        )
        .withColumn("change", F.col("n_now") - F.col("n_before"))
    )


def compare_sources(atlas: DataFrame, bgg: DataFrame) -> DataFrame:
    """Details of both sources side by side, for games of the same name (of several
    with one name, the lowest id). The rating scales differ, so the ratings are shown
    and not subtracted."""
    details = F.struct(
        "bgg_game_id",
        F.col("year_published").alias("bgg_year"),
        F.col("average_rating").alias("bgg_rating"),
        F.col("num_ratings").alias("bgg_num_ratings"),
        F.col("min_players").alias("bgg_min_players"),
        F.col("max_players").alias("bgg_max_players"),
    )
    theirs = (
        bgg.filter(F.col("game_name").isNotNull())
        .groupBy("game_name")
        .agg(F.min(details).alias("_lowest"))
        .select("game_name", "_lowest.*")
    )
    ours = atlas.select(
        "atlas_game_id",
        "game_name",
        F.col("year_published").alias("atlas_year"),
        F.col("average_rating").alias("atlas_rating"),
        F.col("num_ratings").alias("atlas_num_ratings"),
        F.col("min_players").alias("atlas_min_players"),
        F.col("max_players").alias("atlas_max_players"),
    )
    return ours.join(theirs, "game_name")


def game_scorecard(reviews: DataFrame, lists: DataFrame, prices: DataFrame) -> DataFrame:
    """Reviews, list mentions and best price per game that any fact mentions, a row for
    each currency a game is priced in (prices in different currencies do not compare); a
    game without a price has one row without a currency.

    Reviews and mentions are one union of narrow rows and one aggregate; best prices are
    another. Both send one row per group from each map task, and are joined by game.
    """
    game = F.col("bgg_game_id")
    every = (
        reviews.select(game, F.lit(1).alias("_review"), "rating")
        .unionByName(lists.select(game, F.lit(1).alias("_mention")), allowMissingColumns=True)
    )
    counts = (
        every.filter(game.isNotNull())
        .groupBy("bgg_game_id")
        .agg(
            F.nullif(F.count("_review"), F.lit(0)).alias("n_reviews"),
            F.avg("rating").alias("avg_rating"),
            F.nullif(F.count("_mention"), F.lit(0)).alias("n_mentions"),
        )
    )
    best = (
        prices.filter(game.isNotNull())
        .groupBy("bgg_game_id", "currency")
        .agg(F.min("price").alias("best_price"))
    )
    return counts.join(best, "bgg_game_id", "full_outer").select(
        "bgg_game_id", "n_reviews", "avg_rating", "n_mentions", "currency", "best_price"
    )


def match_clean_names(prices: DataFrame, bgg: DataFrame) -> DataFrame:
    """Prices matched to games on the cleaned name. An empty cleaned name names nothing."""
    games = dedupe_name(
        bgg.withColumn("clean_name", clean_name(F.col("game_name"))), "clean_name", "bgg_game_id"
    ).filter("clean_name <> ''")
    listed = prices.select("atlas_price_id", "game_name").withColumn(
        "clean_name", clean_name(F.col("game_name"))
    )
    return lookup(listed, games, "clean_name", ["bgg_game_id"], spread_by=["atlas_price_id"])


def contained_names(names: DataFrame, games: DataFrame) -> DataFrame:
    """(game_name, bgg_game_id): the longest known name inside each distinct listing name.

    Every run of words up to the longest known name is a candidate and meets the
    known names in an equi join: rows grow with the words of the distinct listing
    names, never with pairs of names.
    """
    known = dedupe_name(
        games.withColumn("clean_name", clean_name(F.col("game_name"))), "clean_name", "bgg_game_id"
    ).filter("clean_name <> ''")
    longest = known.agg(F.max(F.size(F.split("clean_name", " ")))).scalar()
    words = (
        names.select("game_name")
        .distinct()
        .withColumn("words", F.split(clean_name(F.col("game_name")), " "))
        .withColumn("longest", longest)
    )
    runs = (
        words.select("game_name", "words", "longest", F.posexplode("words").alias("start", "_word"))
        .withColumn("left", F.least(F.col("longest"), F.size("words") - F.col("start")))
        .filter("left > 0")
        .select("game_name", "words", "start", F.explode(F.sequence(F.lit(1), "left")).alias("n"))
        .select(
            "game_name",
            "n",
            F.concat_ws(" ", F.slice("words", F.col("start") + 1, F.col("n"))).alias("clean_name"),
        )
    )
    best = Window.partitionBy("game_name").orderBy(F.desc("n"), "bgg_game_id")
    return (
        runs.join(known, "clean_name")
        .withColumn("_rn", F.row_number().over(best))
        .filter("_rn = 1")
        .select("game_name", "bgg_game_id")
    )


def match_contained_names(prices: DataFrame, bgg: DataFrame) -> DataFrame:
    """Prices matched to the longest known name that their listing text contains."""
    listed = prices.select("atlas_price_id", "game_name")
    return lookup(
        listed,
        contained_names(listed, bgg),
        "game_name",
        ["bgg_game_id"],
        spread_by=["atlas_price_id"],
    )
