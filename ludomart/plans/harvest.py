"""Harvested payloads to the dumps that the pipeline reads, as one job.

    HARVEST/bgg/games/    XML documents with game elements, in batches
    HARVEST/bgg/lists/    XML documents, one list each
    HARVEST/atlas/users/  JSON: accounts          -> RAW/atlas/json_user.json (those with a name)
    HARVEST/atlas/games/  JSON: games             -> RAW/atlas/games
    HARVEST/atlas/reviews/ JSON: reviews with user and game objects
                                                  -> RAW/atlas/reviews and RAW/atlas/users
    HARVEST/atlas/prices/ JSON: maps of category to prices, one object a line or an array
                                                  -> RAW/atlas/prices, a folder a category
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludomart import schemas as S
from ludomart.plans import landing
from ludomart.session import empty, freeing_shuffles, tune, written
from ludomart.sources import read_json_objects, read_json_split, read_xml, write_csv, write_json_arrays


def bgg_games(spark: SparkSession, harvest: str, extracted: str) -> DataFrame:
    """Games of all batches, stamped with the time of their extraction."""
    games = landing.xml_games(read_xml(spark, f"{harvest}/bgg/games", "boardgame", S.XML_GAME))
    return landing.stamp_extracted(games, extracted)


def bgg_lists(spark: SparkSession, harvest: str) -> DataFrame:
    """Items of all lists."""
    lists = read_xml(spark, f"{harvest}/bgg/lists", "geeklist", S.XML_LIST)
    return landing.list_items(lists)


def accounts(spark: SparkSession, harvest: str) -> DataFrame:
    return landing.users_with_name(read_json_split(spark, f"{harvest}/atlas/users", S.ATLAS_USERS))


def atlas_games(spark: SparkSession, harvest: str) -> DataFrame:
    return read_json_split(spark, f"{harvest}/atlas/games", S.ATLAS_GAMES)


def raw_reviews(spark: SparkSession, harvest: str) -> DataFrame:
    return read_json_split(spark, f"{harvest}/atlas/reviews", S.ATLAS_RAW_REVIEWS)


def reviews(spark: SparkSession, harvest: str, raw: DataFrame | None = None) -> DataFrame:
    return landing.split_reviews(raw_reviews(spark, harvest) if raw is None else raw)


def profiles(spark: SparkSession, harvest: str, raw: DataFrame | None = None) -> DataFrame:
    return landing.latest_user_profile(raw_reviews(spark, harvest) if raw is None else raw)


def prices(spark: SparkSession, harvest: str, landed: DataFrame | None = None) -> DataFrame:
    """Prices of all payloads with their category, without those of ids in ``landed``."""
    rows = landing.explode_prices(read_json_objects(spark, f"{harvest}/atlas/prices"), "value")
    return rows if landed is None else rows.join(landed.select("id").where("id IS NOT NULL"), "id", "left_anti")


def run(
    spark: SparkSession, harvest: str, raw: str, extracted: str, only: Iterable[str] | None = None
) -> list[str]:
    """Write all dumps, or those named in ``only``; the names written. ``extracted`` is the
    time of the harvest, as ``dd/MM/yyyy HH:mm:ss``. Dumps are gzipped files of bounded size and overwritten, so a job that is
    run again leaves the same dumps. The reviews, of which two dumps are made, are parsed once, to a working table."""
    tune(spark)
    harvest, raw = harvest.rstrip("/"), raw.rstrip("/")
    parsed: list[tuple[DataFrame, str]] = []
    once = Lock()

    def nested() -> DataFrame | None:
        """The parsed reviews, which the first of their two jobs writes."""
        if not {"atlas/users", "atlas/reviews"} <= set(names):
            return None
        with once:
            if not parsed:
                parsed.append(written(raw_reviews(spark, harvest), "reviews-step"))
            return parsed[0][0]

    jobs: dict[str, Callable[[], None]] = {
        "bgg/games.csv": lambda: write_csv(bgg_games(spark, harvest, extracted), f"{raw}/bgg/games.csv", packed=True),
        "bgg/lists.csv": lambda: write_csv(bgg_lists(spark, harvest), f"{raw}/bgg/lists.csv", packed=True),
        "atlas/json_user.json": lambda: write_json_arrays(accounts(spark, harvest), f"{raw}/atlas/json_user.json", packed=True),
        "atlas/users": lambda: write_json_arrays(profiles(spark, harvest, nested()), f"{raw}/atlas/users", packed=True),
        "atlas/games": lambda: write_json_arrays(atlas_games(spark, harvest), f"{raw}/atlas/games", packed=True),
        "atlas/reviews": lambda: write_json_arrays(reviews(spark, harvest, nested()), f"{raw}/atlas/reviews", packed=True),
        "atlas/prices": lambda: write_json_arrays(prices(spark, harvest), f"{raw}/atlas/prices", folder="price_category", packed=True),
    }
    names = list(jobs) if only is None else list(only)
    if unknown := set(names) - set(jobs):
        raise ValueError(f"no such dumps: {sorted(unknown)}")
    try:
        with freeing_shuffles(spark), ThreadPoolExecutor(max(len(names), 1)) as pool:
            for job in [pool.submit(jobs[n]) for n in names]:
                job.result()
    finally:
        for _, path in parsed:
            empty(spark, path)
    return names
