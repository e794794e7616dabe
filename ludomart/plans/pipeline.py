"""Raw dumps to the seven published tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ludomart import schemas as S
from ludomart.operators import quality
from ludomart.plans import dims, facts
from ludomart.session import empty, freeing_shuffles, tune, written
from ludomart.sources import read_csv_split, read_json_split, read_table, snapshots, write_table


def build(spark: SparkSession, table: str, frame: DataFrame, root: str) -> int:
    """Write, check, publish one table; the number of its rows.

    A frame of other columns than the table's stops here. The plan runs once, for the
    write, which counts what the rules need. A snapshot that fails, or whose key is not
    unique (the key column is read back for that), is emptied, and readers keep the old one.
    """
    quality.same_columns(table, frame.columns, list(S.TABLES[table]))
    rules = quality.TABLE_RULES[table]
    snapshot = snapshots.begin(spark, root, table)
    frame = frame.select(*S.TABLES[table])
    try:
        seen = write_table(frame, snapshot.path, S.PARTITIONS[table], quality.metrics(rules))
        rows = quality.gate_metrics(rules, len(frame.columns), seen)
        quality.unique_gate(spark.read.schema(frame.schema).parquet(snapshot.path), table)
    except quality.QualityError:
        snapshots.discard(spark, snapshot)
        raise
    snapshots.commit(spark, snapshot, rows)
    return rows


# What a table reads besides its dumps.
DEPENDS = {
    "bgg_games": [],
    "users": [],
    "atlas_games": [],
    "reviews": ["atlas_games", "bgg_games", "users"],
    "prices": ["atlas_games", "bgg_games"],
    "lists": ["atlas_games"],
    "time": ["reviews", "prices", "lists"],
}


def stages(tables: Iterable[str]) -> list[list[str]]:
    """``tables`` in steps: those of a step depend on those of earlier ones only."""
    left, out = set(tables), []
    if unknown := left - set(DEPENDS):
        raise ValueError(f"no such tables: {sorted(unknown)}")
    while left:
        ready = [t for t in DEPENDS if t in left and not left & set(DEPENDS[t])]
        out.append(ready)
        left -= set(ready)
    return out


def downstream(tables: Iterable[str]) -> list[str]:
    """``tables`` and all that depend on them, in order of building."""
    out = set(tables)
    for step in stages(DEPENDS):
        out |= {t for t in step if out & set(DEPENDS[t])}
    return [t for t in DEPENDS if t in out]


def run(
    spark: SparkSession, input_dir: str, output_dir: str, tables: Iterable[str] | None = None
) -> dict[str, int]:
    """All seven tables, or only ``tables``, in order of dependency; rows per table.

    Tables of one stage do not depend on each other and are built at the same
    time. A stage reads what the one before published; a table that is not built has to be
    published already. A dump may be one file or a folder of files.

    The prices, the largest table, go to a working table between the dedupe and the lookup, so
    that the shuffles of one are off the disk before the other's. Their ids by name are written
    first, so that Spark knows their size before it plans the lookup. List items go to one
    before they are numbered, which reads them twice.
    """
    tune(spark)
    src, out = input_dir.rstrip("/"), output_dir.rstrip("/")
    working: dict[str, list[str]] = {}

    def step(table: str, df: DataFrame) -> DataFrame:
        back, path = written(df, f"{table}-step")
        working.setdefault(table, []).append(path)
        return back

    def published(table: str, *columns: str) -> DataFrame:
        return read_table(spark, out, table, *columns)

    def bgg_games() -> DataFrame:
        return dims.bgg_details(read_csv_split(spark, f"{src}/bgg/games.csv", S.BGG_GAMES))

    def users() -> DataFrame:
        return dims.atlas_users(
            read_json_split(spark, f"{src}/atlas/json_user.json", S.ATLAS_USERS),
            read_json_split(spark, f"{src}/atlas/users", S.ATLAS_PROFILES),
        )

    def atlas_games() -> DataFrame:
        return dims.atlas_details(
            read_json_split(spark, f"{src}/atlas/games", S.ATLAS_GAMES)
        )

    def reviews() -> DataFrame:
        return facts.reviews(
            read_json_split(spark, f"{src}/atlas/reviews", S.ATLAS_REVIEWS),
            published("atlas_games", "atlas_game_id", "game_name"),
            published("bgg_games", "bgg_game_id", "game_name"),
            published("users", "user_id", "atlas_user_id"),
        )

    def prices() -> DataFrame:
        ids = facts.ids_by_name(
            published("atlas_games", "atlas_game_id", "game_name"),
            published("bgg_games", "bgg_game_id", "game_name"),
        )
        ids = step("prices", ids)
        raw = read_json_split(spark, f"{src}/atlas/prices/*", S.ATLAS_PRICES)
        return facts.prices_keyed(step("prices", facts.prices_parsed(raw)), ids)

    def lists() -> DataFrame:
        raw = read_csv_split(spark, f"{src}/bgg/lists.csv", S.BGG_LISTS, {"geeklist": "geeklist_id"})
        return facts.lists_keyed(
            step("lists", facts.lists_parsed(raw)),
            published("atlas_games", "atlas_game_id", "game_name"),
        )

    def time() -> DataFrame:
        return dims.time(
            published("reviews", "review_datetime"),
            published("prices", "price_datetime"),
            published("lists", "post_datetime"),
        )

    frames: dict[str, Callable[[], DataFrame]] = {
        "bgg_games": bgg_games,
        "users": users,
        "atlas_games": atlas_games,
        "reviews": reviews,
        "prices": prices,
        "lists": lists,
        "time": time,
    }
    def built(table: str) -> int:
        try:
            return build(spark, table, frames[table](), out)
        finally:
            for path in working.get(table, []):
                empty(spark, path)

    rows: dict[str, int] = {}
    with freeing_shuffles(spark):
        for stage in stages(DEPENDS if tables is None else tables):
            with ThreadPoolExecutor(len(stage)) as pool:
                jobs = {t: pool.submit(built, t) for t in stage}
                rows.update({t: job.result() for t, job in jobs.items()})
    return rows


def audit(spark: SparkSession, root: str) -> DataFrame:
    """The rules of all seven tables over what is published."""
    reports = [
        quality.check(read_table(spark, root, t), rules)
        for t, rules in quality.TABLE_RULES.items()
    ]
    every = reports[0]
    for report in reports[1:]:
        every = every.unionByName(report)
    return every
