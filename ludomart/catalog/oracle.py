"""The same results as plain SQL for an independent engine (DuckDB).

``VIEWS`` are named steps; ``_sql`` puts the ones a statement needs in front of it.
"""

from __future__ import annotations

import re

from ludomart.fixtures import SHAPES
from ludomart.operators.quality import TABLE_KEYS
from ludomart.schemas import TABLES

VIEWS = {
    **SHAPES,
    "bgg_games": """
        SELECT CAST(bgg_id AS INT) AS bgg_game_id, maxplayers AS max_players,
               maxplaytime AS max_playtime, age AS min_age, minplayers AS min_players,
               minplaytime AS min_playtime, name AS game_name,
               TRY_CAST(TRY_CAST(year_published AS DOUBLE) AS INT) AS year_published, artist,
               category, compilation, designer, family, mechanic, publisher,
               users_rated AS num_ratings, average_rating, extracted AS datetime_extracted
        FROM (SELECT *, row_number() OVER (PARTITION BY bgg_id
                                           ORDER BY extracted DESC NULLS LAST) AS rn
              FROM shape_bgg_games) WHERE rn = 1""",
    "atlas_games": """
        SELECT id AS atlas_game_id, name AS game_name, url, extracted AS datetime_extracted,
               year_published, min_players, max_players, min_playtime, max_playtime, min_age,
               publisher AS primary_publisher, designer AS primary_designer,
               concat_ws(',', artist1, artist2) AS artists, num_user_ratings AS num_ratings,
               average_user_rating AS average_rating, num_votes AS num_complexity,
               learning AS average_learning_complexity, strategy AS average_strategy_complexity
        FROM shape_atlas_games""",
    "atlas_names": """
        SELECT game_name, min(atlas_game_id) AS atlas_game_id FROM atlas_games GROUP BY game_name""",
    "bgg_names": """
        SELECT game_name, min(bgg_game_id) AS bgg_game_id FROM bgg_games GROUP BY game_name""",
    "profiles": """
        SELECT user_id AS id, username, is_premium, is_partner, is_moderator
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                                           ORDER BY created DESC, id DESC) AS rn
              FROM shape_reviews) WHERE rn = 1""",
    "joined_users": """
        SELECT a.username AS user_name, a.url, a.description, a.gold AS atlas_gold,
               a.experience AS atlas_exp, a.level AS atlas_level, p.id AS atlas_user_id,
               p.is_premium AS atlas_premium, p.is_partner AS atlas_partner,
               p.is_moderator AS atlas_moderator
        FROM shape_accounts a LEFT JOIN profiles p ON a.username = p.username
        WHERE a.username IS NOT NULL""",
    "users": """
        SELECT *, CAST(row_number() OVER (ORDER BY user_name, atlas_user_id NULLS FIRST) - 1 AS BIGINT)
                  AS user_id
        FROM joined_users""",
    "reviews": """
        SELECT g.game_name, r.game_id AS atlas_game_id, r.id AS review_id,
               r.created AS review_datetime, r.rating, r.description,
               CAST(year(r.created) AS INT) AS year, CAST(month(r.created) AS INT) AS month,
               n.bgg_game_id, u.user_id
        FROM shape_reviews r LEFT JOIN atlas_games g ON r.game_id = g.atlas_game_id
             LEFT JOIN bgg_names n ON g.game_name = n.game_name
             LEFT JOIN users u ON r.user_id = u.atlas_user_id""",
    "prices": """
        SELECT p.name AS game_name, p.id AS atlas_price_id, p.updated AS price_datetime, p.price,
               p.currency, p.msrp, p.url, p.store_name, p.country, p.price_category,
               CAST(year(p.updated) AS INT) AS year, CAST(month(p.updated) AS INT) AS month,
               a.atlas_game_id, n.bgg_game_id
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated DESC, price_category,
                                           name, price, currency, msrp, url, store_name, country) AS rn
              FROM shape_prices) p
             LEFT JOIN atlas_names a ON p.name = a.game_name
             LEFT JOIN bgg_names n ON p.name = n.game_name
        WHERE p.rn = 1""",
    # The text of a list date has whole seconds.
    "posted_items": """
        SELECT name AS game_name, geeklist_id, objtype, game_id AS bgg_game_id,
               username AS bgg_user_name, date_trunc('second', posted) AS post_datetime,
               bodytext AS description
        FROM shape_lists WHERE posted IS NOT NULL""",
    "lists": """
        SELECT l.game_name, l.geeklist_id, l.objtype, l.bgg_game_id, l.bgg_user_name,
               l.post_datetime, l.description,
               CAST(row_number() OVER (ORDER BY l.geeklist_id, l.post_datetime, l.bgg_game_id,
                    l.bgg_user_name, l.game_name, l.objtype, l.description) - 1 AS BIGINT)
                    AS list_item_id,
               CAST(year(l.post_datetime) AS INT) AS year, CAST(month(l.post_datetime) AS INT) AS month,
               a.atlas_game_id
        FROM posted_items l LEFT JOIN atlas_names a ON l.game_name = a.game_name""",
    "stamps": """
        SELECT created AS datetime FROM shape_reviews UNION SELECT updated FROM shape_prices
        UNION SELECT post_datetime FROM posted_items""",
    "kept_stamps": """
        SELECT review_datetime AS datetime FROM reviews UNION SELECT price_datetime FROM prices
        UNION SELECT post_datetime FROM posted_items""",
    "best_prices": """
        SELECT bgg_game_id, currency, price, store_name, price_datetime, atlas_price_id
        FROM (SELECT *, row_number() OVER (PARTITION BY bgg_game_id, currency
                                           ORDER BY price, price_datetime, atlas_price_id) AS rn
              FROM prices WHERE bgg_game_id IS NOT NULL) WHERE rn = 1""",
    "clean_games": """
        SELECT clean_name, min(bgg_game_id) AS bgg_game_id
        FROM (SELECT bgg_game_id, {clean} AS clean_name FROM bgg_games)
        WHERE clean_name <> '' GROUP BY clean_name""",
    "clean_prices": """
        SELECT atlas_price_id, game_name, {clean} AS clean_name FROM prices""",
    "price_checks": """
        SELECT 'prices' AS table_name, count(*) AS n, count(atlas_price_id) AS n_id,
               count(price_datetime) AS n_date, count(atlas_game_id) AS n_game FROM prices""",
    "list_checks": """
        SELECT 'lists' AS table_name, count(*) AS n, count(list_item_id) AS n_id,
               count(post_datetime) AS n_date, count(geeklist_id) AS n_list,
               count(bgg_game_id) AS n_game FROM lists""",
    "price_report": """
        SELECT table_name, 'has_rows' AS check_name, CAST(NULL AS STRING) AS column_name,
               'error' AS severity, n > 0 AS passed, n AS observed, CAST(NULL AS BIGINT) AS expected
        FROM price_checks
        UNION ALL SELECT table_name, 'column_count', NULL, 'error', true, 14, 14 FROM price_checks
        UNION ALL SELECT table_name, 'not_null', 'atlas_price_id', 'error', n_id = n, n - n_id, 0
        FROM price_checks
        UNION ALL SELECT table_name, 'not_null', 'price_datetime', 'error', n_date = n, n - n_date, 0
        FROM price_checks
        UNION ALL SELECT table_name, 'not_null', 'atlas_game_id', 'warn', n_game = n, n - n_game, 0
        FROM price_checks""",
    "list_report": """
        SELECT table_name, 'has_rows' AS check_name, CAST(NULL AS STRING) AS column_name,
               'error' AS severity, n > 0 AS passed, n AS observed, CAST(NULL AS BIGINT) AS expected
        FROM list_checks
        UNION ALL SELECT table_name, 'column_count', NULL, 'error', true, 11, 11 FROM list_checks
        UNION ALL SELECT table_name, 'not_null', 'list_item_id', 'error', n_id = n, n - n_id, 0
        FROM list_checks
        UNION ALL SELECT table_name, 'not_null', 'post_datetime', 'error', n_date = n, n - n_date, 0
        FROM list_checks
        UNION ALL SELECT table_name, 'not_null', 'geeklist_id', 'warn', n_list = n, n - n_list, 0
        FROM list_checks
        UNION ALL SELECT table_name, 'not_null', 'bgg_game_id', 'warn', n_game = n, n - n_game, 0
        FROM list_checks""",
    "bgg_report": """
        SELECT 'bgg_games' AS table_name, 'has_rows' AS check_name,
               CAST(NULL AS STRING) AS column_name, 'error' AS severity, count(*) > 0 AS passed,
               count(*) AS observed, CAST(NULL AS BIGINT) AS expected FROM bgg_games
        UNION ALL SELECT 'bgg_games', 'column_count', NULL, 'error', true, 18, 18
        UNION ALL SELECT 'bgg_games', 'not_null', 'bgg_game_id', 'error',
               count(bgg_game_id) = count(*), count(*) - count(bgg_game_id), 0 FROM bgg_games""",
    "user_report": """
        SELECT 'users' AS table_name, 'has_rows' AS check_name,
               CAST(NULL AS STRING) AS column_name, 'error' AS severity, count(*) > 0 AS passed,
               count(*) AS observed, CAST(NULL AS BIGINT) AS expected FROM users
        UNION ALL SELECT 'users', 'column_count', NULL, 'error', true, 11, 11
        UNION ALL SELECT 'users', 'not_null', 'user_id', 'error',
               count(user_id) = count(*), count(*) - count(user_id), 0 FROM users
        UNION ALL SELECT 'users', 'not_null', 'user_name', 'error',
               count(user_name) = count(*), count(*) - count(user_name), 0 FROM users""",
    "atlas_report": """
        SELECT 'atlas_games' AS table_name, 'has_rows' AS check_name,
               CAST(NULL AS STRING) AS column_name, 'error' AS severity, count(*) > 0 AS passed,
               count(*) AS observed, CAST(NULL AS BIGINT) AS expected FROM atlas_games
        UNION ALL SELECT 'atlas_games', 'column_count', NULL, 'error', true, 18, 18
        UNION ALL SELECT 'atlas_games', 'not_null', 'atlas_game_id', 'error',
               count(atlas_game_id) = count(*), count(*) - count(atlas_game_id), 0 FROM atlas_games""",
    "review_report": """
        SELECT 'reviews' AS table_name, 'has_rows' AS check_name,
               CAST(NULL AS STRING) AS column_name, 'error' AS severity, count(*) > 0 AS passed,
               count(*) AS observed, CAST(NULL AS BIGINT) AS expected FROM reviews
        UNION ALL SELECT 'reviews', 'column_count', NULL, 'error', true, 10, 10
        UNION ALL SELECT 'reviews', 'not_null', 'review_id', 'error',
               count(review_id) = count(*), count(*) - count(review_id), 0 FROM reviews
        UNION ALL SELECT 'reviews', 'not_null', 'review_datetime', 'error',
               count(review_datetime) = count(*), count(*) - count(review_datetime), 0 FROM reviews
        UNION ALL SELECT 'reviews', 'not_null', 'user_id', 'warn',
               count(user_id) = count(*), count(*) - count(user_id), 0 FROM reviews
        UNION ALL SELECT 'reviews', 'not_null', 'atlas_game_id', 'warn',
               count(atlas_game_id) = count(*), count(*) - count(atlas_game_id), 0 FROM reviews
        UNION ALL SELECT 'reviews', 'not_null', 'rating', 'warn',
               count(rating) = count(*), count(*) - count(rating), 0 FROM reviews""",
    "time_report": """
        SELECT 'time' AS table_name, 'has_rows' AS check_name,
               CAST(NULL AS STRING) AS column_name, 'error' AS severity, count(*) > 0 AS passed,
               count(*) AS observed, CAST(NULL AS BIGINT) AS expected FROM kept_stamps
        UNION ALL SELECT 'time', 'column_count', NULL, 'error', true, 8, 8
        UNION ALL SELECT 'time', 'not_null', 'datetime', 'error',
               count(datetime) = count(*), count(*) - count(datetime), 0 FROM kept_stamps""",
}

# Fixed pattern, as in functions.text; this engine needs the flag to replace every match.
_CLEAN = (
    "trim(regexp_replace(regexp_replace(regexp_replace(lower(game_name), '[^\\p{L}\\p{N}]+', ' ', 'g'),"
    " '\\b(brand new|sealed|[0-9]+(st|nd|rd|th) ed(ition)?)\\b', ' ', 'g'), ' +', ' ', 'g'))"
)


def _needed(sql: str, seen: dict[str, str]) -> None:
    for word in re.findall(r"\w+", sql):
        if word in VIEWS and word not in seen and re.search(rf"\b(FROM|JOIN)\s+{word}\b", sql):
            body = VIEWS[word].replace("{clean}", _CLEAN)
            _needed(body, seen)
            seen[word] = body


def _sql(statement: str) -> str:
    steps: dict[str, str] = {}
    _needed(statement, steps)
    if not steps:
        return statement
    return "WITH " + ", ".join(f"{n} AS ({b})" for n, b in steps.items()) + " " + statement


_CALENDAR = """CAST(minute({t}) AS INT) AS minute, CAST(hour({t}) AS INT) AS hour,
    CAST(day({t}) AS INT) AS day, CAST(week({t}) AS INT) AS week, CAST(month({t}) AS INT) AS month,
    CAST(year({t}) AS INT) AS year, CAST(dayofweek({t}) + 1 AS INT) AS weekday"""

_ALL_REPORTS = " UNION ALL ".join(
    f"SELECT * FROM {name}_report"
    for name in ("bgg", "user", "atlas", "review", "price", "list", "time")
)

_TABLE_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {view}"
    for name, view in {
        "bgg_games": "bgg_games",
        "users": "users",
        "atlas_games": "atlas_games",
        "reviews": "reviews",
        "prices": "prices",
        "lists": "lists",
        "time": "kept_stamps",
    }.items()
)


def _coverage(table: str, keys: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{k}' AS column_name, count(*) AS n_rows,"
        f" count({k}) AS n_with_key, count({k}) / count(*) AS share FROM {table}"
        for k in keys
    )


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


_DMY = "coalesce(strftime(extracted, '%d/%m/%Y %H:%M:%S'), 'not a date')"

_GAME_RANGES = {
    "max_players": "max_players > 0",
    "min_age": "min_age BETWEEN 0 AND 21",
    "year_published": "year_published >= 1990",
    "players": "min_players <= max_players",
}
_RANGES = {
    "atlas_games": _GAME_RANGES,
    "bgg_games": _GAME_RANGES,
    "reviews": {"rating": "rating BETWEEN 0 AND 5 AND rating * 4 % 1 = 0"},
    "prices": {"price": "price > 0", "msrp": "price <= msrp"},
}


def _range_report(table: str, rules: dict[str, str]) -> str:
    head = f"SELECT '{table}' AS table_name"
    width = len(TABLES[table])
    rows = [
        f"{head}, 'has_rows' AS check_name, CAST(NULL AS STRING) AS column_name, 'error' AS severity,"
        f" count(*) > 0 AS passed, count(*) AS observed, CAST(NULL AS BIGINT) AS expected FROM {table}",
        f"{head}, 'column_count', NULL, 'error', true, {width}, {width}",
    ]
    rows += [
        f"{head}, 'range', '{name}', 'warn', count(*) FILTER (NOT ({rule})) = 0, count(*) FILTER (NOT ({rule})), 0 FROM {table}"
        for name, rule in rules.items()
    ]
    return " UNION ALL ".join(rows)


# Columns of the tables by kind, as far as a profile describes them.
_KINDS = {
    "bgg_games": {
        "whole": ["bgg_game_id", "max_players", "max_playtime", "min_age", "min_players", "min_playtime", "year_published", "num_ratings"],
        "real": ["average_rating"],
        "text": ["game_name", "artist", "category", "compilation", "designer", "family", "mechanic", "publisher"],
    },
    "users": {
        "whole": ["atlas_exp", "atlas_level", "user_id"],
        "real": ["atlas_gold"],
        "text": ["user_name", "url", "description", "atlas_user_id"],
    },
    "atlas_games": {
        "whole": ["year_published", "min_players", "max_players", "min_playtime", "max_playtime", "min_age", "num_ratings", "num_complexity"],
        "real": ["average_rating", "average_learning_complexity", "average_strategy_complexity"],
        "text": ["atlas_game_id", "game_name", "url", "primary_publisher", "primary_designer", "artists"],
    },
    "reviews": {
        "whole": ["year", "month", "bgg_game_id", "user_id"],
        "real": ["rating"],
        "text": ["game_name", "atlas_game_id", "review_id", "description"],
    },
    "prices": {
        "whole": ["year", "month", "bgg_game_id"],
        "real": ["price", "msrp"],
        "text": ["game_name", "atlas_price_id", "currency", "url", "store_name", "country", "price_category", "atlas_game_id"],
    },
    "lists": {
        "whole": ["geeklist_id", "bgg_game_id", "list_item_id", "year", "month"],
        "real": [],
        "text": ["game_name", "objtype", "bgg_user_name", "description", "atlas_game_id"],
    },
    "time": {"whole": ["minute", "hour", "day", "week", "month", "year", "weekday"], "real": [], "text": []},
    "lineitem": {
        "whole": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
        "real": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        "text": ["l_returnflag", "l_linestatus"],
    },
}


def _described(table: str, whole: list[str], real: list[str], text: list[str]) -> str:
    view = f"(SELECT {_CALENDAR.format(t='datetime')} FROM kept_stamps)" if table == "time" else table
    rows = []
    for c in [*whole, *real, *text]:
        stats = {"count": f"count({c})", "mean": "max(NULL)", "stddev": "max(NULL)", "min": f"min({c})", "max": f"max({c})"}
        if c in real:  # no negative zero
            stats |= {"min": f"min({c}) + 0", "max": f"max({c}) + 0"}
        if c not in text:
            stats |= {"mean": f"printf('%.5f', avg({c}))", "stddev": f"printf('%.5f', stddev_samp({c}))"}
        rows += [
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{stat}' AS stat, CAST({value} AS STRING) AS value FROM {view}"
            for stat, value in stats.items()
        ]
    return " UNION ALL ".join(rows)


_STATEMENTS = {
    "scan_csv": "SELECT * FROM part",
    "scan_csv_multiline": "SELECT * FROM documents",
    "scan_json_array": "SELECT * FROM shape_accounts",
    "scan_json_glob": f"""SELECT id, {_iso('created')} AS "createdAt", {_iso('created')} AS date, user_id,
        game_id, rating, description FROM shape_reviews""",
    "scan_json_nested_glob": f"""SELECT id, {_iso('updated')} AS updated_at, name, price, currency, msrp,
        url, store_name, country, price_category, price_category AS folder FROM shape_prices""",
    "scan_parquet": "SELECT p_partkey AS bgg_game_id, p_name AS game_name FROM part",
    "sink_parquet_by_col": "SELECT * FROM bgg_games",
    "sink_parquet_by_month": "SELECT * EXCLUDE (atlas_game_id, bgg_game_id) FROM prices",
    "project_alias": """SELECT username AS user_name, url, description, gold AS atlas_gold,
        experience AS atlas_exp, level AS atlas_level FROM shape_accounts""",
    "project_nested_field": """SELECT id AS atlas_game_id, publisher AS primary_publisher,
        designer AS primary_designer FROM shape_atlas_games""",
    "rename_columns": f"""SELECT CAST(bgg_id AS INT) AS bgg_game_id, maxplayers AS max_players,
        maxplaytime AS max_playtime, age AS min_age, minplayers AS min_players,
        minplaytime AS min_playtime, name AS game_name, year_published, artist, category,
        compilation, designer, family, mechanic, publisher, users_rated AS num_ratings,
        average_rating, {_DMY} AS datetime_extracted FROM shape_bgg_games""",
    "derive_columns": """SELECT id, updated AS price_datetime, CAST(year(updated) AS INT) AS year,
        CAST(month(updated) AS INT) AS month FROM shape_prices""",
    "drop_column": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "cast_lenient": """SELECT CAST(bgg_id AS INT) AS bgg_id,
        TRY_CAST(TRY_CAST(year_published AS DOUBLE) AS INT) AS year_published FROM shape_bgg_games""",
    "drop_null_keys": "SELECT username, url FROM shape_accounts WHERE username IS NOT NULL",
    "filter_is_null": "SELECT id, user_id FROM shape_reviews WHERE game_id IS NULL",
    "stamp_extracted": """SELECT p_partkey AS bgg_id, '15/01/2023 10:30:00' AS datetime_extracted
        FROM part""",
    "join_users_left": "SELECT * FROM joined_users",
    "lookup_game_name": "SELECT review_id, atlas_game_id, game_name FROM reviews",
    "lookup_by_name": "SELECT atlas_price_id, game_name, atlas_game_id FROM prices",
    "replace_with_surrogate": "SELECT review_id, user_id, rating FROM reviews",
    "antijoin_new_ids": """SELECT DISTINCT game_id FROM shape_reviews WHERE game_id IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM prices WHERE atlas_game_id = game_id)""",
    "crossjoin_rating_grid": """SELECT username, CAST(r.range * 0.25 AS DOUBLE) AS rating
        FROM shape_accounts, range(21) r WHERE username IS NOT NULL""",
    "join_time_dim": """SELECT CAST(dayofweek(post_datetime) + 1 AS INT) AS weekday,
        CAST(hour(post_datetime) AS INT) AS hour, count(*) AS n_items FROM posted_items GROUP BY 1, 2""",
    "dedupe_pk": """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
              l_shipdate DESC, l_partkey DESC, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1""",
    "dedupe_name_lookup": "SELECT * FROM bgg_names",
    "distinct_datetimes": "SELECT DISTINCT o_orderdate AS datetime FROM orders",
    "count_rows": "SELECT count(*) AS n_rows FROM lineitem",
    "count_nulls": """SELECT count(*) - count(id) AS id_nulls, count(*) - count(game_id)
        AS game_id_nulls, count(*) - count(description) AS description_nulls,
        count(*) - count(created) AS createdAt_nulls, count(*) - count(created) AS date_nulls,
        count(*) - count(user_id) AS user_id_nulls, count(*) - count(rating) AS rating_nulls
        FROM shape_reviews""",
    "describe_profile": f"SELECT * EXCLUDE (table_name) FROM ({_described('lineitem', **_KINDS['lineitem'])})",
    "profile_tables": " UNION ALL ".join(_described(t, **_KINDS[t]) for t in TABLES),
    "union_all_datetimes": """SELECT datetime, count(*) AS n_rows FROM (
        SELECT o_orderdate AS datetime FROM orders UNION ALL SELECT l_shipdate FROM lineitem
        UNION ALL SELECT ts FROM events) GROUP BY datetime""",
    "union_parts": """SELECT s_name AS name, s_suppkey AS id, s_acctbal AS gold FROM supplier
        UNION ALL SELECT p_name, p_partkey, NULL FROM part""",
    "peek_top5": """SELECT bgg_game_id, game_name, year_published, average_rating FROM bgg_games
        ORDER BY bgg_game_id LIMIT 5""",
    "dense_user_id": "SELECT user_id, user_name, atlas_user_id FROM users",
    "dense_list_item_id": """SELECT list_item_id, geeklist_id, post_datetime, bgg_user_name
        FROM lists""",
    "parse_ts_dmy": """SELECT CAST(bgg_id AS INT) AS bgg_id, average_rating, extracted
        FROM shape_bgg_games""",
    "parse_ts_iso": "SELECT event_id, date_trunc('millisecond', ts) AS parsed FROM events",
    "parse_ts_rfc822": """SELECT CAST(geeklist_id AS STRING) AS geeklist_id, username AS "user",
        date_trunc('second', posted) AS posted FROM shape_lists""",
    "calendar_parts": f"SELECT event_id, {_CALENDAR.format(t='ts')} FROM events",
    "join_list_column": """SELECT id, concat_ws(',', artist1, artist2) AS artists
        FROM shape_atlas_games""",
    "primary_name": """SELECT p_partkey, CASE WHEN p_size > 40 THEN p_name WHEN p_size > 25
        THEN p_type ELSE p_brand END AS name FROM part""",
    "dim_bgg_details": "SELECT * FROM bgg_games",
    "dim_atlas_users": "SELECT * FROM users",
    "dim_atlas_details": "SELECT * FROM atlas_games",
    "fact_reviews": "SELECT * FROM reviews",
    "fact_prices": "SELECT * FROM prices",
    "fact_lists": "SELECT * FROM lists",
    "dim_time": f"SELECT datetime, {_CALENDAR.format(t='datetime')} FROM kept_stamps",
    "mart_summary": _TABLE_COUNTS,
    "mart_from_harvest": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys,"
        f" CAST(sum({'epoch(datetime)' if t == 'time' else 'length(user_name)' if t == 'users' else 'length(game_name)'})"
        f" AS BIGINT) AS carried FROM {'kept_stamps' if t == 'time' else t}"
        for t, k in TABLE_KEYS.items()
    ),
    "dq_report": "SELECT * FROM price_report",
    "dq_gate_summary": f"""SELECT table_name, count(*) AS total_checks,
        count(*) FILTER (passed) AS passed_checks, count(*) FILTER (NOT passed) AS failed_checks,
        count(*) FILTER (NOT passed AND severity = 'error') = 0 AS gate_open
        FROM ({_ALL_REPORTS}) GROUP BY table_name""",
    "dq_audit_tables": _ALL_REPORTS,
    "dq_pk_unique": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS column_name, count({c}) - count(DISTINCT {c}) AS n_repeats,"
        f" count({c}) = count(DISTINCT {c}) AS passed FROM {view}"
        for t, k, c, view in (
            ("raw_prices", "atlas_price_id", "id", "shape_prices"),
            *((t, k, k, "kept_stamps" if t == "time" else t) for t, k in TABLE_KEYS.items()),
        )
    ),
    "dq_range_rules": " UNION ALL ".join(_range_report(t, rules) for t, rules in _RANGES.items()),
    "dq_join_coverage": " UNION ALL ".join(
        [
            _coverage("reviews", ("game_name", "atlas_game_id", "bgg_game_id", "user_id")),
            _coverage("prices", ("atlas_game_id", "bgg_game_id")),
            _coverage("lists", ("atlas_game_id", "bgg_game_id")),
        ]
    ),
    "popularity_trend": """SELECT game_name, year, month, count(*) AS n_reviews,
        avg(rating) AS avg_rating FROM reviews WHERE game_name IS NOT NULL
        GROUP BY game_name, year, month""",
    "top_recent_games": """
        SELECT t.*, a.year_published AS atlas_year, a.primary_publisher,
               a.min_players AS atlas_min_players, a.max_players AS atlas_max_players,
               b.year_published AS bgg_year, b.designer, b.average_rating AS bgg_rating
        FROM (SELECT atlas_game_id, game_name, bgg_game_id, count(*) AS n_reviews,
                     avg(rating) AS avg_rating
              FROM reviews WHERE game_name IS NOT NULL AND review_datetime >
                   (SELECT max(review_datetime) FROM reviews) - INTERVAL 365 DAY
              GROUP BY atlas_game_id, game_name, bgg_game_id
              ORDER BY n_reviews DESC, avg_rating DESC, atlas_game_id LIMIT 10) t
             LEFT JOIN atlas_games a ON t.atlas_game_id = a.atlas_game_id
             LEFT JOIN bgg_games b ON t.bgg_game_id = b.bgg_game_id""",
    "high_rater_profile": """SELECT u.atlas_level, u.atlas_premium, count(*) AS n_reviews,
        count(DISTINCT u.user_id) AS n_users, count(*) FILTER (r.rating >= 4) / count(*) AS high_share
        FROM reviews r LEFT JOIN users u ON r.user_id = u.user_id GROUP BY 1, 2""",
    "price_changes": """
        SELECT atlas_price_id, bgg_game_id, store_name, currency, price_datetime, price, prev_price,
               price - prev_price AS price_diff
        FROM (SELECT *, lag(price) OVER (PARTITION BY bgg_game_id, store_name, currency
                        ORDER BY price_datetime, atlas_price_id) AS prev_price
              FROM prices WHERE bgg_game_id IS NOT NULL)""",
    "best_price_ever": "SELECT * FROM best_prices",
    "trending_lists": """SELECT bgg_game_id, n_now, n_before, n_now - n_before AS change FROM (
        SELECT bgg_game_id, count(*) FILTER (post_datetime > mx - INTERVAL 7 DAY) AS n_now,
               count(*) FILTER (post_datetime <= mx - INTERVAL 7 DAY
                                AND post_datetime > mx - INTERVAL 14 DAY) AS n_before
        FROM posted_items CROSS JOIN (SELECT max(post_datetime) AS mx FROM posted_items)
        GROUP BY bgg_game_id) WHERE n_now + n_before > 0""",
    "compare_sources": """
        SELECT a.game_name, a.atlas_game_id, a.year_published AS atlas_year,
               a.average_rating AS atlas_rating, a.num_ratings AS atlas_num_ratings,
               a.min_players AS atlas_min_players, a.max_players AS atlas_max_players,
               b.bgg_game_id, b.year_published AS bgg_year, b.average_rating AS bgg_rating,
               b.num_ratings AS bgg_num_ratings, b.min_players AS bgg_min_players,
               b.max_players AS bgg_max_players
        FROM atlas_games a JOIN bgg_names n ON a.game_name = n.game_name
             JOIN bgg_games b ON n.bgg_game_id = b.bgg_game_id""",
    "game_scorecard": """
        SELECT coalesce(r.bgg_game_id, l.bgg_game_id, p.bgg_game_id) AS bgg_game_id, r.n_reviews,
               r.avg_rating, l.n_mentions, p.currency, p.best_price
        FROM (SELECT bgg_game_id, count(*) AS n_reviews, avg(rating) AS avg_rating FROM reviews
              WHERE bgg_game_id IS NOT NULL GROUP BY bgg_game_id) r
        FULL OUTER JOIN (SELECT bgg_game_id, count(*) AS n_mentions FROM posted_items
              GROUP BY bgg_game_id) l ON r.bgg_game_id = l.bgg_game_id
        FULL OUTER JOIN (SELECT bgg_game_id, currency, min(price) AS best_price FROM prices
              WHERE bgg_game_id IS NOT NULL GROUP BY bgg_game_id, currency) p
             ON coalesce(r.bgg_game_id, l.bgg_game_id) = p.bgg_game_id""",
    "match_clean_names": """SELECT p.atlas_price_id, p.game_name, p.clean_name, g.bgg_game_id
        FROM clean_prices p LEFT JOIN clean_games g ON p.clean_name = g.clean_name""",
    "match_contained_names": """
        SELECT p.atlas_price_id, p.game_name, m.bgg_game_id
        FROM prices p LEFT JOIN (
            SELECT game_name, bgg_game_id FROM (
                SELECT c.game_name, g.bgg_game_id, row_number() OVER (PARTITION BY c.game_name
                    ORDER BY len(string_split(g.clean_name, ' ')) DESC, g.bgg_game_id) AS rn
                FROM (SELECT DISTINCT game_name, clean_name FROM clean_prices) c
                JOIN clean_games g ON contains(concat(' ', c.clean_name, ' '),
                                               concat(' ', g.clean_name, ' '))) WHERE rn = 1
        ) m ON p.game_name = m.game_name""",
    "xml_games": """
        SELECT CAST(p_partkey AS INT) AS bgg_id, CAST(p_size AS INT) AS maxplayers,
               CAST(p_size AS INT) AS maxplaytime, CAST(p_size AS INT) AS age,
               CAST(p_size AS INT) AS minplayers, CAST(p_size AS INT) AS minplaytime,
               p_name AS name, CASE WHEN p_size > 10 THEN '1999' ELSE 'soon' END AS year_published,
               p_brand AS artist, concat(p_type, ',', p_brand) AS category, '' AS compilation,
               concat(p_name, ' & <sons>') AS designer, concat(p_type, ',', p_brand) AS family,
               p_type AS mechanic, p_name AS publisher, CAST(p_size AS INT) AS users_rated,
               p_retailprice AS average_rating FROM part""",
    "xml_list_items": """
        SELECT CAST(geeklist_id AS STRING) AS geeklist_id, objtype, CAST(game_id AS STRING) AS game_id,
               name, username AS "user", CASE WHEN posted IS NULL THEN 'some day'
               WHEN western THEN concat(strftime(posted - INTERVAL 5 HOUR, '%a, %d %b %Y %H:%M:%S'),
                                        ' -0500')
               ELSE concat(strftime(posted, '%a, %d %b %Y %H:%M:%S'), ' +0000') END AS postdate,
               bodytext FROM shape_lists""",
    "land_csv": f"""
        SELECT * EXCLUDE (extracted) REPLACE (CAST(bgg_id AS INT) AS bgg_id,
                   CASE WHEN extracted = CAST('2023-01-15 10:30:00' AS TIMESTAMP) THEN NULL
                        ELSE year_published END AS year_published),
               {_DMY} AS datetime_extracted FROM shape_bgg_games""",
    "split_reviews": f"""SELECT id, {_iso('created')} AS "createdAt", {_iso('created')} AS date, rating,
        description, user_id, game_id FROM shape_reviews""",
    "latest_user_profile": "SELECT * FROM profiles",
    "distinct_game_ids": """SELECT DISTINCT game_id FROM shape_reviews WHERE game_id IS NOT NULL""",
    "explode_prices": f"""SELECT id, {_iso('updated')} AS updated_at, name, price, currency, msrp, url,
        store_name, country, price_category FROM shape_prices""",
    "truncation_audit": """
        SELECT a.username, CAST(k.range * 0.25 AS DOUBLE) AS rating, coalesce(n, 0) AS n_reviews,
               coalesce(n, 0) > 2 AS truncated
        FROM shape_accounts a CROSS JOIN range(21) k LEFT JOIN (
             SELECT username, rating, count(*) AS n FROM shape_reviews GROUP BY username, rating) r
             ON a.username = r.username AND k.range * 0.25 = r.rating
        WHERE a.username IS NOT NULL""",
    "compact_json": f"""SELECT 'p' AS letter, id, {_iso('created')} AS "createdAt",
        {_iso('created')} AS date, user_id, game_id, rating, description FROM shape_reviews""",
    "users_with_name": "SELECT * FROM shape_accounts WHERE username IS NOT NULL",
    "batch_ids": """
        SELECT batch, string_agg(game_id, ',' ORDER BY game_id) AS ids FROM (
            SELECT game_id, CAST(floor((row_number() OVER (ORDER BY game_id) - 1) / 10) AS BIGINT)
                   AS batch
            FROM (SELECT DISTINCT game_id FROM shape_reviews WHERE game_id IS NOT NULL))
        GROUP BY batch""",
    "count_json_records": """SELECT 'users' AS dataset, count(*) AS n_records FROM shape_accounts
        UNION ALL SELECT 'games', count(*) FROM shape_atlas_games
        UNION ALL SELECT 'reviews', count(*) FROM shape_reviews""",
    "incremental_reviews": "SELECT * FROM reviews",
    "schema_rows": " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count({name}) AS n_values"
        " FROM bgg_games"
        for name, kind in {
            **{
                c: "int"
                for c in (
                    "bgg_game_id", "max_players", "max_playtime", "min_age", "min_players",
                    "min_playtime", "year_published", "num_ratings",
                )
            },
            **{
                c: "string"
                for c in (
                    "game_name", "artist", "category", "compilation", "designer", "family",
                    "mechanic", "publisher",
                )
            },
            "average_rating": "double",
            "datetime_extracted": "timestamp",
        }.items()
    ),
}

ORACLE = {name: _sql(statement) for name, statement in _STATEMENTS.items()}
