"""SQL of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

from ludomart.llm import sharding
from ludomart.llm.queries import DOMAIN, WEIGHTS


def sharding_sql(limit: int = sharding.LIMIT_BYTES) -> str:
    return f"""
    WITH d AS (
        SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
               ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h
        FROM documents),
    t AS (
        SELECT depth, h >> (60 - depth) AS prefix, sum(n_bytes)::BIGINT AS bytes, count(*) AS n
        FROM d, (SELECT CAST(unnest(range(61)) AS INTEGER) AS depth) GROUP BY ALL),
    leaf AS (
        SELECT c.* FROM t c LEFT JOIN t p ON p.depth = c.depth - 1 AND p.prefix = c.prefix >> 1
        WHERE (c.bytes <= {limit} OR c.n = 1 OR c.depth = 60)
          AND (c.depth = 0 OR (p.bytes > {limit} AND p.n > 1)))
    SELECT doc_id, n_bytes,
           CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard_id,
           depth AS shard_depth, bytes AS shard_bytes, n AS shard_rows
    FROM d JOIN leaf ON h >> (60 - depth) = prefix"""


def mixing_sql(share: str = "1.0", epochs: int = 4, seed: int = 17) -> str:
    def weight(level: str) -> str:
        own = [(k.split("=")[1], w) for k, w in WEIGHTS.items() if k.startswith(level + "=")]
        cases = " ".join(f"WHEN {level} = '{v}' THEN {w}" for v, w in own)
        return f"CASE {cases} ELSE 1 END" if cases else "1"

    parts = []
    keys: list[str] = []
    for level in ("domain", "lang", "source"):
        up, keys = list(keys), [*keys, level]
        over = f"PARTITION BY {', '.join(up)}" if up else ""
        same = " AND ".join(f"n.{k} IS NOT DISTINCT FROM b.{k}" for k in up) or "true"
        parent = "b_" + up[-1] if up else "b_root"
        order = f"ORDER BY cap / weight, coalesce('=' || {level}, '-') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        names = ", ".join(keys)
        parts.append(f"""
    n_{level} AS (
        SELECT {', '.join('n.' + k for k in keys)}, cap, {weight(level).replace(level + ' =', 'n.' + level + ' =')} AS weight, budget
        FROM (SELECT {names}, sum(tokens) * {epochs} AS cap FROM leaf GROUP BY {names}) n JOIN {parent} b ON {same}),
    f_{level} AS (
        SELECT *, cap * (sum(weight) OVER ({over}) - coalesce(sum(weight) OVER ({over} {order}), 0))
                  <= weight * (budget - coalesce(sum(cap) OVER ({over} {order}), 0)) AS is_full FROM n_{level}),
    b_{level} AS (
        SELECT {names}, CASE WHEN is_full THEN cap ELSE
               (weight * (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({over})))
               // sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({over}) END AS budget FROM f_{level})""")
    return f"""
    WITH d AS (
        SELECT doc_id, {DOMAIN.replace("regexp_extract(source, '[0-9]+', 0)", "regexp_extract(source, '[0-9]+')")} AS domain, lang, source,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
        FROM documents),
    leaf AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
    b_root AS (SELECT least(sum(tokens) * {epochs}, floor(sum(tokens) * {share})::BIGINT) AS budget FROM leaf),
    {','.join(parts)},
    l AS (
        SELECT leaf.*, budget, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
               CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
        FROM leaf JOIN b_source b ON leaf.domain IS NOT DISTINCT FROM b.domain
             AND leaf.lang IS NOT DISTINCT FROM b.lang AND leaf.source IS NOT DISTINCT FROM b.source),
    o AS (
        SELECT d.*, tokens, budget, whole, rest,
               md5(concat('{seed}:', CAST(whole AS BIGINT), ':', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h
        FROM d JOIN l ON d.domain IS NOT DISTINCT FROM l.domain
             AND d.lang IS NOT DISTINCT FROM l.lang AND d.source IS NOT DISTINCT FROM l.source),
    r AS (
        SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
                                      ORDER BY substr(h, 1, 15), CAST(doc_id AS VARCHAR)) AS upto FROM o)
    SELECT doc_id, lang, source, n_tokens, CAST(tokens AS BIGINT) AS leaf_tokens,
           CAST(budget AS BIGINT) AS leaf_budget,
           CAST(whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS INTEGER) AS copies
    FROM r"""



DECONTAMINATION = r"""
    WITH d AS (
        SELECT doc_id, row_number() OVER () AS r,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
    b AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
    q AS (
        SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, len(w)) AS k,
               array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
        FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
    s AS (
        SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
        FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
              FROM d, (SELECT DISTINCT k FROM q) WHERE len(w) >= k)),
    h AS (SELECT r, i, k, item FROM s JOIN q USING (k, win)),
    n AS (
        SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM h)) GROUP BY r),
    g AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM h GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN n USING (r) LEFT JOIN g USING (r)"""

WARC = """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
    g AS (SELECT h, max(page_id) AS last FROM p GROUP BY h)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
           array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
               ((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) AS BIGINT), 1)
               FOR i IN range(32)], '') AS payload_digest,
           CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
    FROM p JOIN g USING (h)"""

def crc32_sql(text: str) -> str:
    """The unsigned crc32 of ASCII text, from its polynomial."""
    bits = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, CASE WHEN {text} = '' THEN [] ELSE {codes} END), lambda c, b: {bits}), 4294967295::BIGINT)"


RUNS = rf"""
    WITH w0 AS (
        SELECT doc_id, {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h,
               list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    w1 AS (SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS hit, len(w) AS n, h // 10 AS g FROM w0),
    w2 AS (
        SELECT doc_id, CASE WHEN hit THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < g % n THEN i
                   ELSE g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) END]) ELSE w END AS w
        FROM w1),
    pos AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM w2),
    same AS (
        SELECT a.doc_id, a.i, b.i - a.i AS q
        FROM pos a JOIN pos b ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i),
    island AS (
        SELECT doc_id, q, min(i) AS s, count(*) AS m
        FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS grp FROM same)
        GROUP BY doc_id, q, grp HAVING count(*) >= q AND count(*) + q >= 12),
    run AS (SELECT doc_id, s, m + q AS length, min(q) AS p FROM island GROUP BY doc_id, s, m + q),
    listed AS (
        SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || length || ',' || p || chr(10), '' ORDER BY s, p) AS lines,
               min({{'l': -length, 's': s, 'p': p}}) AS best
        FROM run GROUP BY doc_id),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
        FROM pos WHERE NOT EXISTS (
            SELECT 1 FROM run r WHERE r.doc_id = pos.doc_id AND pos.i >= r.s + r.p AND pos.i < r.s + r.length)
        GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s AS start, (-best.l)::BIGINT AS length,
           best.p AS period, (-best.l * 1000 // best.p)::BIGINT AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
    FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""

TRIE = rf"""
    WITH t AS (
        SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
        FROM conversations WHERE conv_id IS NOT NULL),
    own AS (SELECT conv_id, list({{'k': k, 'w': w}} ORDER BY turn NULLS FIRST, k, w) AS p FROM t GROUP BY conv_id),
    cut AS (SELECT *, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM own),
    path AS (
        SELECT c.conv_id, list_concat(coalesce(b.p[1:h], []), c.p[h + 1:]) AS p
        FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
    member AS (
        SELECT conv_id, depth, md5(array_to_string(list_transform(p[1:depth], lambda x: x.k), ',')) AS label,
               depth = len(p) AS ended, CASE WHEN depth = 0 THEN 0 ELSE p[depth].w END AS w
        FROM (SELECT *, unnest(range(len(p) + 1)) AS depth FROM path)),
    node AS (
        SELECT depth, label, min(conv_id) AS conv_id, count(*) AS n, max(w) AS w,
               coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '') AS ends
        FROM member GROUP BY depth, label),
    parent AS (
        SELECT node.depth, node.label, up.label AS up_label
        FROM node JOIN member up ON up.conv_id = node.conv_id AND up.depth = node.depth - 1),
    kids AS (SELECT depth - 1 AS depth, up_label AS label, count(*) AS n_children FROM parent GROUP BY ALL),
    full_ AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (depth, label)),
    below AS (
        SELECT up.depth, up.label, sum((v.n_children = 0)::INT) AS n_leaves, sum((v.n - 1) * v.w) AS saved
        FROM full_ v JOIN member up ON up.conv_id = v.conv_id AND up.depth <= v.depth GROUP BY ALL)
    SELECT v.depth::BIGINT AS depth, v.conv_id, u.conv_id AS parent_conv_id, v.n::BIGINT AS n_convs,
           v.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
           sha256(v.ends) AS ends_sha256
    FROM full_ v JOIN below USING (depth, label) LEFT JOIN parent p USING (depth, label)
    LEFT JOIN node u ON u.depth = v.depth - 1 AND u.label = p.up_label"""

ORACLE = {
    "op1_extendible_sharding": sharding_sql(),
    "op3_source_mixture": mixing_sql(),
    "op4_warc_round_trip": WARC,
    "op8_suffix_decontamination": DECONTAMINATION,
    "op11_prefix_trie": TRIE,
    "op13_periodic_runs": RUNS,
}
