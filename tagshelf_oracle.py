"""One DuckDB query per registered query, written over the given tables without the library."""

from __future__ import annotations

AS_OF = "DATE '2026-01-01'"

# The catalogue as common table expressions: as loaded (0), cleaned (1), without non-games (2).
LOADED = """
l AS (
  SELECT l_orderkey AS k, CAST(sum(l_quantity) AS BIGINT) AS q, count(*) AS n,
         CAST(coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) AS BIGINT) AS pos,
         CAST(coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0) AS BIGINT) AS neg
  FROM lineitem GROUP BY l_orderkey),
games0 AS (
  SELECT o_orderkey AS appid,
         CASE WHEN o_orderkey % 50 = 0 THEN 'Order Test ' ELSE 'Order ' END || CAST(o_orderkey AS VARCHAR) AS name,
         CASE WHEN o_orderkey % 11 = 0 THEN 'Coming soon'
              WHEN o_orderkey % 17 = 0 THEN 'Feb 30, 2000'
              WHEN o_orderkey % 10 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
              ELSE strftime(o_orderdate, '%b %-d, %Y') END AS release_date,
         CASE WHEN o_orderkey % 101 = 0 THEN -1.0::DOUBLE
              WHEN o_orderkey % 103 = 0 THEN 1500.0::DOUBLE
              WHEN o_orderkey % 13 = 0 THEN NULL
              WHEN o_orderkey % 7 = 0 THEN 0.0::DOUBLE
              ELSE CAST(round(CAST(o_totalprice / 5000 AS DECIMAL(18,8)), 2) AS DOUBLE) END AS price_usd,
         coalesce(n, 0) * 7 AS achievements, coalesce(pos, 0) AS positive_reviews,
         coalesce(neg, 0) AS negative_reviews, coalesce(q, 0) * 10 AS average_playtime_forever,
         coalesce(q, 0) * 8 AS median_playtime_forever, coalesce(n, 0) AS peak_ccu,
         o_orderpriority || '|' || o_orderstatus AS genres_and_tags
  FROM orders LEFT JOIN l ON k = o_orderkey),
bridge0 AS (
  SELECT l_orderkey AS appid, tag_name, CAST(sum(l_quantity) AS BIGINT) AS votes
  FROM (SELECT l_orderkey, l_quantity, p_brand AS tag_name FROM lineitem JOIN part ON p_partkey = l_partkey
        UNION ALL
        SELECT l_orderkey, l_quantity, p_type FROM lineitem JOIN part ON p_partkey = l_partkey)
  GROUP BY ALL),
tags0 AS (
  SELECT row_number() OVER (ORDER BY tag_name) AS tag_id, tag_name, game_count
  FROM (SELECT tag_name, count(DISTINCT appid) AS game_count FROM bridge0 GROUP BY tag_name)),
gt0 AS (SELECT appid, tag_id, votes FROM bridge0 JOIN tags0 USING (tag_name))"""

CLEANED = LOADED + """,
dated AS (
  SELECT *, CASE WHEN regexp_full_match(release_date, '\\w{3} \\d+, \\d{4}')
                 THEN CAST(try_strptime(release_date, '%b %d, %Y') AS DATE)
                 WHEN regexp_full_match(release_date, '\\d{4}-\\d{2}-\\d{2}')
                 THEN CAST(try_strptime(release_date, '%Y-%m-%d') AS DATE) END AS release_date_parsed
  FROM games0),
games1 AS (
  SELECT * REPLACE (CASE WHEN price_usd < 0 OR price_usd > 999 THEN NULL ELSE price_usd END AS price_usd)
  FROM dated
  WHERE NOT (average_playtime_forever = 0 AND median_playtime_forever = 0
             AND positive_reviews = 0 AND negative_reviews = 0)),
gt1 AS (SELECT * FROM gt0 WHERE appid IN (SELECT appid FROM games1))"""


def _candidates(games: str, bridge: str) -> str:
    return f"""
  SELECT DISTINCT g.appid FROM {games} g JOIN {bridge} b USING (appid) JOIN tags0 t USING (tag_id)
  WHERE t.tag_name IN ('PROMO', 'ECONOMY') AND b.votes >= 5
    AND NOT EXISTS (
      SELECT 1 FROM {bridge} b2 JOIN tags0 t2 USING (tag_id)
      WHERE b2.appid = g.appid
        AND t2.tag_name IN (SELECT 'Brand#' || CAST(i AS VARCHAR) FROM range(1, 13) r(i)))"""


READY = CLEANED + f""",
cand AS ({_candidates('games1', 'gt1')}),
games2 AS (SELECT * FROM games1 WHERE appid NOT IN (SELECT appid FROM cand)),
gt2 AS (SELECT * FROM gt1 WHERE appid NOT IN (SELECT appid FROM cand)),
tags2 AS (
  SELECT tag_id, tag_name, count(DISTINCT appid) AS game_count
  FROM tags0 JOIN gt2 USING (tag_id) GROUP BY tag_id, tag_name),
j AS (
  SELECT g.*, tag_name, t.game_count AS tag_total,
         CASE WHEN price_usd = 0 THEN 'Free to Play' ELSE 'Paid' END AS model
  FROM games2 g JOIN gt2 USING (appid) JOIN tags2 t USING (tag_id))"""


def r(expr: str, digits: int) -> str:
    """Round a double half away from zero."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def on(ctes: str, query: str) -> str:
    return f"WITH {ctes.strip()}\n{query.strip()}"


def once(ctes: str) -> str:
    """Each table expression computed a single time."""
    return ctes.replace(" AS (\n", " AS MATERIALIZED (\n").replace("gt0 AS (", "gt0 AS MATERIALIZED (")


def digest(*columns: str) -> str:
    """Sum over the rows of the first 32 bits of a hash of all columns, in the order of their names."""
    text = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + ")"
    return f"CAST(sum(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)) AS BIGINT) AS digest"


GAME_COLUMNS = [
    "appid", "name", "release_date", "price_usd", "achievements", "positive_reviews", "negative_reviews",
    "average_playtime_forever", "median_playtime_forever", "peak_ccu", "release_date_parsed",
]

AVG_HRS = r("sum(average_playtime_forever) / (count(*) * 60)", 1) + " AS avg_playtime_hrs"
MEDIAN_HRS = r("median(average_playtime_forever) / 60", 1) + " AS median_playtime_hrs"
APPROVAL = (
    r("avg(positive_reviews * 100.0::DOUBLE / nullif(positive_reviews + negative_reviews, 0))", 1)
    + " AS avg_approval_pct"
)
AVG_ACHIEVEMENTS = r("sum(achievements) / count(*)", 0) + " AS avg_achievements"
CORR = (
    "CASE WHEN isnan(corr(average_playtime_forever, achievements)) THEN NULL ELSE "
    + r("corr(average_playtime_forever, achievements)", 3)
    + " END"
)


def band(gap: str) -> str:
    return f"""CASE WHEN avg(achievements) = 0 THEN 'None' WHEN avg(achievements) < 15 THEN 'Low{gap}(1–14)'
  WHEN avg(achievements) < 50 THEN 'Mid{gap}(15–49)' WHEN avg(achievements) < 100 THEN 'High (50–99)'
  ELSE 'Very High (100+)' END AS achievement_band"""


PLAYED_BY_TAG = """FROM j WHERE average_playtime_forever > 0
GROUP BY tag_name HAVING count(DISTINCT appid) >= 20"""
GAMES_PER_GROUP = "count(DISTINCT appid) AS game_count"

YEARLY = f"""yearly AS (
  SELECT CAST(year(release_date_parsed) AS INTEGER) AS release_year, tag_name, tag_total,
         count(DISTINCT appid) AS games_released
  FROM j WHERE release_date_parsed >= DATE '2000-01-01' AND release_date_parsed < {AS_OF}
  GROUP BY ALL)"""
SO_FAR = "CAST(sum(games_released) OVER (PARTITION BY tag_name ORDER BY release_year) AS BIGINT) AS cumulative_games"


def top(k: int) -> str:
    return f"tag_name IN (SELECT tag_name FROM tags2 ORDER BY game_count DESC, tag_name LIMIT {k})"


def brackets(dash: str) -> str:
    return f"""
SELECT CASE sort_order WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Free' WHEN 2 THEN '$0.01{dash}$4.99'
         WHEN 3 THEN '$5{dash}$9.99' WHEN 4 THEN '$10{dash}$19.99' WHEN 5 THEN '$20{dash}$29.99'
         WHEN 6 THEN '$30{dash}$39.99' WHEN 7 THEN '$40{dash}$59.99' ELSE '$60+' END AS price_bracket,
       CAST(sort_order AS INTEGER) AS sort_order, count(*) AS game_count, {AVG_HRS}, {MEDIAN_HRS},
       {r('sum(positive_reviews + negative_reviews) / count(*)', 0)} AS avg_review_count
FROM (SELECT *, CASE WHEN price_usd IS NULL THEN 0 WHEN price_usd = 0 THEN 1 WHEN price_usd < 5 THEN 2
                     WHEN price_usd < 10 THEN 3 WHEN price_usd < 20 THEN 4 WHEN price_usd < 30 THEN 5
                     WHEN price_usd < 40 THEN 6 WHEN price_usd < 60 THEN 7 ELSE 8 END AS sort_order
      FROM games2 WHERE average_playtime_forever > 0)
GROUP BY sort_order"""


def wilson(p: str, n: str) -> str:
    z2 = "(1.645::DOUBLE * 1.645::DOUBLE)"
    return r(
        f"""({p} / {n} + {z2} / (2.0::DOUBLE * {n}) - 1.645::DOUBLE * sqrt(greatest(
  {p} / {n} * (1 - {p} / {n}) / {n} + {z2} / (4.0::DOUBLE * {n} * {n}), 0)))
  / (1 + {z2} / {n}) * 100""", 2)


REVIEWS = f"""
SELECT tag_name, game_count, total_reviews, avg_approval_pct,
       {r('total_positive * 100.0::DOUBLE / total_reviews', 1)} AS pooled_approval_pct,
       {wilson('total_positive::DOUBLE', 'total_reviews::DOUBLE')} AS wilson_score
FROM (SELECT tag_name, {GAMES_PER_GROUP}, CAST(sum(positive_reviews) AS BIGINT) AS total_positive,
             CAST(sum(positive_reviews + negative_reviews) AS BIGINT) AS total_reviews, {APPROVAL}
      FROM j WHERE positive_reviews + negative_reviews >= 10
      GROUP BY tag_name HAVING count(DISTINCT appid) >= 20 AND sum(positive_reviews + negative_reviews) >= 500)"""

MODELS_BY_TAG = "FROM j WHERE average_playtime_forever > 0 AND price_usd IS NOT NULL"

V_PLAYTIME_BY_TAG = on(READY, f"""
SELECT tag_name, {GAMES_PER_GROUP}, {AVG_HRS}, {MEDIAN_HRS}, {AVG_ACHIEVEMENTS},
       {CORR} AS playtime_achievements_corr, {band(' ')} {PLAYED_BY_TAG}""")

CAND0 = f"cand0 AS ({_candidates('games0', 'gt0')})"
CAND1 = f"cand1 AS ({_candidates('games0', 'gt0')})"
INGESTED = f"""
SELECT g.appid, g.name, g.price_usd, g.achievements, g.average_playtime_forever,
       g.appid % 3 <> 1 AS windows, TRUE AS mac, g.appid % 2 <> 0 AS linux,
       CASE WHEN g.appid % 2 = 0 THEN 2 ELSE 0 END AS n_developers,
       coalesce(b.merged, 'Single|brand#1') AS merged,
       coalesce(b.n_tags, 0) AS n_tags, coalesce(b.votes, 0) AS votes
FROM (SELECT * REPLACE (CASE WHEN appid % 4 = 1 THEN 0 ELSE achievements END AS achievements) FROM games0) g
LEFT JOIN (
  SELECT appid, count(*) AS n_tags, CAST(sum(votes) AS BIGINT) AS votes,
         'Single|brand#1' || coalesce(
           string_agg('|' || tag_name, '' ORDER BY tag_name) FILTER (WHERE tag_name <> 'Brand#1'), '') AS merged
  FROM bridge0 GROUP BY appid) b USING (appid)
WHERE NOT regexp_matches(g.name, '(?i)\\btest\\b')
  AND NOT (g.peak_ccu = 0 AND g.positive_reviews = 0 AND g.negative_reviews = 0)"""

# The number in an event's properties, and texts made from it.
PROPS = """
e AS (SELECT event_id, props, regexp_extract(props, '\\d+') AS k FROM events),
t AS (
  SELECT event_id, props, k, CAST(k AS INTEGER) AS n,
         CASE CAST(k AS INTEGER) % 5 WHEN 0 THEN k || '.7' WHEN 1 THEN ' -' || k || '.7 '
              WHEN 2 THEN k || 'd' WHEN 3 THEN 'free' ELSE k END AS text
  FROM e)"""

# The bridge of the games that are left once those with a part of two brands are gone.
WITHOUT_PARTS = """,
removed AS (SELECT DISTINCT appid FROM gt0 JOIN tags0 USING (tag_id) WHERE tag_name IN ('Brand#11', 'Brand#21')),
remaining AS (
  SELECT gt0.* FROM gt0 JOIN games0 USING (appid)
  WHERE NOT EXISTS (SELECT 1 FROM removed r WHERE r.appid = gt0.appid))"""

SQL = {
    "playtime_by_tag_top30": on(READY, f"""
SELECT tag_name, {GAMES_PER_GROUP}, {AVG_HRS}, {MEDIAN_HRS} {PLAYED_BY_TAG}
ORDER BY avg_playtime_hrs DESC, tag_name LIMIT 30"""),
    "playtime_achievement_top30": on(READY, f"""
SELECT tag_name, {GAMES_PER_GROUP}, {AVG_HRS}, {AVG_ACHIEVEMENTS}, {band('  ')},
       {CORR} AS playtime_achievement_corr {PLAYED_BY_TAG}
ORDER BY avg_playtime_hrs DESC, tag_name LIMIT 30""").replace("'High  (", "'High ("),
    "v_playtime_by_tag": V_PLAYTIME_BY_TAG,
    "v_playtime_by_tag_unchecked": V_PLAYTIME_BY_TAG,
    "v_playtime_by_tag_bucketed": V_PLAYTIME_BY_TAG,
    "releases_top15": on(READY + ",\n" + YEARLY, f"""
SELECT release_year, tag_name, games_released, {SO_FAR} FROM yearly WHERE {top(15)}
ORDER BY tag_name, release_year"""),
    "v_releases_by_year_tag": on(READY + ",\n" + YEARLY, f"""
SELECT release_year, tag_name, tag_total AS tag_total_game_count, games_released, {SO_FAR} FROM yearly"""),
    "price_brackets": on(READY, brackets(" – ") + " ORDER BY sort_order"),
    "v_playtime_by_price": on(READY, brackets("–")),
    "f2p_summary": on(READY, f"""
SELECT CASE WHEN price_usd = 0 THEN 'Free to Play' ELSE 'Paid' END AS model, count(*) AS game_count,
       {r('avg(price_usd)', 2)} AS avg_price_usd, {AVG_HRS}, {MEDIAN_HRS},
       {r('avg(average_playtime_forever) / nullif(least(avg(price_usd), 999), 0) / 60', 1)} AS playtime_hrs_per_dollar,
       {r('sum(achievements) / count(*)', 1)} AS avg_achievements, {APPROVAL}
FROM games2 WHERE average_playtime_forever > 0 AND price_usd IS NOT NULL GROUP BY 1"""),
    "f2p_top20": on(READY, f"""
SELECT tag_name, model, {GAMES_PER_GROUP}, {AVG_HRS}, {MEDIAN_HRS} {MODELS_BY_TAG} AND {top(20)}
GROUP BY tag_name, model HAVING count(DISTINCT appid) >= 10 ORDER BY tag_name, model"""),
    "v_f2p_vs_paid": on(READY, f"""
SELECT tag_name, tag_total AS tag_total_game_count, model, {GAMES_PER_GROUP}, {AVG_HRS}, {MEDIAN_HRS}, {APPROVAL}
{MODELS_BY_TAG} GROUP BY tag_name, tag_total, model HAVING count(DISTINCT appid) >= 10"""),
    "review_scores_top30": on(READY, REVIEWS + " ORDER BY wilson_score DESC, tag_name LIMIT 30"),
    "v_review_scores": on(READY, REVIEWS),
    "label_quality_by_source": f"""
SELECT source, n AS n_labels, {r('g * 100.0::DOUBLE / n', 1)} AS good_pct,
       {wilson('g::DOUBLE', 'n::DOUBLE')} AS wilson_score
FROM (SELECT source, CAST(sum(quality) AS BIGINT) AS g, count(*) AS n
      FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL GROUP BY source)""",
    "audit_summary": on(LOADED, """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE name IS NULL) AS null_names,
       count(*) FILTER (WHERE price_usd IS NULL) AS null_prices,
       count(*) FILTER (WHERE peak_ccu = 0) AS zero_peak_ccu,
       count(*) FILTER (WHERE average_playtime_forever = 0) AS zero_playtime,
       count(*) FILTER (WHERE positive_reviews = 0 AND negative_reviews = 0) AS no_reviews FROM games0"""),
    "audit_price_range": on(LOADED, """
SELECT count(*) FILTER (WHERE price_usd < 0) AS negative_prices,
       count(*) FILTER (WHERE price_usd > 999) AS prices_above_999 FROM games0"""),
    "audit_date_values": on(LOADED, """
SELECT release_date, count(*) AS occurrences FROM games0 WHERE release_date IS NOT NULL
GROUP BY release_date ORDER BY occurrences DESC, release_date LIMIT 40"""),
    "audit_unparsed_dates": on(CLEANED, """
SELECT release_date, count(*) AS occurrences FROM dated
WHERE release_date IS NOT NULL AND release_date_parsed IS NULL
GROUP BY release_date ORDER BY occurrences DESC, release_date LIMIT 40"""),
    "date_rejects": on(CLEANED, """
SELECT release_date, count(*) AS occurrences FROM dated
WHERE release_date_parsed IS NULL AND regexp_full_match(release_date, '\\w{3} \\d+, \\d{4}|\\d{4}-\\d{2}-\\d{2}')
GROUP BY release_date"""),
    "zero_engagement_count": on(LOADED, """
SELECT count(*) AS zero_engagement_rows_to_delete FROM games0
WHERE average_playtime_forever = 0 AND median_playtime_forever = 0 AND positive_reviews = 0 AND negative_reviews = 0"""),
    "zero_engagement_sample": on(LOADED, """
SELECT appid, name, release_date, price_usd FROM games0
WHERE average_playtime_forever = 0 AND median_playtime_forever = 0 AND positive_reviews = 0 AND negative_reviews = 0
ORDER BY appid LIMIT 20"""),
    "non_game_candidates": on(LOADED, _candidates("games0", "gt0")),
    "non_game_count": on(LOADED, f"SELECT count(*) AS non_game_rows_to_remove FROM ({_candidates('games0', 'gt0')})"),
    "non_game_guard": on(LOADED, f"""
SELECT count(*) AS n_candidates, count(*) > 1000 AS stopped FROM ({_candidates('games0', 'gt0')})"""),
    "cleaned_tags": on(CLEANED, """
SELECT tag_id, tag_name, count(DISTINCT appid) AS game_count FROM gt0 JOIN tags0 USING (tag_id)
WHERE EXISTS (SELECT 1 FROM games1 g WHERE g.appid = gt0.appid) GROUP BY tag_id, tag_name"""),
    "non_game_review": on(LOADED + ",\n" + CAND0, """
SELECT appid, name, genres_and_tags, tag_name AS non_game_tag, votes AS non_game_tag_votes
FROM cand0 JOIN games0 USING (appid) JOIN gt0 USING (appid) JOIN tags0 USING (tag_id)
ORDER BY votes DESC, name, appid, tag_name"""),
    "null_prices": on(LOADED, """
SELECT appid, CASE WHEN price_usd BETWEEN 0 AND 999 THEN price_usd END AS price_usd FROM games0"""),
    "parse_dates": on(CLEANED, "SELECT appid, release_date, release_date_parsed FROM dated"),
    "clean_games": on(CLEANED, """
SELECT appid, name, price_usd, release_date_parsed, average_playtime_forever FROM games1"""),
    "removed_games": on(CLEANED + ",\n" + CAND1, """
SELECT appid, name FROM games1 WHERE appid NOT IN (SELECT appid FROM cand1)"""),
    # Each step computed once, and joins on different keys instead of subqueries for each row.
    "pruned_bridge": on(once(CLEANED) + """,
gone AS MATERIALIZED (
  SELECT appid FROM gt0 JOIN tags0 USING (tag_id) GROUP BY appid
  HAVING bool_or(tag_name IN ('PROMO', 'ECONOMY') AND votes >= 5)
     AND NOT bool_or(tag_name IN (SELECT 'Brand#' || CAST(i AS VARCHAR) FROM range(1, 13) r(i)))),
left_over AS MATERIALIZED (SELECT appid FROM games1 EXCEPT SELECT appid FROM gone)""", """
SELECT appid, tag_id, votes FROM gt0 JOIN left_over USING (appid)"""),
    "pruned_tags": on(once(LOADED) + """,
removed AS MATERIALIZED (
  SELECT DISTINCT appid FROM gt0 JOIN tags0 USING (tag_id) WHERE tag_name IN ('Brand#11', 'Brand#21')),
kept AS MATERIALIZED (SELECT appid FROM games0 EXCEPT SELECT appid FROM removed),
used AS MATERIALIZED (SELECT DISTINCT tag_id FROM gt0 JOIN kept USING (appid))""", """
SELECT tag_id, tag_name FROM tags0 JOIN used USING (tag_id)"""),
    "recounted_tags": on(LOADED + WITHOUT_PARTS, """
SELECT tag_id, tag_name, coalesce(n, 0) AS game_count
FROM tags0 LEFT JOIN (SELECT tag_id, count(DISTINCT appid) AS n FROM remaining GROUP BY tag_id) USING (tag_id)"""),
    "ready_tags": on(READY, "SELECT tag_id, tag_name, game_count FROM tags2"),
    "pk_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "fk_violations": on(READY, """
SELECT appid, count(*) AS n_rows FROM gt0 WHERE appid NOT IN (SELECT appid FROM games2) GROUP BY appid"""),
    "orders_without_lines": """
SELECT o_orderkey, count(*) AS n_rows FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY o_orderkey""",
    "cascade_delete": on(LOADED, """
SELECT appid, tag_id, votes FROM gt0 JOIN tags0 USING (tag_id) WHERE tag_name LIKE 'Brand#%'"""),
    "layout_active_games": on(READY, """
SELECT appid, release_date_parsed, price_usd FROM games2
WHERE average_playtime_forever > 0 AND positive_reviews + negative_reviews > 0
  AND release_date_parsed BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"""),
    "drop_junk": on(LOADED, """
SELECT appid, name FROM games0
WHERE name IS NOT NULL AND NOT regexp_matches(name, '(?i)\\btest\\b')
  AND NOT (peak_ccu = 0 AND positive_reviews = 0 AND negative_reviews = 0)"""),
    # RE2 has no Unicode word boundary, so the neighbours of the word are spelled out.
    "drop_test_documents": """
SELECT source, count(*) AS kept FROM documents
WHERE NOT regexp_matches(text, '(?i)(^|[^\\pL\\pM\\p{Nd}\\p{Pc}])test($|[^\\pL\\pM\\p{Nd}\\p{Pc}])')
GROUP BY source""",
    "bridge_build": on(LOADED, "SELECT appid, tag_id, votes FROM gt0"),
    "tag_dim": on(LOADED, "SELECT tag_id, tag_name, game_count FROM tags0"),
    "merge_dedup": """
SELECT p_partkey, list_aggregate(list_transform(list_filter(
         list_zip(items, range(1, len(items) + 1)),
         lambda z: list_position(list_transform(items, lambda y: lower(y)), lower(z[1])) = z[2]),
         lambda z: z[1]), 'string_agg', '|') AS merged
FROM (SELECT p_partkey, string_split(p_name, ' ') || list_transform(string_split(p_name, ' '), lambda w: upper(w))
             || [p_type, p_brand] AS items FROM part)""",
    "json_has_key": """
SELECT event_type, count(*) FILTER (WHERE json_exists(props, '$.k')) AS with_k,
       count(*) FILTER (WHERE json_exists(props, '$.other')) AS with_other
FROM events GROUP BY event_type""",
    "json_contains_object": "SELECT event_id FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) = 42",
    "json_contains_array": """
SELECT p_partkey, p_name FROM part
WHERE p_type = 'PROMO' AND list_contains(string_split(p_name, ' '), 'red')""",
    "tag_votes_over": on(LOADED, """
SELECT appid, name FROM games0
WHERE appid IN (SELECT appid FROM gt0 JOIN tags0 USING (tag_id) WHERE tag_name = 'PROMO' AND votes > 100)"""),
    "coerce_types": on(PROPS, """
SELECT event_id, CAST(trunc(v) AS BIGINT) AS key, v AS as_double, CAST(trunc(v) AS BIGINT) AS as_long,
       CASE WHEN n % 2 = 0 THEN k || ',x' ELSE '' END AS as_list,
       CASE WHEN n % 2 = 0 THEN 0 ELSE len(json_keys(props)) END::INTEGER AS map_size
FROM (SELECT *, TRY_CAST(trim(text) AS DOUBLE) AS v FROM t) WHERE v IS NOT NULL"""),
    "ingest_ndjson": on(LOADED, INGESTED),
    "ingest_object": on(LOADED, INGESTED),
    "publish_roundtrip": on(READY, f"""
SELECT 'games' AS table_name, count(*) AS n_rows, CAST(sum(appid) AS BIGINT) AS key_sum, {digest(
    "achievements", "appid", "average_playtime_forever", "replace(genres_and_tags, '|', '/')", "median_playtime_forever", "name",
    "negative_reviews", "peak_ccu", "positive_reviews", "CAST(round(price_usd * 100) AS BIGINT)", "release_date", "release_date_parsed")}
FROM games2
UNION ALL SELECT 'tags', count(*), CAST(sum(tag_id) AS BIGINT), {digest("game_count", "tag_id", "tag_name")} FROM tags2
UNION ALL SELECT 'game_tags', count(*), CAST(sum(appid) AS BIGINT), {digest("appid", "tag_id", "votes")} FROM gt2"""),
    "layout_by_tag": on(READY, "SELECT appid, votes FROM gt2 JOIN tags2 USING (tag_id) WHERE tag_name = 'PROMO'"),
    "layout_by_date": on(READY, """
SELECT appid, release_date_parsed FROM games2 WHERE release_date_parsed BETWEEN DATE '1997-03-01' AND DATE '1997-04-30'"""),
    "layout_by_price": on(READY, "SELECT appid, price_usd FROM games2 WHERE price_usd BETWEEN 20 AND 25"),
    "layout_by_playtime": on(READY, """
SELECT appid, average_playtime_forever FROM games2 WHERE average_playtime_forever > 2000"""),
    "layout_by_genres": on(READY, "SELECT appid, price_usd FROM games2 WHERE genres_and_tags = '1-URGENT|F'"),
    "column_statistics": on(READY, "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
        f"count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM {source}"
        for table, source, columns in (
            ("games", "games2", GAME_COLUMNS), ("tags", "tags2", ["tag_id", "tag_name", "game_count"]),
            ("game_tags", "gt2", ["appid", "tag_id", "votes"]),
        ) for c in columns
    )),
    "bridge_checked": on(LOADED, "SELECT appid, tag_id, votes FROM gt0"),
}
SQL["view_read_back"] = SQL["v_review_scores"]
SQL["f2p_summary_ordered"] = SQL["f2p_summary"]


def counts(column: str, queries: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS {column}, count(*) AS n_rows FROM ({sql})" for name, sql in queries.items()
    )


SQL["kpi_rows"] = counts("view_name", {
    "v_kpi_playtime_by_tag": SQL["v_playtime_by_tag"], "v_kpi_releases_by_year_tag": SQL["v_releases_by_year_tag"],
    "v_kpi_playtime_by_price": SQL["v_playtime_by_price"], "v_kpi_f2p_vs_paid": SQL["v_f2p_vs_paid"],
    "v_kpi_f2p_vs_paid_summary": SQL["f2p_summary"], "v_kpi_review_scores_by_tag": SQL["v_review_scores"],
})
SQL["audit_rows"] = counts("part", {
    name: SQL[name] for name in (
        "audit_summary", "audit_price_range", "audit_date_values", "zero_engagement_count", "zero_engagement_sample",
        "non_game_candidates", "non_game_count", "non_game_review",
    )
})
