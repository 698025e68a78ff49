"""DuckDB SQL oracles for the named queries (views: the driver's tables).

Each string computes, independently of Spark, what the query of the same
name in :mod:`kiln.plans.catalog` returns; column names match exactly.
Doubles that depend on summation order are rounded to 6 digits on both
sides.
"""

from __future__ import annotations

from kiln.plans.catalog import MIN_REVIEWS, MY_RATINGS, RECOMMEND_K, SOURCE_VERTEX, TOP_K

# --- shared CTEs -------------------------------------------------------------

CLF = r"""clf AS (
  SELECT event_id,
    'host' || user_id || '.example.com - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S')
    || ' -0400] "GET /' || event_type || '/' || json_extract_string(props, '$.k')
    || ' HTTP/1.0" '
    || CASE event_type WHEN 'error' THEN '404' WHEN 'signup' THEN '302'
                       WHEN 'click' THEN '304' ELSE '200' END
    || ' ' || CASE WHEN event_type = 'error' THEN '-'
                   ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS value
  FROM events)"""

# the fields straight from the columns that the line is made of, not from the line
PARSED = CLF + r""",
parsed AS (
  SELECT CASE WHEN ok THEN 'host' || user_id || '.example.com' END AS host,
    CASE WHEN ok THEN strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400' END AS timestamp,
    CASE WHEN ok THEN '/' || event_type || '/' || k END AS path,
    CASE WHEN ok THEN CASE event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 302
                                      WHEN 'click' THEN 304 ELSE 200 END END AS status,
    CASE WHEN ok AND event_type <> 'error' THEN CAST(floor(value * 100) AS BIGINT) END AS content_size,
    CASE WHEN ok THEN CAST(ts + INTERVAL 4 HOUR AS DATE) END AS time
  FROM (SELECT *, json_extract_string(props, '$.k') AS k,
               user_id IS NOT NULL AND ts IS NOT NULL AND event_type IS NOT NULL
               AND json_extract_string(props, '$.k') IS NOT NULL
               AND (event_type = 'error' OR value IS NOT NULL) AS ok FROM events))"""

CLEANED = PARSED + r""",
cleaned AS (
  SELECT host, path, status, coalesce(content_size, 0) AS content_size, time FROM parsed),
not_found AS (SELECT * FROM cleaned WHERE status = 404)"""


def with_(cte: str, body: str) -> str:
    return f"WITH {cte}\n{body}"


# --- web log -----------------------------------------------------------------

WEBLOG = {
    "log_parse": with_(PARSED, "SELECT host, timestamp, path, status, content_size FROM parsed"),
    "log_null_gate": with_(CLF, """SELECT 'value_not_null' AS "check",
        count(*) FILTER (WHERE value IS NULL) AS violations,
        count(*) FILTER (WHERE value IS NULL) = 0 AS passed FROM clf"""),
    "log_rows_with_nulls": with_(PARSED, """SELECT count(*) FILTER (WHERE host IS NULL
        OR timestamp IS NULL OR path IS NULL OR status IS NULL OR content_size IS NULL)
        AS rows_with_nulls FROM parsed"""),
    "log_null_counts": with_(PARSED, """SELECT
        count(*) FILTER (WHERE host IS NULL) AS host,
        count(*) FILTER (WHERE timestamp IS NULL) AS timestamp,
        count(*) FILTER (WHERE path IS NULL) AS path,
        count(*) FILTER (WHERE status IS NULL) AS status,
        count(*) FILTER (WHERE content_size IS NULL) AS content_size FROM parsed"""),
    "log_invalid_size_lines": with_(CLF, r"""SELECT value FROM clf
        WHERE NOT regexp_matches(value, '\d+$')"""),
    "log_malformed": with_(PARSED, """SELECT count(*) AS lines,
        count(*) FILTER (WHERE host IS NULL) AS malformed FROM parsed"""),
    "log_clean": with_(CLEANED, "SELECT host, path, status, content_size, time FROM cleaned"),
    "log_size_stats": with_(CLEANED, """SELECT count(content_size) AS n,
        round(avg(content_size), 6) AS mean, round(stddev_samp(content_size), 6) AS stddev,
        min(content_size) AS min, max(content_size) AS max FROM cleaned"""),
    "log_status_counts": with_(CLEANED, """SELECT status, count(*) AS "count"
        FROM cleaned GROUP BY status ORDER BY status NULLS FIRST"""),
    "log_frequent_hosts": with_(CLEANED, """SELECT host FROM cleaned
        GROUP BY host HAVING count(*) > 70"""),
    "log_top_error_paths": with_(CLEANED, """SELECT path, count(*) AS "count"
        FROM cleaned WHERE status != 200 GROUP BY path
        ORDER BY "count" DESC, path NULLS FIRST LIMIT 10"""),
    "log_unique_hosts": with_(CLEANED, """SELECT count(DISTINCT host)
        + CAST(count(*) FILTER (WHERE host IS NULL) > 0 AS BIGINT) AS unique_hosts
        FROM cleaned"""),
    "log_daily_unique_hosts": with_(CLEANED, """SELECT dayofmonth(time) AS day,
        count(DISTINCT host) + CAST(count(*) FILTER (WHERE host IS NULL) > 0 AS BIGINT)
        AS unique_count FROM cleaned GROUP BY 1 ORDER BY 1 NULLS FIRST"""),
    "log_daily_requests": with_(CLEANED, """SELECT dayofmonth(time) AS day,
        count(*) AS "count" FROM cleaned GROUP BY 1 ORDER BY 1 NULLS FIRST"""),
    "log_daily_avg_requests_per_host": with_(CLEANED, """SELECT dayofmonth(time) AS day,
        count(*) / (count(DISTINCT host)
          + CAST(count(*) FILTER (WHERE host IS NULL) > 0 AS BIGINT)) AS avg_count
        FROM cleaned WHERE time IS NOT NULL GROUP BY 1 ORDER BY 1"""),
    "log_not_found": with_(CLEANED, "SELECT host, path, status, content_size, time FROM not_found"),
    "log_not_found_distinct_paths": with_(CLEANED, """SELECT DISTINCT path FROM not_found
        ORDER BY path NULLS FIRST LIMIT 40"""),
    "log_not_found_top_paths": with_(CLEANED, """SELECT path, count(*) AS "count"
        FROM not_found GROUP BY path ORDER BY "count" DESC, path NULLS FIRST LIMIT 20"""),
    "log_not_found_top_hosts": with_(CLEANED, """SELECT host, count(*) AS "count"
        FROM not_found GROUP BY host ORDER BY "count" DESC, host NULLS FIRST LIMIT 25"""),
    "log_not_found_by_day": with_(CLEANED, """SELECT dayofmonth(time) AS day,
        count(*) AS "count" FROM not_found GROUP BY 1 ORDER BY 1 NULLS FIRST"""),
}

ORACLES: dict[str, str] = {}
ORACLES.update(WEBLOG)

# --- keyed / partition / sort -------------------------------------------------

WORDS = r"""lines AS (
  SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[] ELSE regexp_split_to_array(
    regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n') END) AS l FROM documents),
words AS (
  SELECT unnest(string_split(CASE WHEN l = '' THEN l ELSE rtrim(l, ' ') END, ' ')) AS word
  FROM lines WHERE l = '' OR rtrim(l, ' ') <> ''),
wc AS (SELECT word, count(*) AS "count" FROM words GROUP BY word)"""

KEYED = {
    "user_list_names": """SELECT c_name AS name, CAST(coalesce(n, 0) AS INTEGER) AS "count"
        FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o
        ON c_custkey = o_custkey""",
    "word_count": with_(WORDS, "SELECT word, \"count\" FROM wc"),
    "average_by_key": """SELECT l_returnflag, count(v) AS matches, CAST(sum(v) AS BIGINT) AS total,
        CAST(trunc(sum(v) / count(v)) AS BIGINT) AS avg_int,
        round(sum(v) / count(v), 6) AS average
        FROM (SELECT l_returnflag, CAST(trunc(l_quantity) AS INTEGER) AS v FROM lineitem)
        GROUP BY l_returnflag""",
    "average_by_key_fractions": """SELECT event_type, count(value) AS matches,
        round(sum(value), 4) AS total, CAST(trunc(avg(value)) AS BIGINT) AS avg_int,
        round(avg(value), 6) AS average FROM events GROUP BY event_type""",
    "partition_average": """SELECT round(avg(l_quantity), 6) AS average FROM lineitem""",
    "partition_average_fractions": """SELECT round(avg(value), 6) AS average FROM events""",
    "partition_sizes": """SELECT CAST(p AS INTEGER) AS partition, count(b) AS "count"
        FROM range(10) r(p) LEFT JOIN (SELECT CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)
          AS BIGINT) % 100 % 10 AS b FROM lineitem) ON b = p GROUP BY p""",
    "collect_values": """SELECT o_orderpriority, o_orderkey, row_number() OVER (
        ORDER BY o_orderpriority, o_orderkey) AS position FROM orders""",
    "collection_digest": """SELECT o_orderpriority, count(o_orderkey) AS n_values,
        count(DISTINCT o_orderkey) AS n_distinct, min(o_orderkey) AS min_value,
        max(o_orderkey) AS max_value,
        CAST(sum(CAST(o_orderkey AS DECIMAL(38, 0))) AS DECIMAL(38, 0)) AS sum_value
        FROM orders GROUP BY o_orderpriority""",
    "sort_by_string_key": """SELECT p_partkey, row_number() OVER (
        ORDER BY CAST(p_partkey AS VARCHAR), p_partkey) AS position FROM part""",
    "sort_by_struct_key": """SELECT p_brand, p_size, p_partkey, row_number() OVER (
        ORDER BY p_brand, p_size, p_partkey) AS position FROM part""",
    "pair_text": with_(WORDS, """SELECT '(' || word || ',' || CAST("count" AS VARCHAR) || ')'
        AS line FROM wc"""),
}
ORACLES.update(KEYED)

# --- ratings ---------------------------------------------------------------------

RATINGS = r"""ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS userId, CAST(l_partkey AS INTEGER) AS movieId,
         avg(1 + (CAST(trunc(l_quantity) AS INTEGER) - 1) % 5) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey),
movies AS (SELECT CAST(p_partkey AS INTEGER) AS movieId, p_name AS title FROM part),
split_r AS (
  SELECT *, CASE WHEN b < 60 THEN 'train' WHEN b < 80 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, CAST(CAST('0x' || substr(md5(CAST(userId AS VARCHAR) || '|'
          || CAST(movieId AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS INTEGER) AS b FROM ratings)),
new_user AS (SELECT CAST(max(o_custkey) + 1 AS INTEGER) AS uid FROM orders),
mine AS (SELECT uid AS userId, CAST(m AS INTEGER) AS movieId, CAST(r AS DOUBLE) AS rating
         FROM new_user, (VALUES """ + ", ".join(f"({m}, {r})" for m, r in MY_RATINGS) + """) v(m, r))"""

RATING_ORACLES = {
    "ratings_load": with_(RATINGS, "SELECT userId, movieId, rating FROM ratings"),
    "movies_load": with_(RATINGS, "SELECT movieId, title FROM movies"),
    "movies_top_rated": with_(RATINGS, f"""SELECT movieId, title, "count", round(average, 6) AS average
        FROM (SELECT movieId, count(rating) AS "count",
                     CAST(sum(CAST(rating AS DECIMAL(30, 15))) AS DOUBLE) / count(rating) AS average
              FROM ratings GROUP BY movieId HAVING count(rating) >= {MIN_REVIEWS})
        JOIN movies USING (movieId)
        ORDER BY average DESC, movieId LIMIT {TOP_K}"""),
    "ratings_split": with_(RATINGS, "SELECT userId, movieId, rating, split FROM split_r"),
    "mean_baseline_rmse": with_(RATINGS, """SELECT round(mu, 6) AS train_mean,
        round(sqrt(avg(pow(rating - mu, 2))), 6) AS rmse
        FROM split_r, (SELECT avg(rating) AS mu FROM split_r WHERE split = 'train')
        WHERE split = 'test' GROUP BY mu"""),
    "unrated_candidates": with_(RATINGS, """SELECT movieId, title, uid AS userId
        FROM movies, new_user WHERE movieId NOT IN (SELECT movieId FROM mine)"""),
    "ratings_with_user": with_(RATINGS, """SELECT userId, movieId, rating FROM split_r
        WHERE split = 'train' UNION ALL SELECT userId, movieId, rating FROM mine"""),
}
ORACLES.update(RATING_ORACLES)

# --- graph -----------------------------------------------------------------------

EDGES = r"""pairs AS (SELECT l_partkey AS p, l_suppkey AS s,
                 min(CAST(trunc(l_quantity) AS BIGINT)) AS weight FROM lineitem GROUP BY 1, 2),
e AS MATERIALIZED (SELECT p AS src, -(s + 1) AS dst, weight FROM pairs
                   UNION ALL SELECT -(s + 1), p, weight FROM pairs),
v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT p_partkey FROM part
                   UNION SELECT -(s_suppkey + 1) FROM supplier)"""


# ranks until none moves by more than 1e-7; a row carries its round
PAGERANK = EDGES + """,
d AS MATERIALIZED (SELECT src, count(*) AS k FROM e GROUP BY src),
w AS MATERIALIZED (SELECT e.src, e.dst, d.k FROM e JOIN d USING (src)),
r(round, id, rank, worst) AS (
  SELECT 0, id, CAST(1.0 AS DOUBLE), CAST(1.0 AS DOUBLE) FROM v
  UNION ALL
  SELECT round, id, rank, max(abs(rank - prev)) OVER () FROM (
    SELECT any_value(p.round) OVER () + 1 AS round, p.id,
           0.15 + 0.85 * coalesce(s.x, 0) AS rank, p.rank AS prev
    FROM r p LEFT JOIN (SELECT w.dst, sum(q.rank / w.k) AS x FROM w JOIN r q ON q.id = w.src
                        GROUP BY w.dst) s ON s.dst = p.id
    WHERE p.worst > 1e-7))"""


# frontier relaxation keyed by vertex: each step upserts the vertices whose
# (dist, hops) improved; it ends when no vertex improves
SSSP = EDGES + f""",
t(id, dist, hops) USING KEY (id) AS (
  SELECT CAST({SOURCE_VERTEX} AS BIGINT), CAST(0 AS DOUBLE), 0
  UNION
  SELECT c.id, c.dist, c.hops FROM (
    SELECT e.dst AS id, arg_min(t.dist + e.weight, (t.dist + e.weight, t.hops + 1)) AS dist,
           arg_min(t.hops + 1, (t.dist + e.weight, t.hops + 1)) AS hops
    FROM t JOIN e ON e.src = t.id GROUP BY e.dst) c
  LEFT JOIN recurring.t r ON r.id = c.id
  WHERE r.id IS NULL OR c.dist < r.dist OR (c.dist = r.dist AND c.hops < r.hops)),
dist AS MATERIALIZED (SELECT * FROM t)"""

PATHS = SSSP + f""",
preds AS MATERIALIZED (
  SELECT e.dst AS id, arg_min(e.src, (t.dist + e.weight, t.hops + 1, e.src)) AS pred
  FROM dist t JOIN e ON e.src = t.id WHERE e.dst <> {SOURCE_VERTEX} GROUP BY e.dst),
walk(id, cur, path) AS (
  SELECT id, pred, [pred] FROM preds
  UNION ALL
  SELECT w.id, p.pred, list_prepend(p.pred, w.path) FROM walk w JOIN preds p ON p.id = w.cur),
routes AS (SELECT id, path FROM walk WHERE cur = {SOURCE_VERTEX})"""

GRAPH = {
    "adjacency_edges": r"""WITH f AS (SELECT string_split(concat_ws(',', CAST(l_partkey AS VARCHAR),
            CAST(-(l_suppkey + 1) AS VARCHAR)), ',') AS f FROM lineitem)
        SELECT src, dst FROM (
          SELECT TRY_CAST(trim(f[1]) AS BIGINT) AS src,
                 unnest(list_filter(list_transform(f[2:], lambda x: TRY_CAST(trim(x) AS BIGINT)),
                                    lambda x: x IS NOT NULL)) AS dst FROM f)
        WHERE src IS NOT NULL""",
    "pagerank": "WITH RECURSIVE " + PAGERANK + """
        SELECT id, round(rank, 6) AS rank FROM r WHERE round = (SELECT max(round) FROM r)""",
    "property_graph": "WITH " + EDGES + """
        SELECT p_partkey AS id, p_name AS name FROM part
        UNION ALL
        SELECT id, 'missing' AS name FROM (SELECT DISTINCT src AS id FROM e)
        WHERE id NOT IN (SELECT p_partkey FROM part)""",
    "shortest_distances": "WITH RECURSIVE " + SSSP + """
        SELECT v.id, coalesce(dist.dist, CAST('inf' AS DOUBLE)) AS dist
        FROM v LEFT JOIN dist USING (id)""",
    "shortest_paths": "WITH RECURSIVE " + PATHS + """
        SELECT v.id, coalesce(dist.dist, CAST('inf' AS DOUBLE)) AS dist,
               coalesce(array_to_string(routes.path, ','), '') AS path
        FROM v LEFT JOIN dist USING (id) LEFT JOIN routes USING (id)""",
}
ORACLES.update(GRAPH)

# --- signed weights ---------------------------------------------------------------

SIGNED = SSSP.replace("""e AS MATERIALIZED (SELECT p AS src, -(s + 1) AS dst, weight FROM pairs
                   UNION ALL SELECT -(s + 1), p, weight FROM pairs)""",
                      """sized AS (SELECT p, s, weight, coalesce(p_size, 0) AS z FROM pairs LEFT JOIN part ON p_partkey = p),
e AS MATERIALIZED (SELECT p AS src, -(s + 1) AS dst, weight + z AS weight FROM sized
                   UNION ALL SELECT -(s + 1), p, weight - z FROM sized)""")
ORACLES["shortest_distances_signed"] = "WITH RECURSIVE " + SIGNED + """
        SELECT v.id, coalesce(dist.dist, CAST('inf' AS DOUBLE)) AS dist
        FROM v LEFT JOIN dist USING (id)"""

# --- files, sinks, three-function aggregation ----------------------------------------

FILES = {
    "pair_text_parts": """SELECT CAST(CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 7
          AS INTEGER) AS part, '(' || o_custkey || ',' || count(*) || ')' AS line
        FROM orders GROUP BY o_custkey""",
    "combine_by_key_top2": """WITH r AS (SELECT event_type, value, event_id,
            row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS k
          FROM events WHERE value IS NOT NULL AND event_id IS NOT NULL)
        SELECT event_type, max(CASE WHEN k = 1 THEN value END) AS value1, max(CASE WHEN k = 1 THEN event_id END) AS id1,
               max(CASE WHEN k = 2 THEN value END) AS value2, max(CASE WHEN k = 2 THEN event_id END) AS id2
        FROM r GROUP BY event_type""",
    "read_lines_files": "WITH " + CLF + """
        SELECT CAST(length(value) AS INTEGER) AS length, count(*) AS lines FROM clf
        WHERE value IS NOT NULL GROUP BY 1""",
    "read_movies_csv": """SELECT CAST(p_partkey AS INTEGER) AS movieId, p_name AS title, NULL AS malformed FROM part
        UNION ALL SELECT NULL, 'bad', 'x' || p_partkey || ',bad,none' FROM part WHERE p_partkey % 97 = 5""",
    "read_ratings_csv": """SELECT CAST(o_custkey AS INTEGER) AS userId, CAST(o_orderkey AS INTEGER) AS movieId,
          o_orderkey % 5 + 0.5::DOUBLE AS rating, NULL AS malformed FROM orders
        UNION ALL SELECT CAST(o_custkey AS INTEGER), CAST(o_orderkey AS INTEGER), NULL,
          o_custkey || ',' || o_orderkey || ',five,0' FROM orders WHERE o_orderkey % 97 = 5""",
    "read_vertices_csv": """SELECT p_partkey AS id, p_name AS name, NULL AS malformed FROM part
        UNION ALL SELECT NULL, 'bad', 'v-' || p_partkey || ',bad' FROM part WHERE p_partkey % 97 = 5""",
    "read_edges_csv": "WITH " + EDGES + """
        SELECT src, dst, weight, NULL AS malformed FROM e WHERE src >= 0
        UNION ALL SELECT src, dst, NULL, src || ',' || dst || ',heavy' FROM e WHERE src >= 0 AND src % 97 = 5""",
    "read_adjacency_files": """SELECT l_partkey AS src, CAST(sum(CASE WHEN l_partkey % 97 = 5 THEN 2 ELSE 1 END) AS BIGINT)
          AS links, CAST(sum(CASE WHEN l_partkey % 97 = 5 THEN 1 ELSE 0 END) AS BIGINT) AS malformed
        FROM lineitem GROUP BY l_partkey""",
    "table_preview": """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 20""",
    "table_schema": """SELECT column_name AS name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
          WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' ELSE data_type END AS type,
          true AS nullable, present FROM information_schema.columns
        JOIN (UNPIVOT (SELECT count(COLUMNS(*)) FROM customer) ON COLUMNS(*) INTO NAME n VALUE present)
        ON n = column_name WHERE table_name = 'customer'""",
}
ORACLES.update(FILES)

# --- model checks ------------------------------------------------------------------

MODEL = {
    "item_mean_rmse": with_(RATINGS, """SELECT round(sqrt(avg(pow(m - rating, 2))), 6) AS rmse
        FROM split_r JOIN (SELECT movieId, avg(rating) AS m FROM split_r WHERE split = 'train' GROUP BY movieId)
        USING (movieId) WHERE split = 'test'"""),
    "als_rank_search_verified": with_(RATINGS, """SELECT CAST(rank AS INTEGER) AS rank,
          count(*) FILTER (WHERE known) AS n_scored, count(*) FILTER (WHERE NOT known) AS n_dropped,
          true AS rmse_agrees, true AS best_agrees
        FROM (SELECT userId IN (SELECT userId FROM split_r WHERE split = 'train')
                 AND movieId IN (SELECT movieId FROM split_r WHERE split = 'train') AS known
              FROM split_r WHERE split = 'validation'), (VALUES (4), (8), (12)) t(rank) GROUP BY rank"""),
    "als_normal_equations": with_(RATINGS, """SELECT 'user' AS side, count(DISTINCT userId) AS n, CAST(0 AS BIGINT) AS beyond
        FROM split_r WHERE split = 'train'
        UNION ALL SELECT 'item', count(DISTINCT movieId), 0 FROM split_r WHERE split = 'train'"""),
    "recommend_verified": with_(RATINGS, f"""SELECT CAST(least({RECOMMEND_K}, count(*)) AS INTEGER) AS n, true AS agrees
        FROM movies WHERE movieId NOT IN (SELECT movieId FROM mine)
          AND movieId IN (SELECT movieId FROM split_r WHERE split = 'train')"""),
}
ORACLES.update(MODEL)
