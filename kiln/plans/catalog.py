"""Named queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads the test tables through :mod:`kiln.plans.bindings` and runs
one library operator (or a short chain of them).  Parameters are the ones
stated in SURVEY/FIXTURES for the test tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions.buckets import md5_bucket
from kiln.operators import graph as gr
from kiln.operators import keyed as kd
from kiln.operators import ratings as rt
from kiln.operators import recommend as rc
from kiln.operators import weblog as wl
from kiln.plans import bindings as b
from kiln.sources.adjacency import edges_from_lines, parse_adjacency
from kiln.sources.readers import (RATING_SCHEMA, conform, read_edges, read_lines, read_movies, read_ratings,
                                  read_vertices)
from kiln.sources.sinks import pair_text, preview, read_parts, schema_rows, write_placed_pairs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return register


# --- web log -----------------------------------------------------------------

def _parsed(spark, d):
    return wl.parse_log(b.clf_lines(spark, d))


def _cleaned(spark, d):
    # UTC days, whatever the session zone (the log offsets are explicit)
    return wl.clean_log(_parsed(spark, d), utc=True)


def _not_found(spark, d):
    return wl.not_found(_cleaned(spark, d))


query("log_parse")(_parsed)
query("log_null_gate")(lambda s, d: wl.null_gate(b.clf_lines(s, d)))
query("log_rows_with_nulls")(lambda s, d: wl.count_rows_with_nulls(_parsed(s, d)))
query("log_null_counts")(lambda s, d: wl.null_counts(_parsed(s, d)))
query("log_invalid_size_lines")(
    lambda s, d: wl.invalid_size_lines(b.clf_lines(s, d)).select("value"))
query("log_malformed")(lambda s, d: wl.malformed_lines(b.clf_lines(s, d)))
query("log_clean")(_cleaned)


@query("log_size_stats")
def _size_stats(spark, d):
    st = wl.size_stats(_cleaned(spark, d))
    return st.select("n", F.round("mean", 6).alias("mean"),
                     F.round("stddev", 6).alias("stddev"), "min", "max")


query("log_status_counts")(lambda s, d: wl.status_counts(_cleaned(s, d)))
# every host has more than 10 lines in the test tables; 70 splits them
query("log_frequent_hosts")(lambda s, d: wl.frequent_hosts(_cleaned(s, d), 70))
query("log_top_error_paths")(lambda s, d: wl.top_error_paths(_cleaned(s, d), 10))
query("log_unique_hosts")(lambda s, d: wl.unique_hosts(_cleaned(s, d)))
query("log_daily_unique_hosts")(lambda s, d: wl.daily_unique_hosts(_cleaned(s, d)))
query("log_daily_requests")(lambda s, d: wl.daily_requests(_cleaned(s, d)))
query("log_daily_avg_requests_per_host")(
    lambda s, d: wl.daily_avg_requests_per_host(_cleaned(s, d)))
query("log_not_found")(_not_found)
query("log_not_found_distinct_paths")(lambda s, d: wl.distinct_paths(_not_found(s, d), 40))
query("log_not_found_top_paths")(lambda s, d: wl.top_paths(_not_found(s, d), 20))
query("log_not_found_top_hosts")(lambda s, d: wl.top_hosts(_not_found(s, d), 25))
query("log_not_found_by_day")(lambda s, d: wl.daily_requests(_not_found(s, d)))


# --- keyed / partition / sort -------------------------------------------------

USER_LIST_SCHEMA = T.StructType([T.StructField("name", T.StringType(), True),
                                 T.StructField("count", T.IntegerType(), True)])


@query("user_list_names")
def _user_list(spark, d):
    """The ``(name string, count int)`` user list, taken from the customers
    and their number of orders, conformed to the declared schema."""
    per_cust = (b.table(spark, d, "orders").groupBy("o_custkey")
                .agg(F.count(F.lit(1)).alias("n_orders")))
    cust = b.table(spark, d, "customer").select("c_custkey", "c_name")
    rows = (cust.join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
            .select(F.col("c_name").alias("name"),
                    F.coalesce("n_orders", F.lit(0)).alias("count")))
    return conform(rows, USER_LIST_SCHEMA)


def _word_count(spark, d):
    return kd.word_count(b.document_lines(spark, d))


query("word_count")(_word_count)


@query("average_by_key")
def _average_by_key(spark, d):
    li = b.table(spark, d, "lineitem").select(
        "l_returnflag", F.col("l_quantity").cast("int").alias("score"))
    r = kd.average_by_key(li, "l_returnflag", "score")
    return r.withColumn("average", F.round("average", 6))


@query("average_by_key_fractions")
def _average_fractions(spark, d):
    ev = b.table(spark, d, "events").select("event_type", "value")
    r = kd.average_by_key(ev, "event_type", "value")
    return r.select("event_type", "matches", F.round("total", 4).alias("total"), "avg_int",
                    F.round("average", 6).alias("average"))


@query("partition_average")
def _partition_average(spark, d):
    r = kd.partition_average(b.table(spark, d, "lineitem"), "l_quantity")
    return r.select(F.round("average", 6).alias("average"))


@query("partition_average_fractions")
def _partition_average_fractions(spark, d):
    r = kd.partition_average(b.table(spark, d, "events"), "value")
    return r.select(F.round("average", 6).alias("average"))


# rows placed by an md5 bucket, which SQL can reproduce
query("partition_sizes")(
    lambda s, d: kd.partition_sizes(b.table(s, d, "lineitem"), 10, by=["l_orderkey"],
                                    place=md5_bucket("l_orderkey")))
query("collect_values")(
    lambda s, d: kd.collect_values(b.table(s, d, "orders"), "o_orderkey", ["o_orderpriority"]))
query("collection_digest")(
    lambda s, d: kd.collection_digest(b.table(s, d, "orders"), "o_orderkey",
                                      ["o_orderpriority"]))
query("sort_by_string_key")(
    lambda s, d: kd.sort_by_string_key(b.table(s, d, "part").select("p_partkey"),
                                       "p_partkey"))
query("sort_by_struct_key")(
    lambda s, d: kd.sort_by_struct_key(
        b.table(s, d, "part").select("p_brand", "p_size", "p_partkey"),
        ["p_brand", "p_size", "p_partkey"]))
query("pair_text")(lambda s, d: pair_text(_word_count(s, d), "word", "count"))


@query("pair_text_parts")
def _pair_text_parts(spark, d):
    """Orders per customer written as pair text, each customer into the part file that an
    md5 bucket names, and read back with the file that holds it."""
    per_cust = (b.table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")))
    path = b.new_folder(spark, "pairs")
    write_placed_pairs(per_cust, "o_custkey", "n", md5_bucket("o_custkey", buckets=7), 7, path)
    return read_parts(spark, path)


# the two largest values and their event ids, by event type: combiners are (v1, id1, v2, id2)

def _top2(pair):
    return (pair["v"], pair["i"], None, None)


def _top2_merge(a, c):
    pairs = sorted(((v, -i) for v, i in (a[:2], a[2:], c[:2], c[2:]) if v is not None), reverse=True)[:2]
    flat = [x for v, i in pairs for x in (v, -i)]
    return (*flat, *[None] * (4 - len(flat)))


@query("combine_by_key_top2")
def _combine_top2(spark, d):
    ev = b.table(spark, d, "events").where("value IS NOT NULL AND event_id IS NOT NULL").select(
        "event_type", F.struct(F.col("value").alias("v"), F.col("event_id").alias("i")).alias("pair"))
    return kd.combine_by_key(ev, "event_type", "pair", _top2, lambda c, p: _top2_merge(c, _top2(p)), _top2_merge,
                             "value1 double, id1 long, value2 double, id2 long")


# --- files: tables written as text, read back by the fixed-schema readers -----------
# every 97th key gets a malformed line of its own beside the good one

def _bad(key: str):
    return F.col(key) % 97 == 5


def _as_lines(df: DataFrame, key: str, good, bad) -> DataFrame:
    """Lines of ``good``, and of ``bad`` for the marked keys."""
    return df.select(F.explode(F.when(_bad(key), F.array(good, bad)).otherwise(F.array(good))).alias("value"))


@query("read_lines_files")
def _read_lines(spark, d):
    """Log lines written as text files and read again, counted by their length."""
    path = b.write_lines(b.clf_lines(spark, d).select("value"), "log")
    return read_lines(spark, path).groupBy(F.length("value").alias("length")).agg(
        F.count(F.lit(1)).alias("lines"))


@query("read_movies_csv")
def _read_movies(spark, d):
    m = b.movies(spark, d)
    path = b.write_lines(_as_lines(
        m, "movieId", F.concat("movieId", F.lit(',"'), "title", F.lit('",none')),
        F.concat(F.lit("x"), "movieId", F.lit(",bad,none"))), "movies", header="movieId,title,genres")
    return read_movies(spark, path, malformed="malformed")


@query("read_ratings_csv")
def _read_ratings(spark, d):
    od = b.table(spark, d, "orders").select("o_custkey", "o_orderkey")
    path = b.write_lines(_as_lines(
        od, "o_orderkey", F.concat_ws(",", "o_custkey", "o_orderkey", F.pmod("o_orderkey", F.lit(5)) + F.lit(0.5), F.lit(0)),
        F.concat_ws(",", "o_custkey", "o_orderkey", F.lit("five"), F.lit(0))), "ratings",
        header="userId,movieId,rating,timestamp")
    return read_ratings(spark, path, malformed="malformed")


@query("read_vertices_csv")
def _read_vertices(spark, d):
    v = b.vertices(spark, d)
    path = b.write_lines(_as_lines(v, "id", F.concat("id", F.lit(',"'), "name", F.lit('"')),
                                   F.concat(F.lit("v-"), "id", F.lit(",bad"))), "vertices")
    return read_vertices(spark, path, malformed="malformed")


@query("read_edges_csv")
def _read_edges(spark, d):
    e = b.edges(spark, d).where("src >= 0")
    path = b.write_lines(_as_lines(e, "src", F.concat_ws(",", "src", "dst", "weight"),
                                   F.concat_ws(",", "src", "dst", F.lit("heavy"))), "edges")
    return read_edges(spark, path, malformed="malformed")


@query("read_adjacency_files")
def _read_adjacency(spark, d):
    """Adjacency text from files: links and bad fields per source."""
    li = b.table(spark, d, "lineitem").select("l_partkey", "l_suppkey")
    path = b.write_lines(_as_lines(li, "l_partkey", F.concat_ws(",", "l_partkey", "l_suppkey"),
                                   F.concat_ws(",", "l_partkey", F.lit("y"), "l_suppkey")), "adjacency")
    adj = parse_adjacency(read_lines(spark, path), permissive=True)
    return adj.groupBy("src").agg(F.sum(F.size("links")).alias("links"), F.sum("malformed").alias("malformed"))


query("table_preview")(lambda s, d: preview(b.table(s, d, "orders").select(
    "o_orderkey", "o_custkey", "o_orderpriority"), 20, ["o_orderkey"]))


@query("table_schema")
def _table_schema(spark, d):
    """Columns of the customers with their types and how many values each holds."""
    cust = b.table(spark, d, "customer")
    present = cust.agg(*(F.count(c).alias(c) for c in cust.columns)).unpivot([], cust.columns, "name", "present")
    return schema_rows(spark, cust).join(F.broadcast(present), "name")


# --- ratings and recommendation --------------------------------------------------

# --- fixed values: the personal ratings (movieId, rating) of the original job --
MY_RATINGS = [(260, 5.0), (318, 3.0), (858, 4.0), (912, 3.0), (750, 4.0),
              (1198, 2.0), (58559, 5.0), (4226, 3.0), (50, 5.0), (527, 5.0)]
# ---------------------------------------------------------------------------------
MIN_REVIEWS = 30     # no item reaches 100 ratings in the test tables
TOP_K = 20
RECOMMEND_K = 50


def new_user_id(spark: SparkSession, d: str):
    """An id no rater uses (largest ordering customer + 1), as a scalar
    subquery column: user 0 is a real customer in the test tables.  Raters
    are ordering customers, so one pass over ``orders.o_custkey`` bounds
    them without building the ratings."""
    orders = b.table(spark, d, "orders")
    return orders.agg((F.max("o_custkey") + 1).cast("int")).scalar()


def my_ratings(spark: SparkSession, user_id) -> DataFrame:
    rows = spark.createDataFrame([(0, m, r) for m, r in MY_RATINGS], RATING_SCHEMA)
    return rows.withColumn("userId", user_id)


query("ratings_load")(b.ratings)
query("movies_load")(b.movies)
@query("movies_top_rated")
def _top_rated(spark, d):
    top = rt.top_rated(b.ratings(spark, d), b.movies(spark, d), MIN_REVIEWS, TOP_K)
    return top.withColumn("average", F.round("average", 6))


query("ratings_split")(lambda s, d: rt.md5_split(b.ratings(s, d)))


@query("mean_baseline_rmse")
def _baseline(spark, d):
    r = rt.mean_baseline_rmse_by_split(b.rating_split(b.ratings(spark, d)))
    return r.select(F.round("train_mean", 6).alias("train_mean"),
                    F.round("rmse", 6).alias("rmse"))


@query("unrated_candidates")
def _candidates(spark, d):
    uid = new_user_id(spark, d)
    return rt.unrated_candidates(b.movies(spark, d), my_ratings(spark, uid), uid)


@query("ratings_with_user")
def _with_user(spark, d):
    uid = new_user_id(spark, d)
    train, _, _ = b.splits(spark, d)
    return rt.with_user_ratings(train, my_ratings(spark, uid))


def _cached_splits(spark, d) -> DataFrame:
    """The ratings with their split, to be cached by an ALS query: the three
    splits are then filters over one computation of the ratings join."""
    return b.rating_split(b.ratings(spark, d))


@query("als_rank_search")
def _rank_search(spark, d):
    with rc.persisted(_cached_splits(spark, d)) as (base,):
        train, validation, _ = b.split_frames(base)
        table, _, _ = rc.rank_search(train, validation)
    return table


@query("als_test_rmse")
def _test_rmse(spark, d):
    with rc.persisted(_cached_splits(spark, d)) as (base,):
        train, validation, test = b.split_frames(base)
        _, model, rank = rc.rank_search(train, validation)
        score = rc.model_score(model, test).first()
    return spark.createDataFrame([(rank, *score)],
                                 "rank int, rmse double, n_scored long, n_dropped long")


@query("als_personal_rmse")
def _personal_rmse(spark, d):
    """The model refitted with the user's own ratings, on the same test ratings."""
    uid = new_user_id(spark, d)
    with rc.persisted(_cached_splits(spark, d)) as (base,):
        train, validation, test = b.split_frames(base)
        _, _, rank = rc.rank_search(train, validation)
        model = rc.fit(rt.with_user_ratings(train, my_ratings(spark, uid)), rank)
        score = rc.model_score(model, test).first()
    return spark.createDataFrame([(rank, *score)],
                                 "rank int, rmse double, n_scored long, n_dropped long")


@query("recommend_for_user")
def _recommend(spark, d):
    uid = new_user_id(spark, d)
    with rc.persisted(_cached_splits(spark, d)) as (base,):
        train, validation, _ = b.split_frames(base)
        _, _, rank = rc.rank_search(train, validation)
        recs, _ = rc.recommend_for_user(train, my_ratings(spark, uid), b.movies(spark, d),
                                        uid, rank, RECOMMEND_K)
    return recs


@query("item_mean_rmse")
def _item_mean_rmse(spark, d):
    """RMSE on the test ratings of predicting each item's training mean; items without one
    are not scored."""
    train, _, test = b.splits(spark, d)
    means = rt.item_stats(train).select("movieId", F.col("average").alias("prediction"))
    r = rt.rmse(test.join(means, "movieId"))
    return r.select(F.round("rmse", 6).alias("rmse"))


#: a factor vector solves its normal equations this closely (factors are 32-bit floats)
ALS_CLOSE = 1e-4


@query("als_rank_search_verified")
def _rank_search_verified(spark, d):
    """Per rank: scored and dropped validation ratings, whether the stated RMSE is that of the
    factors' products, and whether exactly the least RMSE is marked as best."""
    with rc.persisted(_cached_splits(spark, d)) as (base,):
        train, validation, _ = b.split_frames(base)
        table, _, _ = rc.rank_search(train, validation)
        stated = {r["rank"]: r for r in table.collect()}
        least = min(r["rmse"] for r in stated.values())
        n = validation.count()
        rows = []
        with rc.solver(train) as (solve, _):
            for rank, r in sorted(stated.items()):
                scored = rc.factor_predictions(solve(rank), validation, rank)
                own = scored.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2))),
                                 F.count(F.lit(1))).first()
                rows.append((rank, own[1], n - own[1], abs(own[0] - r["rmse"]) < ALS_CLOSE,
                             r["is_best"] == (r["rmse"] == least)))
    return spark.createDataFrame(
        rows, "rank int, n_scored long, n_dropped long, rmse_agrees boolean, best_agrees boolean")


@query("als_normal_equations")
def _normal_equations(spark, d):
    """Users and items of the training ratings, and how many do not solve their normal
    equations: users against the final item factors, items against the user factors of one
    iteration less, from which they were solved."""
    rank = rc.ALS_RANKS[0]
    with rc.persisted(_cached_splits(spark, d)) as (base,):
        train, _, _ = b.split_frames(base)
        model, before = rc.fit(train, rank), rc.fit(train, rank, max_iter=rc.ALS_MAX_ITER - 1)
        sides = []
        for side, solved, fixed, by, other in (
                ("user", model.userFactors, model.itemFactors, "userId", "movieId"),
                ("item", model.itemFactors, before.userFactors, "movieId", "userId")):
            res = rc.normal_equation_residuals(train, solved, fixed, by, other, rank)
            n, beyond = res.agg(F.count(F.lit(1)), F.count_if(F.col("residual") > ALS_CLOSE)).first()
            sides.append((side, n, beyond))
    return spark.createDataFrame(sides, "side string, n long, beyond long")


@query("recommend_verified")
def _recommend_verified(spark, d):
    """The recommendations' number and whether they are the best unrated items, with the
    predictions that the model itself gives."""
    uid = new_user_id(spark, d)
    with rc.persisted(_cached_splits(spark, d)) as (base,):
        train, _, _ = b.split_frames(base)
        mine, movies = my_ratings(spark, uid), b.movies(spark, d)
        recs, model = rc.recommend_for_user(train, mine, movies, uid, rc.ALS_RANKS[0], RECOMMEND_K)
        got = [(r["movieId"], r["prediction"]) for r in recs.collect()]
        scored = model.transform(rt.unrated_candidates(movies, mine, uid))
        want = [(r["movieId"], r["prediction"]) for r in scored.orderBy(
            F.desc("prediction"), "movieId").limit(RECOMMEND_K).collect()]
    close = all(abs(g[1] - w[1]) < ALS_CLOSE for g, w in zip(got, want)) and len(got) == len(want)
    return spark.createDataFrame([(len(got), close)], "n int, agrees boolean")


# --- graph -----------------------------------------------------------------------

SOURCE_VERTEX = 0     # part 0


def _adjacency_edges(spark, d):
    return edges_from_lines(b.adjacency_lines(spark, d))


query("adjacency_edges")(_adjacency_edges)


@query("pagerank")
def _pagerank(spark, d):
    e = b.edges(spark, d).select("src", "dst")
    res = gr.pagerank(e, b.graph_ids(spark, d))
    return res.ranks.select("id", F.round("rank", 6).alias("rank"))


query("property_graph")(
    lambda s, d: gr.property_graph(b.vertices(s, d), b.edges(s, d)))


@query("shortest_distances")
def _distances(spark, d):
    sp = gr.shortest_distances(b.edges(spark, d), SOURCE_VERTEX, vertices=b.graph_ids(spark, d))
    return sp.distances.select("id", "dist")


@query("shortest_paths")
def _paths(spark, d):
    sp = gr.shortest_paths(b.edges(spark, d), SOURCE_VERTEX, vertices=b.graph_ids(spark, d))
    return sp.select("id", "dist", F.array_join("path", ",").alias("path"))


@query("shortest_distances_signed")
def _signed_distances(spark, d):
    sp = gr.shortest_distances(b.signed_edges(spark, d), SOURCE_VERTEX, vertices=b.graph_ids(spark, d))
    return sp.distances.select("id", "dist")
