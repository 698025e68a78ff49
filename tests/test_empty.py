"""Every family on empty input: empty (or zero-valued) results, no failure."""

from kiln.operators import graph as gr
from kiln.operators import keyed as kd
from kiln.operators import ratings as rt
from kiln.operators import weblog as wl


def test_weblog_on_no_lines(spark):
    lines = spark.createDataFrame([], "value string")
    logs = wl.clean_log(wl.parse_log(lines))
    assert wl.status_counts(logs).count() == 0
    assert wl.unique_hosts(logs).first()[0] == 0
    assert wl.count_rows_with_nulls(logs).first()[0] == 0
    assert wl.daily_avg_requests_per_host(logs).count() == 0
    assert tuple(wl.null_gate(lines).first()) == ("value_not_null", 0, True)


def test_keyed_on_nothing(spark):
    empty = spark.createDataFrame([], "k string, v int")
    assert kd.word_count(spark.createDataFrame([], "value string")).count() == 0
    assert kd.average_by_key(empty, "k", "v").count() == 0
    assert kd.collection_digest(empty, "v", ["k"]).count() == 0
    assert kd.sort_by_struct_key(empty, ["k", "v"]).count() == 0


def test_ratings_on_nothing(spark):
    empty = spark.createDataFrame([], "userId int, movieId int, rating double")
    movies = spark.createDataFrame([], "movieId int, title string")
    assert rt.top_rated(empty, movies, 1, 5).count() == 0
    row = rt.mean_baseline_rmse(empty, empty).first()
    assert row["train_mean"] is None and row["rmse"] is None


def test_graph_on_no_edges(spark):
    e = spark.createDataFrame([], "src long, dst long, weight long")
    assert gr.shortest_paths(e, 1).count() == 0
    assert gr.pagerank(e.select("src", "dst")).ranks.count() == 0
