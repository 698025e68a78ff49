"""Each original job end to end, from files to written results."""

import math
import os
import tempfile

from pyspark.sql import functions as F

from kiln.operators import graph as gr
from kiln.operators import keyed as kd
from kiln.operators import ratings as rt
from kiln.operators import recommend as rc
from kiln.operators import weblog as wl
from kiln.sources import (edges_from_lines, read_edges, read_lines, read_movies, read_ratings,
                          read_vertices, vertices_from_lines, write_pair_text)


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_log_report_job(spark):
    d = tempfile.mkdtemp(prefix="kiln-job-")
    lines = []
    for day in (1, 2):
        for i in range(12):
            status = 404 if i % 4 == 0 else 200
            size = "-" if status == 404 else str(100 + i)
            lines.append(f'h{i % 3} - - [0{day}/Jul/1995:10:00:{i:02d} -0400] '
                         f'"GET /p{i % 5} HTTP/1.0" {status} {size}')
    logs = wl.clean_log(wl.parse_log(read_lines(spark, write(d, "log.txt", "\n".join(lines)))))
    assert {r["status"]: r["count"] for r in wl.status_counts(logs).collect()} == {200: 18, 404: 6}
    assert [tuple(r) for r in wl.daily_avg_requests_per_host(logs).collect()] == [(1, 4.0), (2, 4.0)]
    assert wl.not_found(logs).count() == 6
    assert wl.size_stats(logs).first()["min"] == 0


def test_ratings_job(spark):
    d = tempfile.mkdtemp(prefix="kiln-job-")
    movies = read_movies(spark, write(d, "movies.csv", "movieId,title,genres\n" + "".join(
        f"{m},Movie {m},Drama\n" for m in range(1, 11))))
    ratings = read_ratings(spark, write(d, "ratings.csv", "userId,movieId,rating,timestamp\n" + "".join(
        f"{u},{m},{(u * m) % 5 + 1}.0,1\n" for u in range(1, 31) for m in range(1, 11))))
    top = rt.top_rated(ratings, movies, min_reviews=30, k=3).collect()
    assert len(top) == 3 and top[0]["average"] >= top[-1]["average"]
    train, validation, test = rt.random_split(ratings)
    table, model, rank = rc.rank_search(train, validation, ranks=(2, 3), max_iter=3)
    assert table.count() == 2 and rank in (2, 3)
    assert math.isfinite(rc.model_rmse(model, test))
    assert rt.mean_baseline_rmse(train, test).first()["rmse"] > 0


def test_pagerank_job_writes_pairs(spark):
    d = tempfile.mkdtemp(prefix="kiln-job-")
    lines = read_lines(spark, write(d, "graph.txt", "11,12\n12,11\n13\n"))
    out = os.path.join(d, "ranks")
    ranks = gr.pagerank(edges_from_lines(lines), vertices_from_lines(lines)).ranks.select("id", F.round("rank", 6).alias("rank"))
    write_pair_text(ranks, "id", "rank", out)
    assert sorted(r[0] for r in spark.read.text(out).collect()) == [
        "(11,1.0)", "(12,1.0)", "(13,0.15)"]


def test_shortest_path_job(spark):
    d = tempfile.mkdtemp(prefix="kiln-job-")
    vertices = read_vertices(spark, write(d, "vertex.csv", "".join(
        f'{i},"{c}"\n' for i, c in zip(range(1, 7), "abcdef"))))
    edges = read_edges(spark, write(d, "edges.csv", "1,2,7\n1,3,9\n1,6,14\n2,3,10\n2,4,15\n"
                                    "3,4,11\n3,6,2\n4,5,6\n5,6,9\n"))
    assert gr.property_graph(vertices, edges).count() == 6
    got = {r["id"]: (r["dist"], list(r["path"])) for r in gr.shortest_paths(edges, 1).collect()}
    assert got[5] == (26.0, [1, 3, 4])


def test_word_count_job(spark):
    d = tempfile.mkdtemp(prefix="kiln-job-")
    out = os.path.join(d, "counts")
    counts = kd.word_count(read_lines(spark, write(d, "words.txt", "a b a\nb c\n")))
    write_pair_text(counts, "word", "count", out)
    assert sorted(r[0] for r in spark.read.text(out).collect()) == ["(a,2)", "(b,2)", "(c,1)"]
