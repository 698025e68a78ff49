"""Sources and sinks: CSV with fixed schemas, text lines, pair-text sink."""

import os
import tempfile

import pytest

from kiln.sources import (conform, preview, read_edges, read_lines, read_movies, read_ratings,
                          read_vertices, rows_to_frame, schema_rows, write_pair_text)
from pyspark.sql import types as T


def write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_csv_readers(spark):
    tmp = tempfile.mkdtemp(prefix="kiln-src-")
    m = write(tmp, "movies.csv", 'movieId,title,genres\n1,"Toy, Story",Animation\n2,Jumanji,Adventure\n')
    r = write(tmp, "ratings.csv", "userId,movieId,rating,timestamp\n1,1,4.0,964982703\n1,2,2.5,1\n")
    v = write(tmp, "vertex.csv", '1,"a"\n2,"b"\n')
    e = write(tmp, "edges.csv", "1,2,7\n1,3,9\n")
    assert [tuple(x) for x in read_movies(spark, m).collect()] == [(1, "Toy, Story"), (2, "Jumanji")]
    assert [tuple(x) for x in read_ratings(spark, r).collect()] == [(1, 1, 4.0), (1, 2, 2.5)]
    assert [tuple(x) for x in read_vertices(spark, v).collect()] == [(1, "a"), (2, "b")]
    assert [tuple(x) for x in read_edges(spark, e).collect()] == [(1, 2, 7), (1, 3, 9)]
    assert read_lines(spark, e).count() == 2


def test_malformed_rows_fail_or_are_reported(spark):
    tmp = tempfile.mkdtemp(prefix="kiln-src-")
    r = write(tmp, "ratings.csv", "userId,movieId,rating,timestamp\n1,1,4.0,9\n1,2,x,1\n")
    e = write(tmp, "edges.csv", "1,2,7\n2,3,9.5\n")
    for read, path in ((read_ratings, r), (read_edges, e)):
        with pytest.raises(Exception):
            read(spark, path).collect()
        kept = read(spark, path, malformed="bad").cache()
        assert [x["bad"] for x in kept.collect() if x["bad"]] == [
            {r: "1,2,x,1", e: "2,3,9.5"}[path]]
        assert kept.count() == 2


def test_literal_rows_schema_and_preview(spark):
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("count", T.IntegerType())])
    df = rows_to_frame(spark, [("Ines", 31), ("Otto", 44), ("Mia", 7)], schema)
    assert df.count() == 3
    assert [r["name"] for r in df.select("name").collect()] == ["Ines", "Otto", "Mia"]
    assert [tuple(r) for r in schema_rows(spark, df).collect()] == [
        ("name", "string", True), ("count", "int", True)]
    assert [r["name"] for r in preview(df, 2, ["count"]).collect()] == ["Mia", "Ines"]


def test_conform_fails_on_out_of_range_id(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    df = spark.createDataFrame([(2**40,)], "id long")
    with pytest.raises(Exception):
        conform(df, schema).collect()


def test_pair_text_sink_fails_if_exists(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="kiln-sink-"), "counts")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    write_pair_text(df, "k", "v", out)
    assert sorted(r[0] for r in spark.read.text(out).collect()) == ["(a,1)", "(b,2)"]
    with pytest.raises(Exception):
        write_pair_text(df, "k", "v", out)


def test_spread_only_under_partitioned_inputs(spark):
    from kiln.sources import spread
    one = spark.range(0, 1000, 1, 1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    assert spread(one, 4).count() == 1000
    many = spark.range(0, 1000, 1, 6)
    assert spread(many, 4) is many


def test_placed_pairs_land_in_their_part_files(spark, tmp_path):
    from pyspark.sql import functions as F
    from kiln.sources import read_parts, write_placed_pairs
    df = spark.range(100).select("id", (F.col("id") * 2).alias("v"))
    path = str(tmp_path / "pairs")
    write_placed_pairs(df, "id", "v", F.col("id") % 4, 6, path)
    got = sorted(map(tuple, read_parts(spark, path).collect()))
    assert got == sorted((i % 4, f"({i},{2 * i})") for i in range(100))
    with pytest.raises(Exception):
        write_placed_pairs(df, "id", "v", F.col("id") % 4, 6, path)


def test_written_lines_are_read_as_they_were(spark, tmp_path):
    from kiln.plans.bindings import write_lines
    lines = ['1,"a, b",x', 'bad"line', "3,c,y"]
    df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    path = write_lines(df, "t", header="movieId,title,genres")
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted([*lines, "movieId,title,genres"])
