"""Keyed, partition and sort primitives on the fixtures A2-A6 and B2."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kiln.operators import keyed as kd
from kiln.sources.sinks import pair_text


def test_average_by_key_integer_and_true_mean(spark):
    scores = spark.createDataFrame(
        [("oak", 7), ("oak", 8), ("elm", -7), ("elm", -8), ("ash", 12), ("fir", None)],
        "name string, score int")
    got = {r["name"]: (r["avg_int"], r["average"], r["matches"]) for r in
           kd.average_by_key(scores, "name", "score").collect()}
    assert got == {"oak": (7, 7.5, 2), "elm": (-7, -7.5, 2), "ash": (12, 12.0, 1), "fir": (None, None, 0)}


def test_averages_keep_fractions_and_large_sums(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 0.9)], "k string, v double")
    row = kd.average_by_key(df, "k", "v").first()
    assert (row["total"], row["avg_int"], row["average"]) == (1.4, 0, 0.7)
    assert kd.partition_average(df, "v").first()[0] == 0.7
    big = spark.createDataFrame([("a", 9007199254740993)], "k string, v long")
    assert kd.average_by_key(big, "k", "v").first()["avg_int"] == 9007199254740993


def test_java_split_rule(spark):
    lines = spark.createDataFrame([("a b  ",), ("",), ("   ",), (" a",), ("a  b",), ("x\ty",)],
                                  "value string")
    got = sorted((r["word"], r["count"]) for r in kd.word_count(lines).collect())
    assert got == [("", 3), ("a", 3), ("b", 2), ("x\ty", 1)]
    dropped = sorted(r["word"] for r in kd.words(lines, drop_empty=True).collect())
    assert dropped == ["a", "a", "a", "b", "b", "x\ty"]


def test_partition_average_and_sizes(spark):
    ints = spark.range(1, 10001, 1, 10).select(F.col("id").cast("int").alias("x"))
    assert kd.partition_average(ints, "x").first()[0] == 5000.5
    sizes = [tuple(r) for r in kd.partition_sizes(ints).orderBy("partition").collect()]
    assert sizes == [(i, 1000) for i in range(10)]
    parts = kd.partition_partials(ints, "x").agg(F.sum("total"), F.sum("n")).first()
    assert tuple(parts) == (50005000, 10000)


def test_partition_sizes_reports_empty_partitions(spark):
    one = spark.createDataFrame([(1,)], "k int")
    sizes = [r["count"] for r in kd.partition_sizes(one, 4, ["k"]).orderBy("partition").collect()]
    assert sorted(sizes) == [0, 0, 0, 1]


def test_empty_average_is_null(spark):
    empty = spark.createDataFrame([], "x int")
    assert kd.partition_average(empty, "x").first()[0] is None


def test_collect_values_and_digest(spark):
    vals = spark.range(1, 21).select(F.col("id").cast("int").alias("x"))
    assert sorted((r["position"], r["x"]) for r in kd.collect_values(vals, "x").collect()) == [
        (i, i) for i in range(1, 21)]
    d = kd.collection_digest(vals, "x").first()
    assert (d["n_values"], d["n_distinct"], d["min_value"], d["max_value"], int(d["sum_value"])) \
        == (20, 20, 1, 20, 210)


def test_sort_by_string_key(spark):
    keys = spark.createDataFrame([(20, 1), (9, 2), (2, 3), (200, 4), (21, 5), (-2, 6)], "key int, value int")
    got = [r["key"] for r in kd.sort_by_string_key(keys, "key").orderBy("position").collect()]
    assert got == [-2, 2, 20, 200, 21, 9]


def test_sort_by_struct_key(spark):
    rows = [(("m", 3), 1), (("b", 8), 2), (("m", -3), 3), (("b", 8), 4), (("", 0), 5)]
    df = spark.createDataFrame(rows, "key struct<str:string,data:int>, value int") \
        .select("key.str", "key.data", "value")
    out = kd.sort_by_struct_key(df, ["str", "data"], num_partitions=4).orderBy("position")
    got = [tuple(r)[:3] for r in out.collect()]
    assert [r[:2] for r in got] == [("", 0), ("b", 8), ("b", 8), ("m", -3), ("m", 3)]
    assert sorted(got) == sorted((*k, v) for k, v in rows)
    ranged = kd.sort_range_partitioned(df, ["str", "data"], 4)
    assert ranged.rdd.getNumPartitions() == 4


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.text("abc", max_size=3), st.integers(-5, 5)), max_size=40))
def test_struct_sort_is_a_permutation_in_order(spark, data):
    df = spark.createDataFrame(data, "s string, d int")
    out = [(r["s"], r["d"], r["position"]) for r in
           kd.sort_by_struct_key(df, ["s", "d"]).collect()]
    assert sorted(p for _, _, p in out) == list(range(1, len(data) + 1))
    assert [(s, d) for s, d, _ in sorted(out, key=lambda x: x[2])] == sorted(data)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(" ab", max_size=8), max_size=20))
def test_word_counts_sum_to_word_total(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")

    # JVM split: trailing empty words dropped, "" -> one empty word
    def jsplit(x):
        if x == "":
            return [""]
        parts = x.split(" ")
        while parts and parts[-1] == "":
            parts.pop()
        return parts
    expect = sum(len(jsplit(x)) for x in lines)
    total = kd.word_count(df).agg(F.sum("count")).first()[0] or 0
    assert total == expect


def test_pair_text(spark):
    df = spark.createDataFrame([("a", 2), ("b", 1)], "word string, count long")
    assert sorted(r[0] for r in pair_text(df, "word", "count").collect()) == ["(a,2)", "(b,1)"]


def test_positional_sort_spreads_a_hot_key(spark):
    """One key on half the rows: still split over several range partitions."""
    rows = [(0, i) for i in range(400)] + [(k, k) for k in range(1, 401)]
    df = spark.createDataFrame(rows, "k int, v int")
    out = kd.sort_by_struct_key(df, ["k"], num_partitions=8)
    assert sorted(r["position"] for r in out.collect()) == list(range(1, 801))
    hot = out.where("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot > 1


def test_literal_rows_in_contiguous_partitions(spark):
    from pyspark.sql import types as T
    from kiln.sources import rows_to_frame
    schema = T.StructType([T.StructField("x", T.IntegerType())])
    df = rows_to_frame(spark, [(i,) for i in range(1, 10001)], schema, num_partitions=10)
    assert kd.partition_average(df, "x").first()[0] == 5000.5
    sizes = [tuple(r) for r in kd.partition_sizes(df).orderBy("partition").collect()]
    assert sizes == [(i, 1000) for i in range(10)]
    firsts = df.groupBy(F.spark_partition_id().alias("p")).agg(F.min("x").alias("m"))
    assert sorted(r["m"] for r in firsts.collect()) == [1 + 1000 * i for i in range(10)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(-1000, 1000)), min_size=1, max_size=40))
def test_average_times_count_is_sum(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int")
    for r in kd.average_by_key(df, "k", "v").collect():
        expect = sum(v for k, v in rows if k == r["k"])
        assert r["total"] == expect
        assert abs(r["average"] * r["matches"] - expect) < 1e-6
        assert r["avg_int"] == int(expect / r["matches"])


def test_split_lines_like_a_text_file(spark):
    from kiln.functions.text import split_lines
    df = spark.createDataFrame([("a\nb\n",), ("a\r\nb\rc",), ("",), ("a\n\n",), ("x",)], "t string")
    got = [r[0] for r in df.select(split_lines(F.col("t"))).collect()]
    assert got == [["a", "b"], ["a", "b", "c"], [], ["a", ""], ["x"]]


def test_partition_sizes_are_those_of_a_repartitioning(spark):
    """Counted without moving the rows, equal to what a repartitioning gives."""
    from conftest import SF_SMALL
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey")
    moved = li.repartition(10, "l_orderkey").groupBy(F.spark_partition_id().alias("p")).count()
    got = kd.partition_sizes(li, 10, ["l_orderkey"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, moved.collect()))
    assert "REPARTITION" not in got._jdf.queryExecution().executedPlan().toString()


def longest(spark, rows, max_keys=100_000, parts=3):
    """Longest text and number of values by key, as a three-function aggregation."""
    df = spark.createDataFrame(rows, "k string, v string").repartition(parts).select("v", "k")

    def merge(a, b):
        return max(a[0], b[0], key=lambda t: (len(t), t)), a[1] + b[1]

    args = (df, "k", "v", lambda v: (v, 1), lambda c, v: merge(c, (v, 1)))
    partials = kd.combine_partials(*args, "best string, n long", max_keys)
    done = kd.combine_by_key(*args, merge, "best string, n long", max_keys)
    assert done.columns == partials.columns == ["k", "best", "n"]
    return partials.collect(), sorted(map(tuple, done.collect()), key=repr)


def test_combine_by_key_hands_on_one_row_per_task_and_key(spark):
    rows = [("hot", f"v{i}") for i in range(3000)] + [("a", "xx"), ("a", None), (None, "n"), (None, "nn"), ("b", None)]
    partials, done = longest(spark, rows)
    assert done == sorted([("hot", "v2999", 3000), ("a", "xx", 1), (None, "nn", 2)], key=repr)
    assert len(partials) <= 3 * 3 and sum(r["n"] for r in partials) == 3003


def test_combine_by_key_with_a_small_table(spark):
    rows = [(f"k{i % 50}", f"v{i}") for i in range(1000)]
    _, done = longest(spark, rows, max_keys=5)
    want = {k: max((v for q, v in rows if q == k), key=lambda t: (len(t), t)) for k, _ in rows}
    assert done == sorted(((k, v, 20) for k, v in want.items()), key=repr)
    assert longest(spark, [("x", None)])[1] == []


def test_partition_sizes_counted_per_key_first(spark):
    from pyspark.sql import functions as F
    df = spark.range(1000).select((F.col("id") % 37).alias("k"))
    a = kd.partition_sizes(df, 5, by=["k"], place=F.col("k") * 3)
    b = kd.partition_sizes(df, 5, place=F.col("k") * 3)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
