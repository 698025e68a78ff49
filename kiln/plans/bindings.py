"""Inputs of each operator family, derived by Spark from the test tables.

Every binding is a lazy DataFrame over the parquet files, so a query's work
grows with the tables.  Each binding is linear in its input: row-wise
projections, joins on keys and partial-aggregating groupings; none pairs up
rows inside a group.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.text import split_lines
from kiln.operators.ratings import md5_split
from kiln.session import checkpoint_dir
from kiln.sources.readers import MOVIE_SCHEMA, RATING_SCHEMA, conform, spread


#: the test tables hold each of the text-heavy inputs in one split
SINGLE_SPLIT_PARTITIONS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Common-Log-Format line per event: ``(event_id, value)``.

    Host from the user, path from event type and ``props.k``, status from
    the event type (error 404, signup 302, click 304, else 200), size
    ``-`` for errors else ``floor(value*100)``; fixed offset ``-0400``.
    Events are spread first, as the test table is a single split
    (the lines are parsed by five regular expressions each).
    """
    ev = spread(table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"), SINGLE_SPLIT_PARTITIONS)
    status = (F.when(F.col("event_type") == "error", 404)
              .when(F.col("event_type") == "signup", 302)
              .when(F.col("event_type") == "click", 304).otherwise(200))
    size = (F.when(F.col("event_type") == "error", F.lit("-"))
            .otherwise(F.floor(F.col("value") * 100).cast("bigint").cast("string")))
    value = F.concat(
        F.lit("host"), F.col("user_id").cast("string"), F.lit(".example.com - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' -0400] "GET /'),
        F.col("event_type"), F.lit("/"), F.get_json_object("props", "$.k"),
        F.lit(' HTTP/1.0" '), status.cast("string"), F.lit(" "), size)
    return ev.select("event_id", value.alias("value"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document as ``value``, split as a text-file reader
    splits lines (``\\n``, ``\\r\\n``, ``\\r``).  Documents are spread
    first, as the test table is a single split."""
    docs = spread(table(spark, sf_dir, "documents").select("text"), SINGLE_SPLIT_PARTITIONS)
    return docs.select(F.explode(split_lines(F.col("text"))).alias("value"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(userId int, movieId int, rating double)``: per customer and part,
    the mean of ``1 + (quantity - 1) % 5`` over the customer's line items.

    Ids are cast with ANSI casts: an id beyond int range fails loudly
    (the ALS estimator needs int ids).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    score = 1 + (F.col("l_quantity").cast("int") - 1) % 5
    r = (li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
         .groupBy(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"))
         .agg(F.avg(score).alias("rating")))
    return conform(r, RATING_SCHEMA)


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(movieId int, title string)`` from the part catalogue."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("movieId"),
                                            F.col("p_name").alias("title"))
    return conform(p, MOVIE_SCHEMA)


def rating_split(r: DataFrame) -> DataFrame:
    """Ratings with a ``split`` column: md5 bucket < 60 train, < 80 validation,
    else test (layout-independent, so every run and engine agrees)."""
    return md5_split(r)


def split_frames(with_split: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(train, validation, test)`` as filters over ratings with ``split``."""
    cols = ["userId", "movieId", "rating"]
    return tuple(with_split.where(F.col("split") == name).select(*cols)
                 for name in ("train", "validation", "test"))


def splits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return split_frames(rating_split(ratings(spark, sf_dir)))


def supplier_vertex(suppkey) -> F.Column:
    """Graph id of a supplier: ``-(suppkey + 1)``; parts keep their key."""
    return -(F.col(suppkey) + 1) if isinstance(suppkey, str) else -(suppkey + 1)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted directed part <-> supplier graph ``(src, dst, weight)``.

    One edge each way per (part, supplier) pair that shares a line item;
    weight = the smallest quantity on those lines.  Parts keep their key,
    suppliers get ``-(suppkey+1)``.  One partial-aggregating grouping over
    ``lineitem``: no self-join, nothing quadratic in a hot key.
    """
    li = table(spark, sf_dir, "lineitem")
    pairs = (li.groupBy("l_partkey", "l_suppkey")
             .agg(F.min(F.col("l_quantity").cast("bigint")).alias("weight")))
    part, supp = F.col("l_partkey"), supplier_vertex("l_suppkey")
    both = F.array(F.struct(part.alias("src"), supp.alias("dst"), F.col("weight")),
                   F.struct(supp.alias("src"), part.alias("dst"), F.col("weight")))
    return pairs.select(F.inline(both))


def adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacency text, one line per line item: ``part,supplier-vertex``."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.concat_ws(",", F.col("l_partkey").cast("string"),
                                 supplier_vertex("l_suppkey").cast("string")).alias("value"))


def graph_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id`` of every part and supplier, with edges or without."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("bigint").alias("id"))
    s = table(spark, sf_dir, "supplier").select(supplier_vertex("s_suppkey").cast("bigint").alias("id"))
    return p.union(s)


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named vertices ``(id, name)``: the parts.  Supplier vertices have no
    row, so graph assembly gives them the default name."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"),
                                               F.col("p_name").alias("name"))


def signed_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`edges` with weights of either sign: the quantity plus the size of the part left
    less the size of the part reached (suppliers have none).  Along a cycle the sizes
    cancel out, so no cycle is negative."""
    size = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_id"), F.col("p_size").alias("_size"))
    e = edges(spark, sf_dir)
    e = e.join(size, F.greatest("src", "dst") == F.col("_id"), "left")
    size = F.coalesce("_size", F.lit(0)).cast("bigint")
    return e.select("src", "dst", (F.col("weight") + F.when(F.col("src") >= 0, size).otherwise(-size)).alias("weight"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A new place for files below the checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_lines(lines: DataFrame, name: str, header: str | None = None) -> str:
    """Write the lines (column ``value``) as text files, each with ``header`` as its first
    line, and return where."""
    path = new_folder(lines.sparkSession, name)
    if header is None:
        lines.write.text(path)
    else:
        # quoting and escaping are in the lines already
        (lines.withColumnRenamed("value", header).write.option("header", True).option("sep", "\x01")
         .option("quote", "").option("escapeQuotes", False).csv(path))
    return path
