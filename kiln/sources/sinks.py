"""Sinks: ``(k,v)`` pair text, preview and schema-as-rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pair_text(df: DataFrame, key: str, value: str, out: str = "line") -> DataFrame:
    """Rows -> text lines ``(key,value)`` as a pair-RDD text dump prints them."""
    return df.select(F.concat(F.lit("("), F.col(key).cast("string"), F.lit(","),
                              F.col(value).cast("string"), F.lit(")")).alias(out))


def write_pair_text(df: DataFrame, key: str, value: str, path: str,
                    mode: str = "errorifexists") -> None:
    """Write ``(k,v)`` lines, one file per partition; by default fail if
    ``path`` exists, as a text dump of pairs does."""
    pair_text(df, key, value).write.mode(mode).text(path)


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows (ordered by ``order_by`` when given, so it is testable)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema of ``df`` as rows ``(name, type, nullable)``."""
    schema = T.StructType([T.StructField("name", T.StringType()),
                           T.StructField("type", T.StringType()),
                           T.StructField("nullable", T.BooleanType())])
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields], schema)


def write_placed_pairs(df: DataFrame, key: str, value: str, place: Column, num_partitions: int,
                       path: str) -> None:
    """Write ``(k,v)`` lines into ``num_partitions`` part files, each row into the one that
    ``place`` (an integer column, 0 to ``num_partitions - 1``) names."""
    placed = pair_text(df.withColumn("_place", place.cast("int")).repartitionById(
        num_partitions, "_place"), key, value)
    placed.write.mode("errorifexists").text(path)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """``(part, line)``: lines of text files as a job committed them, with the number of
    the part file that holds each."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return spark.read.text(path).select(
        F.regexp_extract(name, r"^part-(\d+)", 1).cast("int").alias("part"), F.col("value").alias("line"))
