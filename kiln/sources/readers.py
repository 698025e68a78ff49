"""Sources with explicit schemas (no inference: a fixed schema reads faster
and makes a changed file fail loudly instead of silently re-typing)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATING_SCHEMA = T.StructType([
    T.StructField("userId", T.IntegerType(), True),
    T.StructField("movieId", T.IntegerType(), True),
    T.StructField("rating", T.DoubleType(), True),
])
# the rating file carries a fourth column that is read and dropped
RATING_FILE_SCHEMA = T.StructType(RATING_SCHEMA.fields + [
    T.StructField("timestamp", T.LongType(), True)])
MOVIE_SCHEMA = T.StructType([
    T.StructField("movieId", T.IntegerType(), True),
    T.StructField("title", T.StringType(), True),
])
MOVIE_FILE_SCHEMA = T.StructType(MOVIE_SCHEMA.fields + [
    T.StructField("genres", T.StringType(), True)])
VERTEX_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("name", T.StringType(), True),
])
EDGE_SCHEMA = T.StructType([
    T.StructField("src", T.LongType(), True),
    T.StructField("dst", T.LongType(), True),
    T.StructField("weight", T.LongType(), True),
])


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text file(s) -> one row per line in column ``value`` (splittable scan)."""
    return spark.read.text(path)


def read_csv_fixed(spark: SparkSession, path: str, schema: T.StructType,
                   header: bool, malformed: str | None = None) -> DataFrame:
    """CSV with a fixed schema.  A malformed row fails the job; with ``malformed``
    (a column name) it is kept instead, its text in that column (else null) and
    its bad fields null, so that the caller can count it."""
    reader = spark.read.option("header", header)
    if malformed is None:
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    return (reader.schema(T.StructType(schema.fields + [T.StructField(malformed, T.StringType())]))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", malformed).csv(path))


def _kept(schema: T.StructType, malformed: str | None) -> list[str]:
    return schema.names + ([malformed] if malformed else [])


def read_movies(spark: SparkSession, path: str, malformed: str | None = None) -> DataFrame:
    """Movie catalogue CSV with header -> ``(movieId int, title string)``."""
    return read_csv_fixed(spark, path, MOVIE_FILE_SCHEMA, True, malformed).select(
        _kept(MOVIE_SCHEMA, malformed))


def read_ratings(spark: SparkSession, path: str, malformed: str | None = None) -> DataFrame:
    """Rating CSV with header -> ``(userId int, movieId int, rating double)``."""
    return read_csv_fixed(spark, path, RATING_FILE_SCHEMA, True, malformed).select(
        _kept(RATING_SCHEMA, malformed))


def read_vertices(spark: SparkSession, path: str, malformed: str | None = None) -> DataFrame:
    """Vertex CSV ``id,name`` without header (quoted names are unquoted)."""
    return read_csv_fixed(spark, path, VERTEX_SCHEMA, False, malformed)


def read_edges(spark: SparkSession, path: str, malformed: str | None = None) -> DataFrame:
    """Edge CSV ``src,dst,weight`` without header."""
    return read_csv_fixed(spark, path, EDGE_SCHEMA, False, malformed)


def spread(df: DataFrame, min_partitions: int) -> DataFrame:
    """Round-robin ``df`` over ``min_partitions`` if it has fewer: an explicit
    call for CPU-heavy row-wise work over an input stored as a few large row
    groups.  Give a number that belongs to the data, not to the cluster."""
    return df if df.rdd.getNumPartitions() >= min_partitions else df.repartition(min_partitions)


def rows_to_frame(spark: SparkSession, rows: Iterable[Sequence],
                  schema: T.StructType, num_partitions: int | None = None) -> DataFrame:
    """Literal rows + explicit schema -> DataFrame (small, driver-side input).

    With ``num_partitions`` the rows are cut into that many contiguous
    slices, in order, as a parallelised local collection is.
    """
    rows = list(rows)
    if num_partitions is None:
        return spark.createDataFrame(rows, schema)
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, num_partitions), schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same names and order, ANSI casts.

    Casting uses ``cast`` (not ``try_cast``) so that an id that does not fit
    the declared type fails the job instead of turning into null.
    """
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name)
                      for f in schema.fields])
