"""Keyed, partition and sort primitives on DataFrames.

The pair-collection idioms of a keyed job map to built-in aggregates:
``reduceByKey(+)`` -> ``groupBy().sum`` (partial sums before the shuffle),
``combineByKey`` average -> ``sum``/``count``, per-partition partials ->
``groupBy(spark_partition_id())``, a custom key ordering -> a sort
expression, a list accumulator -> the values as a sorted frame plus a
bounded per-key digest.  Sorted output is numbered by a distributed
range-partitioned sort (:func:`with_position`), not a single-task window.
Nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kiln.functions.text import java_split_words
from kiln.session import checkpoint_dir


def words(lines: DataFrame, col: str = "value", drop_empty: bool = False) -> DataFrame:
    """One row per word (``word``) by the JVM ``split(" ")`` rule."""
    return lines.select(F.explode(java_split_words(F.col(col), drop_empty)).alias("word"))


def word_count(lines: DataFrame, col: str = "value", drop_empty: bool = False) -> DataFrame:
    """``(word, count)`` over all lines.  A hot word is summed map-side
    first, so its skew never reaches the shuffle."""
    return words(lines, col, drop_empty).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def average_by_key(df: DataFrame, key: str | Sequence[str], value: str) -> DataFrame:
    """Per key: ``matches`` (non-null values), ``total``, ``avg_int`` (the mean
    without its fraction, as an int-typed combiner computes it) and ``average``
    (true mean).  Values are summed as they are: integers in 64 bits, where
    ``avg_int`` is an exact integer division, other numbers in their own sum type."""
    keys = [key] if isinstance(key, str) else list(key)
    whole = df.schema[value].dataType.typeName() in ("byte", "short", "integer", "long")
    mean = F.col("total") / F.col("matches")
    return (df.groupBy(*keys)
            .agg(F.count(value).alias("matches"), F.sum(value).alias("total"))
            .select(*keys, "matches", "total",
                    (F.expr("total div matches") if whole else mean.cast("bigint")).alias("avg_int"),
                    mean.alias("average")))


def partition_partials(df: DataFrame, value: str) -> DataFrame:
    """``(partition, total, n)``: the per-partition ``(sum, count)`` partials."""
    v = F.col(value)
    return (df.groupBy(F.spark_partition_id().alias("partition"))
            .agg(F.sum(v).alias("total"), F.count(v).alias("n")))


def partition_average(df: DataFrame, value: str) -> DataFrame:
    """One row ``average``: sum / count of the values as they are, null on empty
    input.  Spark computes the per-partition partials and merges them in one
    aggregate."""
    return df.agg((F.sum(value) / F.count(value)).alias("average"))


def partition_sizes(df: DataFrame, num_partitions: int | None = None,
                    by: Sequence[str] | None = None, place: Column | None = None) -> DataFrame:
    """``(partition, count)`` for every partition, empty ones reported as 0.

    Without ``num_partitions``: the partitions ``df`` has.  With it: those that
    ``df.repartition(num_partitions, *by)`` would have, or, with ``place`` (an
    integer column), those of ``pmod(place, num_partitions)``.  Only counts per
    partition are shuffled; the rows stay where they are.  With ``place`` and ``by`` the
    rows are counted per ``by`` first, so that a costly ``place`` of these columns is
    computed once per distinct key.
    """
    if num_partitions is None:
        n, at = df.rdd.getNumPartitions(), F.spark_partition_id()
    else:
        if place is None and not by:
            raise ValueError("say what rows are placed by")
        n, at = num_partitions, F.pmod(F.hash(*by) if place is None else place, F.lit(num_partitions))
    if place is not None and by:
        per_key = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        sizes = per_key.groupBy(at.cast("int").alias("partition")).agg(F.sum("_n").alias("count"))
    else:
        sizes = df.groupBy(at.cast("int").alias("partition")).agg(F.count(F.lit(1)).alias("count"))
    ids = df.sparkSession.range(n).select(F.col("id").cast("int").alias("partition"))
    return (ids.join(sizes, "partition", "left")
            .select("partition", F.coalesce("count", F.lit(0)).alias("count")))


def collect_values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """All values of ``value`` (per ``by`` key), sorted, with their ``position``
    from 1: the distributed form of a driver-side list accumulator.  The list
    stays a DataFrame."""
    return with_position(df.select(*by, value), [*by, value])


def collection_digest(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Per key: ``n_values``, ``n_distinct``, ``min_value``, ``max_value`` and
    ``sum_value`` (decimal(38,0), exact): a bounded summary that identifies
    the collected multiset without gathering it into one row."""
    # two chained groupings (per distinct value, then per key) instead of a
    # distinct count beside plain aggregates, which Spark would expand
    per_value = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    v = F.col(value)
    present = F.when(v.isNotNull(), F.col("_n")).otherwise(F.lit(0))
    return per_value.groupBy(*by).agg(
        F.sum(present).alias("n_values"), F.count(v).alias("n_distinct"),
        F.min(v).alias("min_value"), F.max(v).alias("max_value"),
        F.sum(v.cast("decimal(38,0)") * F.col("_n")).cast("decimal(38,0)").alias("sum_value"))


def with_position(df: DataFrame, order: Sequence[Column | str], out: str = "position",
                  num_partitions: int | None = None) -> DataFrame:
    """Sort ``df`` by ``order`` and number the rows 1..N in that order.

    Distributed: a range-partitioned sort, then each row's position = rows in
    earlier partitions + its index within its partition.  The per-partition
    counts table has one row per partition, so broadcasting it is bounded by
    the partition count.  The sorted, tagged frame is checkpointed once so
    that counting and numbering see the same rows in the same places.
    """
    checkpoint_dir(df.sparkSession)
    # a row id as last key: range partitioning cannot split equal keys, so a
    # key held by a third of the rows would otherwise fill one partition
    # (ties keep input order, like a stable sort)
    keyed = df.withColumn("_tb", F.monotonically_increasing_id())
    order = [*order, F.col("_tb")]
    sorted_df = (keyed.repartitionByRange(num_partitions, *order) if num_partitions
                 else keyed.repartitionByRange(*order))
    tagged = (sorted_df.sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                        F.min("_mid").alias("_m0"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_m0",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pos = F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1
    return (tagged.join(F.broadcast(offsets), "_pid")
            .select(*df.columns, pos.alias(out)))


def sort_by_string_key(df: DataFrame, key: str, out: str = "position") -> DataFrame:
    """Rows ordered by the decimal text of an integer key (1, 10, 100, 15, 3),
    numbered by ``out``."""
    return with_position(df, [F.col(key).cast("string"), F.col(key)], out)


def sort_by_struct_key(df: DataFrame, fields: Sequence[str], out: str = "position",
                       num_partitions: int | None = None) -> DataFrame:
    """Rows ordered by a composite key (field by field, ascending), numbered.
    ``num_partitions`` fixes the number of range partitions of the result."""
    return with_position(df, [F.col(f) for f in fields], out, num_partitions)


def sort_range_partitioned(df: DataFrame, order: Sequence[str], num_partitions: int) -> DataFrame:
    """Sort into exactly ``num_partitions`` range partitions, each sorted."""
    return df.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order)


def combine_by_key(df: DataFrame, key: str, value: str, create: Callable, merge_value: Callable,
                   merge_combiners: Callable, combiner: str, max_keys: int = 100_000) -> DataFrame:
    """``key`` and the fields of its combiner: an aggregation given by three functions.

    ``create(v)`` makes a combiner of a key's first value, ``merge_value(c, v)`` adds a
    further one, ``merge_combiners(c, d)`` joins two; combiners are tuples whose fields
    ``combiner`` names as a DDL string.  Null values are skipped, a null key is one of its own.

    Values are combined where they are, in Arrow batches, so a task hands on one row per key
    (:func:`combine_partials`; a table of ``max_keys`` keys is handed on and begun anew).
    These are hashed by key, sorted and merged as a stream: no key's rows are held at once.
    The order in which values meet is not defined, so the functions should not depend on it.
    For sums, counts, extremes and averages Spark's own aggregates are faster.
    """
    partials = combine_partials(df, key, value, create, merge_value, combiner, max_keys)
    names = partials.columns

    def merge(batches):
        import pyarrow as pa
        now, held, rows = None, None, []
        for batch in batches:
            schema = batch.schema
            for k, *c in zip(*(col.to_pylist() for col in batch.columns)):
                if held is not None and k == now:
                    held = merge_combiners(held, tuple(c))
                    continue
                if held is not None:
                    rows.append((now, *held))
                now, held = k, tuple(c)
            if len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if held is not None:
            rows.append((now, *held))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    return (partials.repartition(key).sortWithinPartitions(key)
            .mapInArrow(merge, partials.schema).toDF(*names))


def combine_partials(df: DataFrame, key: str, value: str, create: Callable, merge_value: Callable,
                     combiner: str, max_keys: int = 100_000) -> DataFrame:
    """The rows that each task of :func:`combine_by_key` hands on: ``key`` and a combiner of
    its values there."""
    rows = df.select(key, value).where(F.col(value).isNotNull())
    schema = T.StructType([rows.schema[key], *T._parse_datatype_string(combiner).fields])
    arrow_schema = to_arrow_schema(schema)

    def combine(batches):
        import pyarrow as pa
        table: dict = {}

        def hand_on():
            cols = list(zip(*((k, *c) for k, c in table.items())))
            table.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(cols, arrow_schema)], schema=arrow_schema)

        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = table.get(k)
                table[k] = create(v) if held is None else merge_value(held, v)
            if len(table) >= max_keys:
                yield hand_on()
        if table:
            yield hand_on()

    return rows.mapInArrow(combine, schema)
