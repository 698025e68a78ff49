"""Web-server log ETL, data-quality checks and reporting.

Pipeline: raw lines (``value``) -> :func:`parse_log` -> :func:`clean_log`
(size filled, time parsed) -> the report operators.  Every report is a
filter or one or two chained groupings, each partial-aggregated before its
shuffle (a hot host, path or day is reduced map-side); distinct counts are
written as a grouping per ``(day, host)`` followed by one per day rather
than a distinct aggregate that Spark would expand.  Top-k reports end in
``orderBy(...).limit(k)``, planned as a per-partition top-k
(``TakeOrderedAndProject``), so no full sort runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.clf import clf_field, clf_time, clf_timestamp

LOG_FIELDS = ("host", "timestamp", "path", "status", "content_size")


def parse_log(lines: DataFrame, col: str = "value", raw: bool = False,
              keep: list[str] | None = None) -> DataFrame:
    """Raw lines -> ``(host, timestamp, path, status int, content_size bigint)``.

    ``raw=True`` keeps the original quirks (host with trailing blank, ``''``
    for a non-matching text field, negative offsets only, sizes as ints).  ``keep`` lists
    input columns to carry along (an id, say).
    """
    line = F.col(col)
    return lines.select(*(keep or []),
                        *[clf_field(line, f, raw).alias(f) for f in LOG_FIELDS])


def malformed_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row ``(lines, malformed)``: how many lines lack a host, time, path or
    status (a missing size is not an error: nothing was sent)."""
    parsed = parse_log(lines, col)
    bad = _any_null(["host", "timestamp", "path", "status"])
    return parsed.agg(F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("malformed"))


def null_gate(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row ``(check, violations, passed)``: are there null input lines?

    The original job stops when a line is null; here the caller decides.
    """
    bad = F.count_if(F.col(col).isNull())
    return lines.agg(F.lit(f"{col}_not_null").alias("check"),
                     bad.alias("violations"), (bad == 0).alias("passed"))


def _any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def rows_with_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows where any of ``cols`` (default: all columns) is null."""
    return df.where(_any_null(list(cols or df.columns)))


def count_rows_with_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row ``rows_with_nulls``: how many rows have a null in ``cols``."""
    return df.agg(F.count_if(_any_null(list(cols or df.columns))).alias("rows_with_nulls"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row, one column per input column: its number of nulls (0, not null,
    on an empty table)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in (cols or df.columns)])


def invalid_size_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Raw lines that do not end in a digit (no usable content size)."""
    return lines.where(~F.col(col).rlike(r"\d+$"))


def fill_size(df: DataFrame, col: str = "content_size", value: int = 0) -> DataFrame:
    """Missing content size -> ``value`` (a ``-`` size means nothing was sent)."""
    return df.na.fill(value, [col])


def parse_time(df: DataFrame, col: str = "timestamp", out: str = "time",
               keep_timestamp: bool = False, utc: bool = False) -> DataFrame:
    """Replace the CLF time text by its date (last column).

    The date is the one in the session time zone, or in UTC with
    ``utc=True``.  ``keep_timestamp=True`` also keeps the full instant as
    ``ts``.  An unparsable time gives null instead of failing the job.
    """
    extra = [clf_timestamp(F.col(col)).alias("ts")] if keep_timestamp else []
    return df.select(*[c for c in df.columns if c != col], *extra,
                     clf_time(F.col(col), utc).alias(out))


def clean_log(parsed: DataFrame, keep_timestamp: bool = False, utc: bool = False) -> DataFrame:
    """Parsed log -> cleaned log: size filled with 0, time parsed to a date."""
    return parse_time(fill_size(parsed), keep_timestamp=keep_timestamp, utc=utc)


def size_stats(logs: DataFrame, col: str = "content_size") -> DataFrame:
    """Typed summary of the content size: count, mean, stddev, min, max."""
    c = F.col(col)
    return logs.agg(F.count(c).alias("n"), F.avg(c).alias("mean"),
                    F.stddev_samp(c).alias("stddev"), F.min(c).alias("min"),
                    F.max(c).alias("max"))


def status_counts(logs: DataFrame) -> DataFrame:
    """``(status, count)`` sorted by status, null status first."""
    return (logs.groupBy("status").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("status").asc_nulls_first()))


def frequent_hosts(logs: DataFrame, min_count: int = 10) -> DataFrame:
    """Hosts with more than ``min_count`` requests."""
    return (logs.groupBy("host").agg(F.count(F.lit(1)).alias("count"))
            .where(F.col("count") > min_count).select("host"))


def top_counts(df: DataFrame, key: str, k: int) -> DataFrame:
    """``(key, count)``: the ``k`` most frequent keys, ties broken by key."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(key).asc_nulls_first()).limit(k))


def top_error_paths(logs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` paths most often answered with a status other than 200
    (a null status is neither 200 nor other)."""
    return top_counts(logs.where("status != 200"), "path", k)


def unique_hosts(logs: DataFrame) -> DataFrame:
    """One row ``unique_hosts``: distinct hosts, a null host counted as one
    (as ``distinct().count()`` counts it)."""
    return logs.select("host").distinct().agg(F.count(F.lit(1)).alias("unique_hosts"))


def _day(time_col: str, grain: str) -> Column:
    if grain == "day":
        return F.dayofmonth(time_col)
    if grain == "date":
        return F.col(time_col)
    raise ValueError("grain must be 'day' (day of month) or 'date'")


def _per_day_host(logs: DataFrame, grain: str) -> DataFrame:
    """``(day, host, n)``: requests per day and host (null host is a host).
    Both groupings of the daily reports start from this one; it is
    partial-aggregated before its shuffle, so a hot host or day is reduced
    map-side."""
    return logs.groupBy(_day("time", grain).alias("day"), "host").agg(
        F.count(F.lit(1)).alias("n"))


def daily_unique_hosts(logs: DataFrame, grain: str = "day") -> DataFrame:
    """``(day, unique_count)`` sorted by day.

    ``grain='day'`` groups by day of month as the original job does (two
    months merge); ``grain='date'`` groups by calendar date.
    """
    return (_per_day_host(logs, grain).groupBy("day")
            .agg(F.count(F.lit(1)).alias("unique_count"))
            .orderBy(F.col("day").asc_nulls_first()))


def daily_requests(logs: DataFrame, grain: str = "day") -> DataFrame:
    """``(day, count)`` sorted by day."""
    return (logs.groupBy(_day("time", grain).alias("day"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("day").asc_nulls_first()))


def daily_avg_requests_per_host(logs: DataFrame, grain: str = "day") -> DataFrame:
    """``(day, avg_count)`` = requests / distinct hosts per day, sorted.

    The original joins two grouped tables on ``day``; both come from the
    per-(day, host) counts, so here it is two chained groupings and no join.
    Days with a null date drop out as they do in the join.  That test is
    made on the aggregated rows (one flag per day): a filter on ``day``
    itself would be pushed below the parse's input shuffle and make the
    parse run twice, once of them single-threaded.
    """
    daily = (_per_day_host(logs, grain).groupBy("day")
             .agg((F.sum("n") / F.count(F.lit(1))).alias("avg_count"),
                  F.max(F.col("day").isNull()).alias("_no_day")))
    return daily.where(~F.col("_no_day")).select("day", "avg_count").orderBy("day")


def not_found(logs: DataFrame) -> DataFrame:
    """Requests answered with 404."""
    return logs.where("status = 404")


def distinct_paths(logs: DataFrame, n: int = 40) -> DataFrame:
    """Up to ``n`` distinct paths (the first ``n`` in path order)."""
    return logs.select("path").distinct().orderBy(F.col("path").asc_nulls_first()).limit(n)


def top_paths(logs: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most frequent paths."""
    return top_counts(logs, "path", k)


def top_hosts(logs: DataFrame, k: int = 25) -> DataFrame:
    """The ``k`` most frequent hosts."""
    return top_counts(logs, "host", k)
