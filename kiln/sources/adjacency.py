"""Adjacency-list text: ``src,d1,d2,...`` per line.

Every line names a vertex, also without links.  A field that is not a number fails
the job; ``parse_adjacency(..., permissive=True)`` keeps such lines and counts their
bad fields instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fields(lines: DataFrame, col: str) -> DataFrame:
    """The comma-separated fields of each line that has any text, untrimmed."""
    return (lines.where(F.trim(col) != "")
            .select(F.split_part(F.col(col), F.lit(","), F.lit(1)).alias("_s"),
                    F.split(F.col(col), ",", -1).alias("_f")))


def _number(text: Column, permissive: bool = False) -> Column:
    text = F.trim(text)
    number = text.try_cast("bigint")
    if permissive:
        return number
    return F.when(number.isNull(), F.raise_error(F.concat(
        F.lit("not a vertex id in an adjacency list: "), text)).cast("bigint")).otherwise(number)


def parse_adjacency(lines: DataFrame, col: str = "value", permissive: bool = False) -> DataFrame:
    """Lines -> ``(src bigint, links array<bigint>)``, one row per line with text.

    With ``permissive`` also ``malformed``: the number of fields that are not numbers;
    a bad source is null then, a bad link is left out of its list."""
    rest = F.slice("_f", F.lit(2), F.size("_f") - 1)
    links = F.transform(rest, lambda x: _number(x, permissive))
    out = _fields(lines, col).select(_number(F.col("_s"), permissive).alias("src"), links.alias("_l"))
    if not permissive:
        return out.select("src", F.col("_l").alias("links"))
    good = F.filter("_l", lambda x: x.isNotNull())
    return out.select("src", good.alias("links"), (
        F.size("_l") - F.size(good) + F.col("src").isNull().cast("int")).alias("malformed"))


def adjacency_edges(adj: DataFrame) -> DataFrame:
    """``(src, links)`` -> one ``(src, dst)`` row per link.

    Several lines for the same source are merged (their links pooled); a
    destination repeated within or across lines stays a parallel edge.
    """
    return adj.select("src", F.explode("links").alias("dst"))


def edges_from_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines -> ``(src, dst)`` directly, same result as
    ``adjacency_edges(parse_adjacency(lines))``.

    The casts run after the explode as plain column expressions, so the
    whole parse stays in generated code (no per-element lambda).
    """
    rest = F.slice("_f", F.lit(2), F.size("_f") - 1)
    return (_fields(lines, col).select("_s", F.explode(rest).alias("_d"))
            .select(_number(F.col("_s")).alias("src"), _number(F.col("_d")).alias("dst")))


def vertices_from_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``id`` of every line's vertex (once per line), with links or without."""
    return _fields(lines, col).select(_number(F.col("_s")).alias("id"))
