"""Deterministic hash buckets that an SQL engine can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bucket(*cols: Column | str, buckets: int = 100) -> Column:
    """``int(first 8 hex digits of md5(c1|c2|...)) % buckets``.

    Unlike ``randomSplit`` the bucket of a row does not depend on the input
    layout, so the same row lands in the same split on every run and in any
    engine with ``md5``.
    """
    key = F.concat_ws("|", *[F.col(c) if isinstance(c, str) else c for c in cols])
    head = F.substring(F.md5(key), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(buckets)).cast("int")
