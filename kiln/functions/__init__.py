"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from kiln.functions.clf import (CLF_TIME_FORMAT, clf_field, clf_time,
                                clf_timestamp)
from kiln.functions.text import java_split_words, split_lines
from kiln.functions.buckets import md5_bucket

__all__ = ["CLF_TIME_FORMAT", "clf_field", "clf_time", "clf_timestamp",
           "java_split_words", "split_lines", "md5_bucket"]
