"""Common Log Format field extraction and time parsing.

Each field is one ``regexp_extract`` over the raw line (no match gives ``''``,
never null) followed by ANSI-safe casts: ``try_cast`` and ``try_to_timestamp``
turn unparsable text into null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the log-line patterns and time format to match -----------
# host, timestamp, path, status, content size (group 1 of each), as written
# for the original job; the timestamp pattern accepts only "-dddd" offsets.
HOST_PATTERN = r"^([^\s]+\s)"
TIMESTAMP_PATTERN = r"^.*\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} -\d{4}).*\]"
PATH_PATTERN = r"^.*\"\w+\s+([^\s]+)\s+HTTP.*\""
STATUS_PATTERN = r"^.*\"\s+([^\s]+)"
CONTENT_SIZE_PATTERN = r"^.*\s+(\d+)$"
CLF_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
# ---------------------------------------------------------------------------

# Fixed form of the timestamp pattern: offsets of either sign.
TIMESTAMP_PATTERN_ANY_OFFSET = r"^.*\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [-+]\d{4}).*\]"

_PATTERNS = {
    "host": HOST_PATTERN,
    "timestamp": TIMESTAMP_PATTERN,
    "path": PATH_PATTERN,
    "status": STATUS_PATTERN,
    "content_size": CONTENT_SIZE_PATTERN,
}


def clf_field(line: Column, field: str, raw: bool = False) -> Column:
    """One parsed field of a log line.

    ``raw=True`` returns what the original job returned: host with its
    trailing blank, ``''`` for a text field that does not match, only
    negative offsets in the timestamp.  The default trims the host, accepts
    either offset sign and turns ``''`` into null, so that the null checks
    see malformed lines.  ``status`` is an int; ``content_size`` is a bigint, in
    raw mode an int (null when empty or out of range).
    """
    if field not in _PATTERNS:
        raise ValueError(f"unknown log field {field!r}")
    pattern = _PATTERNS[field]
    if field == "timestamp" and not raw:
        pattern = TIMESTAMP_PATTERN_ANY_OFFSET
    text = F.regexp_extract(line, pattern, 1)
    if field in ("status", "content_size"):
        return text.try_cast("int" if raw or field == "status" else "bigint")
    if raw:
        return text
    if field == "host":
        text = F.regexp_replace(text, r"\s$", "")
    return F.nullif(text, F.lit(""))


def clf_timestamp(ts_text: Column) -> Column:
    """CLF time text (``01/Jul/1995:00:00:01 -0400``) -> timestamp, null if bad."""
    return F.try_to_timestamp(ts_text, F.lit(CLF_TIME_FORMAT))


def clf_time(ts_text: Column, utc: bool = False) -> Column:
    """CLF time text -> calendar date, null if bad.

    The date is taken in the session time zone, or in UTC with ``utc=True``
    (from the epoch seconds, so independent of the session setting).
    """
    ts = clf_timestamp(ts_text)
    if utc:
        return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))
    return F.to_date(ts)
