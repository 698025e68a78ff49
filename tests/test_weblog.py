"""Web-log parsing, quality checks and reports on the B1 fixture lines."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st

from kiln.operators import weblog as wl

LINES = [
    'in24.inetnebr.com - - [01/Jul/1995:00:00:01 -0400] "GET /shuttle/a.txt HTTP/1.0" 200 1839',
    'x.y - - [01/Jul/1995:23:00:01 -0400] "GET /b HTTP/1.0" 404 -',
    'x.y - - [01/Jul/1995:23:00:01 +0200] "GET /b" 302 0',
    'garbage',
    '',
    'h - - [01/Jul/1995:00:00:01 -0400] "GET /a"b HTTP/1.0" 200 99999999999',
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(LINES)], "id int, value string")


def rows(df, order="id"):
    return [tuple(r) for r in df.orderBy(order).collect()]


def test_parse_raw_matches_original_job(lines):
    got = rows(wl.parse_log(lines, raw=True, keep=["id"]))
    assert got == [
        (0, "in24.inetnebr.com ", "01/Jul/1995:00:00:01 -0400", "/shuttle/a.txt", 200, 1839),
        (1, "x.y ", "01/Jul/1995:23:00:01 -0400", "/b", 404, None),
        (2, "x.y ", "", "", 302, 0),
        (3, "", "", "", None, None),
        (4, "", "", "", None, None),
        (5, "h ", "01/Jul/1995:00:00:01 -0400", '/a"b', 200, None),
    ]


def test_parse_default_trims_and_nulls(lines):
    got = rows(wl.parse_log(lines, keep=["id"]))
    assert got[0][1] == "in24.inetnebr.com"
    assert got[2][2] == "01/Jul/1995:23:00:01 +0200"     # either offset sign
    assert got[2][3] is None                              # '' -> null
    assert got[3][1:] == (None, None, None, None, None)


def test_raw_quality_counts(lines):
    raw = wl.parse_log(lines, raw=True)
    assert wl.count_rows_with_nulls(raw).first()[0] == 4
    assert wl.rows_with_nulls(raw).count() == 4
    assert wl.rows_with_nulls(raw, ["status"]).count() == 2
    nc = wl.null_counts(raw).first().asDict()
    assert nc == {"host": 0, "timestamp": 0, "path": 0, "status": 2, "content_size": 4}
    assert wl.invalid_size_lines(lines).count() == 3
    sc = {r["status"]: r["count"] for r in wl.status_counts(raw).collect()}
    assert sc == {None: 2, 200: 2, 302: 1, 404: 1}
    assert wl.status_counts(raw).first()["status"] is None    # null first
    assert raw.where("status != 200").count() == 2


def test_null_counts_empty_table_are_zero(spark):
    empty = spark.createDataFrame([], "a string, b int")
    assert tuple(wl.null_counts(empty).first()) == (0, 0)


def test_null_gate(spark, lines):
    assert tuple(wl.null_gate(lines).first()) == ("value_not_null", 0, True)
    bad = spark.createDataFrame([("x",), (None,)], "value string")
    assert tuple(wl.null_gate(bad).first()) == ("value_not_null", 1, False)


def test_clean_parses_time_in_utc(lines):
    clean = wl.clean_log(wl.parse_log(lines, keep=["id"]), keep_timestamp=True)
    got = {r["id"]: (r["ts"], r["time"], r["content_size"]) for r in clean.collect()}
    assert got[1] == (dt.datetime(1995, 7, 2, 3, 0, 1), dt.date(1995, 7, 2), 0)
    assert got[2][0] == dt.datetime(1995, 7, 1, 21, 0, 1)
    assert got[3] == (None, None, 0)
    assert clean.columns[-1] == "time" and "timestamp" not in clean.columns


def test_reports(spark):
    data = [("a", 200, "/x", dt.date(1995, 7, 1)), ("a", 404, "/y", dt.date(1995, 7, 1)),
            ("b", 404, "/y", dt.date(1995, 7, 2)), ("b", 404, "/z", dt.date(1995, 8, 2)),
            (None, 302, "/x", dt.date(1995, 7, 2))]
    logs = spark.createDataFrame(data, "host string, status int, path string, time date")
    assert wl.unique_hosts(logs).first()[0] == 3                 # null counts as one
    assert rows(wl.daily_unique_hosts(logs), "day") == [(1, 1), (2, 2)]   # Jul 2 + Aug 2 merge
    assert rows(wl.daily_unique_hosts(logs, grain="date"), "day") == [
        (dt.date(1995, 7, 1), 1), (dt.date(1995, 7, 2), 2), (dt.date(1995, 8, 2), 1)]
    assert rows(wl.daily_requests(logs), "day") == [(1, 2), (2, 3)]
    assert rows(wl.daily_avg_requests_per_host(logs), "day") == [(1, 2.0), (2, 1.5)]
    nf = wl.not_found(logs)
    assert nf.count() == 3
    assert [tuple(r) for r in wl.top_paths(nf, 1).collect()] == [("/y", 2)]
    assert [tuple(r) for r in wl.top_error_paths(logs, 5).collect()] == [
        ("/y", 2), ("/x", 1), ("/z", 1)]
    assert [r[0] for r in wl.distinct_paths(nf, 40).collect()] == ["/y", "/z"]
    assert [r[0] for r in wl.frequent_hosts(logs, 1).orderBy("host").collect()] == ["a", "b"]
    st_ = wl.size_stats(spark.createDataFrame([(1,), (3,)], "content_size int")).first()
    assert (st_["n"], st_["mean"], st_["min"], st_["max"]) == (2, 2.0, 1, 3)


host_st = st.from_regex(r"[a-z][a-z0-9.\-]{0,20}", fullmatch=True)
path_st = st.from_regex(r"/[A-Za-z0-9_./\-]{0,30}", fullmatch=True)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(host_st, path_st, st.sampled_from([200, 302, 304, 404, 500]),
                          st.integers(0, 2**40),
                          st.datetimes(dt.datetime(1990, 1, 1), dt.datetime(2030, 1, 1)),
                          st.sampled_from(["-0400", "+0000", "+0530"])),
                min_size=1, max_size=8))
def test_parse_inverts_format(spark, recs):
    """parse(format(x)) == x for well-formed lines."""
    lines = [f'{h} - - [{t.strftime("%d/%b/%Y:%H:%M:%S")} {z}] "GET {p} HTTP/1.0" {s} {n}'
             for h, p, s, n, t, z in recs]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "id int, value string")
    got = rows(wl.parse_log(df, keep=["id"]))
    for (h, p, s, n, t, z), g in zip(recs, got):
        assert g[1:] == (h, f'{t.strftime("%d/%b/%Y:%H:%M:%S")} {z}', p, s, n)


def test_utc_day_ignores_session_zone(spark, lines):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        clean = wl.clean_log(wl.parse_log(lines, keep=["id"]), utc=True)
        local = wl.clean_log(wl.parse_log(lines, keep=["id"]))
        got = {r["id"]: r["time"] for r in clean.collect()}
        assert got[1] == dt.date(1995, 7, 2) and got[0] == dt.date(1995, 7, 1)
        assert {r["id"]: r["time"] for r in local.collect()}[1] == dt.date(1995, 7, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_invalid_arguments_are_rejected(spark, lines):
    from kiln.functions.clf import clf_field
    from pyspark.sql import functions as F
    with pytest.raises(ValueError):
        clf_field(F.col("value"), "referrer")
    logs = wl.clean_log(wl.parse_log(lines))
    with pytest.raises(ValueError):
        wl.daily_requests(logs, grain="week")
