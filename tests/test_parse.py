"""Golden lines and properties of the parser (access, error, quarantine)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import lines_df
from weblake.operators import detect, parse
from weblake.operators.detect import DAILY_TEST

TS = "[28/Oct/2025:10:00:00 +0000]"


def _parsed(spark, rows):
    df = parse.parse_lines(lines_df(spark, rows))
    return [r.asDict() for r in df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).collect()]


def test_access_golden(spark):
    r = _parsed(spark, [("access", f'1.1.1.1 - - {TS} "GET /cart HTTP/1.1" 200 5 "http://r/" "UA"')])
    assert len(r) == 1
    r = r[0]
    assert (r["ip"], r["method"], r["page"], r["request"], r["status"], r["bytes"]) == (
        "1.1.1.1", "GET", "/cart", "/cart", 200, 5)
    assert (r["referrer"], r["agent"], r["log_type"]) == ("http://r/", "UA", "access")
    assert r["timestamp"] == dt.datetime(2025, 10, 28, 10, 0, 0)
    assert r["log_level"] is None and r["error_message"] is None


def test_access_without_protocol_parses(spark):
    r = _parsed(spark, [("access", f'1.1.1.1 - - {TS} "GET /" 200 1 "r" "UA"')])
    assert [(x["method"], x["page"], x["status"], x["bytes"]) for x in r] == [("GET", "/", 200, 1)]


def test_offset_converted_to_utc(spark):
    r = _parsed(spark, [("access", '1.1.1.1 - - [28/Oct/2025:10:00:00 +0300] "GET / HTTP/1.1" 200 1 "r" "UA"')])
    assert r[0]["timestamp"] == dt.datetime(2025, 10, 28, 7, 0, 0)


def test_quarantine_cases(spark):
    bad = [
        ("access", f'11.22.33.44 - - {TS} "POST /products?id=\' OR 1=1-- HTTP/1.1" 500 5 "r" "UA"'),
        ("access", f'1.1.1.1 - - {TS} "GET / HTTP/1.1" 200 - "r" "UA"'),
        ("access", f'1.1.1.1 - bob {TS} "GET / HTTP/1.1" 200 1 "r" "UA"'),
        ("error", '2025/10/28 10:00:00 [error] 29#29: *1 open() "/x" failed (...), client: 9.9.9.9, '
                  'server: localhost, request: "GET /x HTTP/1.1", host: "localhost:8080"'),
        ("error", '2025/10/28 10:00:00 [error] 1#1: *1 x\nclient: 9.9.9.9, server: localhost, '
                  'request: "GET /x HTTP/1.1", m, host: "localhost:8080"'),
    ]
    good = [
        ("access", f'55.66.77.88 - - {TS} "GET /static/../../../../etc/passwd HTTP/1.1" 403 1 "r" "UA"'),
        ("access", f'11.22.33.44 - - {TS} "POST /p?id=1\'-- HTTP/1.1" 500 5 "r" "UA"'),
    ]
    df = lines_df(spark, bad + good)
    assert parse.parse_lines(df).count() == len(good)
    q = {(r.log_type, r.message) for r in parse.quarantine(df).collect()}
    assert q == set(bad)


def test_error_golden(spark):
    line = ('2025/10/28 10:00:00 [error] 12345#12345: *6789 client: 9.9.9.9, server: localhost, '
            'request: "GET /x HTTP/1.1", open() "/f" failed (2: No such file or directory), '
            'host: "localhost:8080"')
    r = _parsed(spark, [("error", line)])[0]
    assert (r["log_level"], r["ip"], r["log_type"]) == ("error", "9.9.9.9", "error")
    assert r["error_message"] == 'open() "/f" failed (2: No such file or directory)'
    assert r["timestamp"] == dt.datetime(2025, 10, 28, 10, 0, 0)
    assert r["status"] is None and r["page"] is None


def test_separator_in_line_takes_exact_path(spark):
    line = f'1.1.1.1 - - {TS} "GET /a\u0001b HTTP/1.1" 200 7 "r" "U\u0001A"'
    r = _parsed(spark, [("access", line)])[0]
    assert (r["page"], r["agent"], r["bytes"]) == ("/a\u0001b", "U\u0001A", 7)


def test_unknown_types_null_messages_and_oversize_are_quarantined(spark):
    good = f'1.1.1.1 - - {TS} "GET /cart HTTP/1.1" 200 5 "r" "UA"'
    rows = [("other", "x"), (None, "y"), ("access", None), ("error", None), (None, None), ("access", good + " " * 100), ("access", "\u0001" * 200)]
    df = lines_df(spark, rows)
    assert parse.parse_lines(df.filter("log_type is null or log_type = 'other' or message is null")).count() == 0
    got = sorted(((r.log_type, r.message) for r in parse.quarantine(df, max_bytes=100).collect()), key=str)
    assert got == sorted(rows, key=str)
    assert parse.all_events(df, keep=("message",)).count() == len(rows)


def test_input_is_scanned_once(spark):
    plan = parse.parse_lines(spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("event_type AS log_type", "props AS message"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


dates = st.one_of(st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2090, 1, 1)).map(lambda d: (d.strftime("%d/%b/%Y:%H:%M:%S"), d.replace(microsecond=0))),
                  st.sampled_from([("99/Foo/2025:10:00:00", None), ("28/Oct/2025:25:00:00", None)]))
token = st.text(alphabet=st.characters(min_codepoint=33, max_codepoint=126, exclude_characters='"'),
                min_size=1, max_size=12)


@settings(max_examples=25, deadline=None)
@given(rows=st.lists(st.tuples(
    st.from_regex(r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", fullmatch=True),
    st.sampled_from(["GET", "POST", "PUT"]), token, st.integers(100, 599), st.integers(0, 10**9),
    token, token, dates), min_size=1, max_size=8))
def test_roundtrip_property(spark, rows):
    """parse(format(row)) == row for requests without spaces; parsed + quarantined == input."""
    msgs = [("access", f'{ip} - - [{d[0]} +0000] "{m} {p} HTTP/1.1" {s} {b} "{ref}" "{ag}"')
            for ip, m, p, s, b, ref, ag, d in rows]
    df = lines_df(spark, msgs)
    got = sorted(((r.ip, r.method, r.page, r.status, r.bytes, r.referrer, r.agent, r.t)
                  for r in parse.parse_lines(df).withColumn("t", F.col("timestamp").cast("timestamp_ntz")).collect()), key=repr)
    assert got == sorted(((*r[:-1], r[-1][1]) for r in rows), key=repr)
    kept = parse.parse_lines(df)
    assert detect.flag(kept, DAILY_TEST).count() == len(rows) == detect.flag(kept).count()
    assert parse.quarantine(df).count() == 0
