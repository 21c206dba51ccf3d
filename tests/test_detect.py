"""Signature and behaviour rules, precedence, windowed mode."""

import datetime as dt

from pyspark.sql import functions as F

from weblake.operators import detect
from weblake.operators.detect import DetectConfig

SCHEMA = ("timestamp timestamp, log_type string, ip string, method string, page string, "
          "agent string")


def _events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


T0 = dt.datetime(2025, 1, 1, 10, 0, 0)


def test_signature_precedence_and_case(spark):
    rows = [
        (T0, "access", "1", "GET", "/x?q=UNION+SELECT", "a"),     # case-sensitive: no
        (T0, "access", "2", "GET", "/", "Nikto"),                 # case-sensitive: no
        (T0, "access", "3", "GET", "/..%2f", "a"),                # lower-case escape: no
        (T0, "access", "4", "GET", "/xgit/", "a"),                # unescaped dot: scan
        (T0, "access", "5", "GET", "/my--page", "a"),             # double dash: SQLi
        (T0, "access", "6", "GET", "/../wp-admin/'", "sqlmap"),   # SQLi wins
        (T0, "access", "7", "GET", "/wp-admin/../", "sqlmap"),    # traversal beats scan
        (T0, "access", "8", "GET", "/ok", "sqlmap/1.7"),
        (T0, "error", "9", None, None, None),
    ]
    got = {r.ip: r.signature_anomaly_type
           for r in detect.with_signature(_events(spark, rows)).collect()}
    assert got == {"1": None, "2": None, "3": None, "4": "Vulnerability Scan",
                   "5": "SQL Injection", "6": "SQL Injection", "7": "Path Traversal",
                   "8": "Bad User-Agent", "9": None}


def test_case_insensitive_rule(spark):
    rules = (("Bad User-Agent", "agent", r"(nikto)", True),)
    df = detect.with_signature(_events(spark, [(T0, "access", "1", "GET", "/", "Nikto")]), rules)
    assert df.first().signature_anomaly_type == "Bad User-Agent"


def _burst(ip, n, page_fn, method="GET", t=T0):
    return [(t + dt.timedelta(seconds=i), "access", ip, method, page_fn(i), "ua") for i in range(n)]


def test_behaviour_thresholds_and_precedence(spark):
    rows = (
        _burst("login", 11, lambda i: "/login", "POST")          # 11 login posts > 10
        + _burst("scan", 16, lambda i: f"/p{i}")                 # 16 pages > 15, 16 rows
        + _burst("rate", 21, lambda i: "/same")                  # 21 rows > 20
        + _burst("quiet", 20, lambda i: "/same")                 # not > 20
        + _burst("both", 21, lambda i: f"/p{i}")                 # scanning beats rate
        + [(T0, "error", "rate", None, None, None)]              # error row of a flagged ip
    )
    df = _events(spark, rows)
    prof = {r.ip: r for r in detect.behaviour_verdict(detect.behaviour_profile(df)).collect()}
    assert prof["login"].behavioral_anomaly_type == "Login Attack"
    assert prof["scan"].behavioral_anomaly_type == "Scanning Activity"
    assert prof["rate"].behavioral_anomaly_type == "Request Rate Anomaly"
    assert prof["quiet"].behavioral_anomaly_type is None
    assert prof["both"].behavioral_anomaly_type == "Scanning Activity"
    assert prof["rate"].request_count == 21  # error row not counted
    flagged = detect.flag(df)
    err = flagged.filter("log_type = 'error'").first()
    assert (err.anomaly_type, err.is_anomaly) == ("Request Rate Anomaly", 1)
    quiet = flagged.filter("ip = 'quiet'").select("anomaly_type", "is_anomaly").distinct().collect()
    assert [(r.anomaly_type, r.is_anomaly) for r in quiet] == [("", 0)]


def test_signature_wins_over_behaviour(spark):
    rows = _burst("x", 21, lambda i: "/same") + [(T0, "access", "x", "GET", "/a'b", "ua")]
    types = {r.anomaly_type for r in detect.flag(_events(spark, rows)).collect()}
    assert types == {"Request Rate Anomaly", "SQL Injection"}


def test_two_level_distinct_equals_count_distinct(spark):
    rows = [(T0, "access", f"ip{i % 7}", "GET", f"/p{i % 13}", "ua") for i in range(500)]
    df = _events(spark, rows)
    a = {(r.ip, r.distinct_pages) for r in detect.behaviour_profile(df).collect()}
    b = {(r.ip, r.n) for r in df.groupBy("ip").agg(F.count_distinct("page").alias("n")).collect()}
    assert a == b


def test_windowed_verdict_per_window(spark):
    cfg = DetectConfig(mode="windowed", window="1 hour", rate_threshold=3)
    rows = _burst("a", 4, lambda i: "/", t=T0) + _burst("a", 3, lambda i: "/", t=T0 + dt.timedelta(hours=1))
    out = detect.flag(_events(spark, rows), cfg)
    by_hour = {(r.hour, r.anomaly_type) for r in
               out.select(F.hour("timestamp").alias("hour"), "anomaly_type").distinct().collect()}
    assert by_hour == {(10, "Request Rate Anomaly"), (11, "")}


def test_rows_without_a_time_keep_their_place(spark):
    cfg = DetectConfig(mode="windowed", window="1 hour", rate_threshold=3)
    rows = _burst("a", 5, lambda i: "/") + [(None, "access", "a", "GET", "/x", "ua"), (None, "access", "a", "GET", "/a'b", "ua")]
    got = sorted((r.page, r.anomaly_type) for r in detect.flag(_events(spark, rows), cfg).collect())
    assert got == [("/", "Request Rate Anomaly")] * 5 + [("/a'b", "SQL Injection"), ("/x", "")]


def test_window_starts_are_those_of_spark_windows(spark):
    df = _events(spark, [(T0 + dt.timedelta(minutes=17 * i), "access", "a", "GET", "/", "u") for i in range(-200, 200)])
    for window in ("1 hour", "15 minutes", "1 day", "90 seconds"):
        cfg = DetectConfig(window=window)
        assert df.filter(detect.window_start(cfg) != F.window("timestamp", window).start).count() == 0


def test_a_hot_address_is_spread_by_the_plan(spark):
    rows = _burst("hot", 300, lambda i: f"/p{i % 40}") + [(T0, "access", f"ip{i}", "GET", "/", "u") for i in range(600)]
    salted = detect.flag(_events(spark, rows))
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert salted.filter("ip = 'hot' and is_anomaly = 1").count() == 300 and salted.filter("is_anomaly = 1").count() == 300


def test_only_the_verdicts_of_hot_keys_are_repeated(spark, monkeypatch):
    """More than HOT_ROWS rows, error lines and rows without a time included; each row is given back once, as with no hot key."""
    cfg = DetectConfig(mode="windowed", window="1 hour", rate_threshold=3)
    rows = (_burst("hot", 60, lambda i: f"/p{i % 4}") + [(T0, "error", "hot", None, None, None)] * 60 + [(None, "access", "hot", "GET", "/", "u")] * 20
            + [r for k in range(50) for r in _burst(f"ip{k}", 5, lambda i: "/")])
    plain = detect.flag(_events(spark, rows), cfg).collect()
    monkeypatch.setattr(detect, "HOT_ROWS", 100)
    spread = detect.flag(_events(spark, rows), cfg)
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain)) and len(plain) == len(rows)
    assert spread.filter("ip = 'hot' and is_anomaly = 1").count() == 120
    made = []
    explode = F.explode
    monkeypatch.setattr(detect.F, "explode", lambda c: made.append(c) or explode(c))
    detect.flag(_events(spark, rows), cfg)
    parts = spark.createDataFrame([(True,), (None,)], "_hot boolean").select(F.size(made[0]).alias("n")).collect()
    assert [r.n for r in parts] == [detect.SALTS, 1]
