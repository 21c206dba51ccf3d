"""Reports from the ingest's rollups, unique addresses from sketches, latest rows by months."""

import os
import random
from dataclasses import replace

from pyspark.sql import functions as F

from conftest import SF001
from weblake import queries as Q
from weblake.operators.detect import PER_BATCH
from weblake.operators.star import Star
from weblake.plans import forecast, reports as R, rollups
from weblake.plans.filters import Filters
from weblake.plans.ingest import process_batch
from weblake.sources import lake, versions


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _same(a, b):
    return a.dtypes == b.dtypes and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


REPORTS = (R.requests_by_class_per_minute, R.avg_bytes_per_minute, R.status_distribution, R.error_levels_per_minute)


def test_reports_from_rollups_equal_those_from_the_fact(spark, tmpdir_path):
    given = Q._broken_lines(spark, SF001)
    for k in range(3):
        process_batch(given.filter(F.col("event_id") % 3 == k), k, tmpdir_path, Q.ranges(spark, SF001), PER_BATCH)
    star = lake.read_star(spark, tmpdir_path)
    plain = replace(star, rollup=None, sketches=None)
    made = random.Random(4)
    answered = 0
    for k in range(6):
        day = made.randint(1, 25)
        flt = Filters(start=made.choice([None, f"2024-01-{day:02d} 07:{k:02d}:00"]), end=made.choice([None, f"2024-01-{day + 5} 23:10:59", f"2024-01-{day + 5} 23:10:00"]),
                      statuses=made.choice([None, (200, 404)]), methods=made.choice([None, ("GET",)]), countries=("NATION_1", "NATION_2") if k == 5 else None)
        for report in made.sample(REPORTS, 2):
            got = report(star, flt)
            assert _same(got, report(plain, flt)), (report.__name__, flt)
            used = rollups.minutes(star, flt.time_only() if report is R.error_levels_per_minute else flt) is not None
            assert used == ("/fact/" not in _plan(got)), (report.__name__, flt)
            answered += used
    assert answered
    for report in REPORTS:
        assert _same(report(star), report(plain)) and "/fact/" not in _plan(report(star))
    assert _same(forecast.hourly_series(star), forecast.hourly_series(plain))
    assert _same(R.hourly_actuals(star, as_of="2024-01-20 00:00:00"), R.hourly_actuals(plain, as_of="2024-01-20 00:00:00"))
    a, b = R.kpi_summary(star, approx=True).first(), R.kpi_summary(plain).first()
    assert a.total == b.total and abs(a.unique_ips - b.unique_ips) <= 0.05 * b.unique_ips and a[2:] == b[2:]
    assert "/fact/" not in _plan(R.kpi_summary(star, approx=True))
    lake.compact(spark, tmpdir_path, whole=True)
    merged = lake.read_star(spark, tmpdir_path)
    assert len(versions.latest(spark, tmpdir_path).of("rollup")) == len({s.month for s in versions.latest(spark, tmpdir_path).of("fact")})
    assert _same(R.status_distribution(merged), R.status_distribution(plain)) and R.kpi_summary(merged, approx=True).first() == a


def test_fractions_of_a_second_at_the_end_of_a_range(spark):
    events = spark.sql("""SELECT to_timestamp(t) AS timestamp, 'access' AS log_type, 200 AS status, 'GET' AS method, '/' AS page, '/' AS request, 'r' AS referrer, 'a' AS agent, '1.1.1.1' AS ip,
        CAST(1 AS BIGINT) AS bytes, CAST(null AS STRING) AS log_level, CAST(null AS STRING) AS error_message
        FROM VALUES ('2024-01-01 00:00:59'), ('2024-01-01 00:00:59.5'), ('2024-01-01 00:01:10'), (null) AS v(t)""")
    star = Star(events, {}, rollups.rollup_of(events))
    count = lambda flt: R.status_distribution(star, flt).first()
    assert count(Filters(end="2024-01-01 00:00:59")).cnt == 1 and count(Filters(end="2024-01-01 00:01:59")).cnt == 3 and count(Filters()).cnt == 4
    assert rollups.minutes(star, Filters(end="2024-01-01 00:00:58")) is None and rollups.minutes(star, Filters(start="yesterday")) is None


def test_unique_addresses_of_ranges_cut_anywhere(spark):
    events = spark.range(150_000).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 2).alias("timestamp"), F.lit("access").alias("log_type"),
                                         F.concat(F.lit("a"), F.pmod(F.xxhash64("id"), F.lit(40_000))).alias("ip")).withColumn("ip_id", F.xxhash64("ip")).cache()
    parts = [rollups.sketches_of(events.filter(F.pmod(F.xxhash64("ip"), F.lit(5)) == k)).withColumn("batch_id", F.lit(k)) for k in range(5)]
    one = parts[0].unionByName(parts[3]).unionByName(parts[1]).unionByName(rollups.merged_sketches(parts[4].unionByName(parts[2])).select(parts[0].columns))
    star = Star(events.withColumn("event_month", F.date_format("timestamp", "yyyyMM")), {}, sketches=one)
    whole = replace(star, sketches=rollups.sketches_of(events))
    for start, end in ((None, None), ("2024-01-01 03:17:05", "2024-01-02 22:59:59"), ("2024-01-01 05:00:00", None), (None, "2024-01-01 04:00:00"), ("2024-01-01 05:10:00", "2024-01-01 05:20:00"), ("2024-01-01 05:10:00", "2024-01-01 06:20:00")):
        flt = Filters(start, end)
        found = rollups.unique_addresses(star, flt).first().unique_ips
        exact = R.apply(events, flt.time_predicates()).select("ip").distinct().count()
        assert abs(found - exact) <= 5 * 0.016 * exact, (flt, found, exact)
        assert rollups.unique_addresses(whole, flt).first().unique_ips == found  # the order of merges does not matter
    events.unpersist()


def _lines(spark):
    """Error lines of 14 months, few in some; ties over a month's edge, lines without a time."""
    times = [f"2023/{m:02d}/{d:02d} 10:00:00" for m in range(1, 13) for d in range(1, 1 + (9 if m % 5 == 0 else m % 3))]
    times += ["2024/01/31 23:59:59"] * 4 + ["2024/02/01 00:00:00"] * 3 + ["2024/02/31 00:00:00"] * 2
    rows = [("error", f'{t} [error] 1#1: *1 client: 9.9.9.{k % 7}, server: s, request: "GET /x HTTP/1.1", message {k}, host: "h"') for k, t in enumerate(times)]
    return spark.createDataFrame([(m, t) for t, m in rows], "message string, log_type string")


def test_latest_rows_read_the_months_they_need(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    process_batch(_lines(spark), 0, root, Q.ranges(spark, SF001), PER_BATCH)
    star = lake.read_star(spark, root)
    plain = replace(star, months=())
    assert len(star.months) == 14 - sum(m % 5 and not m % 3 for m in range(1, 13)) and star.fact.filter("timestamp IS NULL").count() == 2
    for n in (1, 3, 5, 7, 9, 30, 1000):
        assert R.recent_errors(star, n=n).collect() == R.recent_errors(plain, n=n).collect()
    flt = Filters(start="2023-03-01 00:00:00", end="2023-11-30 00:00:00")
    assert R.recent_errors(star, flt, n=4).collect() == R.recent_errors(plain, flt, n=4).collect()
    few = _plan(R.recent_errors(star, n=3))
    assert few.count("(event_month#") and "event_month" in few and "202402" in few and "202402" not in _plan(R.recent_errors(plain, n=3))
    assert R.time_bounds(star).collect() == R.time_bounds(plain).collect()
