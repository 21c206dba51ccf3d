"""Star schema in the lake: replay safety, unique dims, plans; streaming equals batch."""

import os

from pyspark.sql import functions as F

from conftest import SF001
from weblake import queries as Q
from weblake.operators import detect, parse
from weblake.operators.detect import DAILY_TEST, PER_BATCH
from weblake.operators.star import DIMS
from weblake.plans import reports as R
from weblake.plans.filters import Filters
from weblake.plans.ingest import process_batch
from weblake.schemas import QUARANTINE_SCHEMA
from weblake.sources import envelope, lake, versions
from weblake.streaming import job


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_written_twice_counts_once(spark, tmpdir_path):
    lines = Q.lines(spark, SF001)
    ranges = Q.ranges(spark, SF001)
    for _ in range(2):
        process_batch(lines, 7, tmpdir_path, ranges, PER_BATCH)
    st = lake.read_star(spark, tmpdir_path)
    assert st.fact.count() == 987
    assert lake.read_table(spark, tmpdir_path, "quarantine", QUARANTINE_SCHEMA).count() == 13
    for name, d in DIMS.items():
        raw = lake.read_table(spark, tmpdir_path, name, d.schema)
        assert raw.count() == raw.select(d.id_col).distinct().count(), name


def test_star_join_equals_flagged_events(spark, tmpdir_path):
    process_batch(Q.lines(spark, SF001), 0, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST)
    st = lake.read_star(spark, tmpdir_path)
    cols = ["timestamp", "log_type", "ip", "page", "method", "agent", "status", "bytes",
            "log_level", "error_message", "is_anomaly"]
    star_rows = st.joined().select(*cols, F.coalesce("anomaly_type", F.lit("")).alias("t"))
    flagged = detect.flag(Q.events(spark, SF001), DAILY_TEST).select(*cols, F.col("anomaly_type").alias("t"))
    assert star_rows.exceptAll(flagged).count() == 0
    assert flagged.exceptAll(star_rows).count() == 0
    # every fact id resolves to exactly one dim row
    for name, d in DIMS.items():
        refs = st.fact.filter(F.col(d.id_col).isNotNull())
        assert refs.join(st.dim(name), d.id_col, "left_anti").count() == 0, name


def test_time_filter_prunes_months_and_top_pages_joins_one_dim(spark, tmpdir_path):
    process_batch(Q.lines(spark, SF001), 0, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST)
    st = lake.read_star(spark, tmpdir_path)
    flt = Filters(start="2024-01-02 00:00:00", end="2024-01-03 00:00:00")
    plan = _plan(R.kpi_summary(st, flt))
    assert "PartitionFilters: [isnotnull(event_month" in plan
    top = R.top_pages(st)
    plan = _plan(top)
    assert "dim_request" in plan and "dim_ip" not in plan and "dim_user_agent" not in plan
    # the fact is aggregated by request id before the dim joins
    assert top.count() == 10


def test_lake_reports_equal_in_memory_star(spark, tmpdir_path):
    process_batch(Q.lines(spark, SF001), 0, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST)
    stored = lake.read_star(spark, tmpdir_path)
    mem = Q.star_in_memory(spark, SF001)
    for f in (R.kpi_summary, R.top_pages, R.anomaly_by_type, R.top_error_messages):
        a, b = f(stored), f(mem)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, f.__name__


def _write_envelope_files(spark, path, n_files=3):
    """Replay files in time order, as a log shipper produces them: one file
    per time slice, written one after another (the file source reads files
    in modification-time order; out-of-order files lose rows to the watermark)."""
    import time

    lines = Q.lines(spark, SF001)
    qs = [i / n_files for i in range(1, n_files)]
    edges = list(lines.select(F.percentile_approx("ts", qs)).first()[0]) if qs else []
    bounds = [None, *edges, None]
    for i in range(n_files):
        part = lines
        if bounds[i] is not None:
            part = part.filter(F.col("ts") >= F.lit(bounds[i]))
        if bounds[i + 1] is not None:
            part = part.filter(F.col("ts") < F.lit(bounds[i + 1]))
        envelope.encode(part.orderBy("ts").coalesce(1)).write.mode("append").text(path)
        time.sleep(0.05)


def test_stream_ingest_equals_batch_and_restart_adds_nothing(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    _write_envelope_files(spark, src)
    root, ckpt = os.path.join(tmpdir_path, "lake"), os.path.join(tmpdir_path, "ckpt")
    for _ in range(2):  # second start: offsets are checkpointed, nothing new
        q = job.start_ingest(job.envelope_file_stream(spark, src, max_files_per_trigger=1), root, ckpt,
                             Q.ranges(spark, SF001), PER_BATCH, trigger="availableNow")
        q.awaitTermination()
        st = lake.read_star(spark, root)
        assert st.fact.count() == 987
        assert spark.read.parquet(os.path.join(root, "quarantine")).count() == 13
    batch = Q.star_in_memory(spark, SF001)
    for name in ("dim_ip", "dim_request", "dim_user_agent", "dim_error_details"):
        cols = [*DIMS[name].keys, *DIMS[name].attrs]
        a, b = st.dim(name).select(*cols), batch.dim(name).select(*cols)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert st.fact.select("batch_id").distinct().count() == 3


def test_windowed_verdicts_stream_equals_batch_for_closed_windows(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    _write_envelope_files(spark, src, n_files=5)
    out, ckpt = os.path.join(tmpdir_path, "verdicts"), os.path.join(tmpdir_path, "ckpt")
    events = job.parsed_stream(job.envelope_file_stream(spark, src, max_files_per_trigger=1))
    q = job.start_verdicts(events, out, ckpt, DAILY_TEST, watermark="1 hour", trigger="availableNow")
    q.awaitTermination()
    streamed = spark.read.parquet(out)
    batch = detect.behaviour_verdict(detect.behaviour_profile(Q.events(spark, SF001), DAILY_TEST),
                                     DAILY_TEST)
    last = batch.agg(F.max("window_start")).first()[0]
    assert streamed.count() > 0
    closed = batch.filter(F.col("window_start") < F.lit(last))
    cols = ["window_start", "ip", "request_count", "distinct_pages", "login_posts",
            "behavioral_anomaly_type"]
    s, b = streamed.select(*cols), closed.select(*cols)
    assert s.filter(F.col("window_start") < F.lit(last)).exceptAll(b).count() == 0
    assert b.exceptAll(s).count() == 0


def test_empty_batch_is_skipped(spark, tmpdir_path):
    empty = spark.createDataFrame([], "message string, log_type string")
    r = process_batch(empty, 1, tmpdir_path, Q.ranges(spark, SF001), PER_BATCH)
    assert r.skipped and not os.path.exists(os.path.join(tmpdir_path, "fact"))
    assert parse.parse_lines(empty).count() == 0


def test_dims_of_several_writers_are_unique_and_newest(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "lake")
    old = Q.ranges(spark, SF001)
    new = old.withColumn("country", F.concat("country", F.lit("_NEW")))
    for batch, geo_rows in ((0, old), (5, new), (5, new)):  # the last one is a replay
        process_batch(Q.lines(spark, SF001), batch, root, geo_rows, PER_BATCH)
    st = lake.read_star(spark, root)
    for name, d in DIMS.items():
        assert st.dim(name).count() == st.dim(name).select(d.id_col).distinct().count(), name
    assert st.dim("dim_ip").filter("country != 'Unknown' and country not like '%_NEW'").count() == 0
    assert st.joined().count() == st.fact.count() == 2 * 987
    before = {name: st.dim(name).collect() for name in DIMS}
    lake.compact(spark, root, fanout=2)
    now = versions.latest(spark, root)
    for name, d in DIMS.items():
        assert len(now.of(name)) == 1 and lake.read_table(spark, root, name, d.schema).count() == len(before[name])
        assert sorted(lake.read_dim(spark, root, name).collect()) == sorted(before[name])


def test_writing_a_dim_does_not_read_it(spark, tmpdir_path, monkeypatch):
    process_batch(Q.lines(spark, SF001), 0, tmpdir_path, Q.ranges(spark, SF001), PER_BATCH)
    monkeypatch.setattr(lake, "read_segments", None)
    process_batch(Q.lines(spark, SF001), 1, tmpdir_path, Q.ranges(spark, SF001), PER_BATCH)


FACT = [f.name for f in lake.FACT_SCHEMA.fields]


def _rows(spark, root, version=None):
    fact = lake.read_star(spark, root, version=version).joined().select("timestamp", "log_type", "ip", "page", "status", "error_message", "batch_id")
    return sorted(map(repr, fact.collect()))


def test_many_batches_compact_into_few_segments_and_replays_stay_replays(spark, tmpdir_path):
    """200 batches of the fact and a dim, merged in between; a batch that is merged and one that is not are published again."""
    lines = Q.events(spark, SF001).withColumn("is_anomaly", F.lit(0)).withColumn("anomaly_type", F.lit(""))
    star = Q.star_mod.Star.build(lines, Q.ranges(spark, SF001))
    fact, dim = star.fact.cache(), star.dim("dim_ip").cache()

    own = fact.withColumn("batch_id", F.pmod(F.xxhash64(*fact.columns), F.lit(200)))
    # what 200 writers leave, by one job: a folder for each batch and month
    own.withColumn("at", F.col("batch_id")).coalesce(1).write.partitionBy("at", "event_month").parquet(os.path.join(tmpdir_path, "fact"))

    def batch(k, again=False):
        if again:
            new = lake.write_fact(own.filter(F.col("batch_id") == k), tmpdir_path, k)
        else:
            folder = os.path.join(tmpdir_path, f"fact/at={k}")
            new = [versions.Segment("fact", f"fact/at={k}/{m}", m[-6:], ((k, k),)) for m in (os.listdir(folder) if os.path.exists(folder) else [])]
        if k % 50 == 0:
            new += lake.write_dim(dim.coalesce(1), "dim_ip", tmpdir_path, k)
        lake.publish_batch(spark, tmpdir_path, k, new)

    for k in range(200):
        batch(k)
        if k % 100 == 99:
            lake.compact(spark, tmpdir_path, up_to_batch=k - 10)
    def rows():
        return lake.read_table(spark, tmpdir_path, "fact", lake.FACT_SCHEMA).select(*FACT[:-1])
    assert rows().exceptAll(fact).count() == 0 == fact.exceptAll(rows()).count()
    now = versions.latest(spark, tmpdir_path)
    merged, loose = (next(s for s in now.of("fact") if bool(s.level) == m) for m in (True, False))
    months = fact.select("event_month").distinct().count()
    assert len(now.of("fact")) < 40 * months
    for k in (merged.last, loose.last):
        batch(k, again=True)
    assert rows().exceptAll(fact).count() == 0 == fact.exceptAll(rows()).count()
    lake.compact(spark, tmpdir_path, whole=True)
    now = versions.latest(spark, tmpdir_path)
    assert rows().count() == fact.count() and len(now.of("fact")) == months and len(now.of("dim_ip")) == 1
    held = {r.batch_id for r in own.select("batch_id").distinct().collect()}
    assert all({k for k in range(200) if s.holds(k)} == held for s in now.of("fact"))
    assert versions.vacuum(spark, tmpdir_path, keep=1, older_than=-1) > 200 and versions.numbers(spark, tmpdir_path) == [now.number]
    files = [f for d, _, fs in os.walk(os.path.join(tmpdir_path, "fact")) for f in fs if f.endswith(".parquet")]
    assert rows().count() == fact.count() and len(files) == months
    fact.unpersist(), dim.unpersist()


def test_a_reader_keeps_its_version_through_batches_and_compaction(spark, tmpdir_path):
    for k in range(2):
        process_batch(Q.lines(spark, SF001).filter(F.col("event_id") % 3 == k), k, tmpdir_path, Q.ranges(spark, SF001), PER_BATCH)
    pinned = versions.latest(spark, tmpdir_path)
    old = _rows(spark, tmpdir_path, pinned)
    reader = lake.read_star(spark, tmpdir_path, version=pinned).fact
    process_batch(Q.lines(spark, SF001).filter(F.col("event_id") % 3 == 2), 2, tmpdir_path, Q.ranges(spark, SF001), PER_BATCH)
    new = _rows(spark, tmpdir_path)
    lake.compact(spark, tmpdir_path, fanout=2)
    assert reader.count() == len(old) < len(new) and _rows(spark, tmpdir_path, pinned) == old
    assert _rows(spark, tmpdir_path) == new and versions.at(spark, tmpdir_path, pinned.number) == pinned


def test_two_writers_and_a_dead_one(spark, tmpdir_path, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor

    from weblake.sources import fs

    def put(k):
        versions.publish(spark, tmpdir_path, versions.batch_change(k, [versions.Segment("t", f"t/at={k}", None, ((k, k),))]))

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(put, range(24)))
    now = versions.latest(spark, tmpdir_path)
    assert now.number == 24 and {s.last for s in now.segments} == set(range(24))
    assert fs.create(spark, versions._path(tmpdir_path, 25), "{}")  # died before the mark
    monkeypatch.setattr(versions, "GRACE", 0.0)
    put(99)
    assert versions.latest(spark, tmpdir_path).number == 26 and versions.at(spark, tmpdir_path, 25) is None
    old = list(versions.latest(spark, tmpdir_path).segments[:2])
    put(old[0].last)
    replaced = [versions.Segment("t", "t/at=other", None, ((0, 0),))]
    versions.publish(spark, tmpdir_path, versions.batch_change(old[0].last, replaced))
    try:
        versions.publish(spark, tmpdir_path, versions.merge_change(old, []))
        raise AssertionError("a merge of a replaced segment was published")
    except versions.Conflict:
        pass


def test_reports_on_an_empty_lake_are_empty(spark, tmpdir_path):
    st = lake.read_star(spark, os.path.join(tmpdir_path, "nothing"))
    kpi = R.kpi_summary(st).first()
    assert (kpi.total, kpi.unique_ips, kpi.avg_bytes, kpi.server_error_rate, kpi.client_error_rate) == (0, 0, 0.0, 0.0, 0.0)
    assert R.kpi_summary(st, approx=True).first() == kpi
    for report in (R.top_pages, R.error_heatmap, R.anomaly_summary, R.recent_errors, R.hourly_actuals, R.error_levels_per_minute):
        assert report(st).collect() == []
    assert lake.read_predictions(spark, tmpdir_path).collect() == []


def test_cut_windows_give_the_verdicts_of_the_whole(spark, tmpdir_path):
    whole = detect.flag(Q.events(spark, SF001), DAILY_TEST).select("timestamp", "ip", "page", "is_anomaly", "anomaly_type")
    for k in range(3):
        part = Q.lines(spark, SF001).filter(F.col("event_id") % 3 == k)
        for _ in range(2):  # each batch twice: a replay changes nothing
            process_batch(part, k, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST, whole=False)
    st = lake.read_star(spark, tmpdir_path, DAILY_TEST)
    got = st.joined(["dim_ip", "dim_request", "dim_anomaly_type"]).select("timestamp", "ip", "page", "is_anomaly", F.coalesce("anomaly_type", F.lit("")).alias("anomaly_type"))
    assert got.exceptAll(whole).count() == 0 == whole.exceptAll(got).count()
    assert R.anomaly_by_type(st).exceptAll(whole.filter("is_anomaly = 1").groupBy("anomaly_type").agg(F.count("*").alias("cnt"))).count() == 0


def test_late_cut_and_compacted_windows_give_the_verdicts_of_the_whole(spark, tmpdir_path):
    """Batches out of order, each row's window cut into five, verdicts and counts merged in between, one batch replayed."""
    whole = detect.flag(Q.events(spark, SF001), DAILY_TEST).select("timestamp", "ip", "page", "is_anomaly", "anomaly_type")
    for k in (3, 0, 4, 1, 1, 2):
        process_batch(Q.lines(spark, SF001).filter(F.col("event_id") % 5 == k), k, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST, whole=False)
        if k in (4, 2):
            lake.compact(spark, tmpdir_path, fanout=2)
    assert process_batch(Q.lines(spark, SF001).filter(F.col("event_id") % 5 == 2), 2, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST, whole=False).skipped
    st = lake.read_star(spark, tmpdir_path, DAILY_TEST)
    got = st.joined(["dim_ip", "dim_request", "dim_anomaly_type"]).select("timestamp", "ip", "page", "is_anomaly", F.coalesce("anomaly_type", F.lit("")).alias("anomaly_type"))
    assert got.exceptAll(whole).count() == 0 == whole.exceptAll(got).count()


def test_a_time_filter_prunes_facts_and_verdicts(spark, tmpdir_path):
    process_batch(Q.lines(spark, SF001), 0, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST, whole=False)
    st = lake.read_star(spark, tmpdir_path, DAILY_TEST)
    plan = _plan(R.anomaly_timeline(st, Filters(start="2024-01-02 00:00:00", end="2024-01-03 00:00:00")))
    scans = [line for line in plan.splitlines() if "FileScan" in line and ("/fact/" in line or "/verdicts/" in line)]
    assert scans and "page_counts" not in plan
    assert all("isnotnull(event_month" in line.replace("PartitionFilters: [", "").replace("#", " ") or "event_month" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


def test_stored_verdicts_are_joined_as_they_are(spark, tmpdir_path):
    """No copies of a verdict per part of its rows: a broadcast would hold them all in every task."""
    process_batch(Q.lines(spark, SF001), 0, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST, whole=False)
    fact = lake.read_star(spark, tmpdir_path, DAILY_TEST).fact
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert "/verdicts/" in _plan(fact) and "explode" not in plan and fact.count() == 987


def test_a_window_over_a_month_edge_is_found_in_both_months(spark, tmpdir_path):
    cfg = detect.DetectConfig(mode="windowed", window="10 days", login_threshold=9, scan_threshold=9, rate_threshold=3)
    days = [("access", f'7.7.7.7 - - [{d} +0000] "GET /a HTTP/1.1" 200 1 "r" "UA"') for d in ("30/Jan/2024:10:00:00", "31/Jan/2024:10:00:00", "01/Feb/2024:01:00:00", "01/Feb/2024:02:00:00", "09/Feb/2024:02:00:00")]
    for k, (t, m) in enumerate(days):
        process_batch(spark.createDataFrame([(m, t)], "message string, log_type string"), k, tmpdir_path, Q.ranges(spark, SF001), cfg, whole=False)
    fact = lake.read_star(spark, tmpdir_path, cfg).fact
    assert sorted((r.event_month, r.is_anomaly) for r in fact.collect()) == [("202401", 1), ("202401", 1), ("202402", 0), ("202402", 1), ("202402", 1)]


def test_a_backfill_reads_its_input_once(spark, tmpdir_path, monkeypatch):
    seen = []
    own = lake.staged
    monkeypatch.setattr(lake, "staged", lambda df, *a: seen.append(_plan(df)) or own(df, *a))
    written = []
    add = lake.add
    monkeypatch.setattr(lake, "add", lambda df, *a, **k: written.append(_plan(df)) or add(df, *a, **k))
    process_batch(Q.lines(spark, SF001), 0, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST)
    assert len(seen) == 1 and seen[0].count("FileScan") == 1 and "regexp_replace" in seen[0]
    assert len(written) == 9 and not any("events.parquet" in p or "regexp_replace" in p for p in written)


def test_a_backfill_joins_its_verdicts_once(spark, tmpdir_path, monkeypatch):
    """For the fact only, and to ids: the anomaly types are read from the written fact."""
    written = {}
    add = lake.add
    monkeypatch.setattr(lake, "add", lambda df, table, *a, **k: written.update({table: df._jdf.queryExecution().optimizedPlan().toString()}) or add(df, table, *a, **k))
    process_batch(Q.lines(spark, SF001), 0, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST)
    assert [t for t, p in written.items() if "_salt" in p] == ["fact"]
    joins = [line for line in written["fact"].splitlines() if "Project" in line and "_salt" in line and "request_id" in line]
    assert joins and not any("agent#" in line or "referrer#" in line for line in joins)
    st, flagged = lake.read_star(spark, tmpdir_path), detect.flag(Q.events(spark, SF001), DAILY_TEST)
    assert {r[0] for r in st.dim("dim_anomaly_type").select("anomaly_type").collect()} == {r[0] for r in flagged.filter("is_anomaly = 1").select("anomaly_type").distinct().collect()}
    assert st.dim("dim_anomaly_type").filter("anomaly_type_id != xxhash64(anomaly_type)").count() == 0


def test_anomaly_types_need_no_python_worker(spark, tmpdir_path):
    process_batch(Q.lines(spark, SF001), 0, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST)
    from weblake.operators.star import anomaly_types

    fact = lake.read_star(spark, tmpdir_path).fact
    found = anomaly_types(fact)
    assert "ExistingRDD" not in _plan(found) and "Range" in _plan(found)
    assert {r.anomaly_type_id for r in found.collect()} == {r[0] for r in fact.select("anomaly_type_id").distinct().collect()} - {None}
    assert anomaly_types(fact.filter("is_anomaly = 0")).collect() == []


def test_actuals_read_a_bounded_part_of_the_fact(spark, tmpdir_path):
    process_batch(Q.lines(spark, SF001), 0, tmpdir_path, Q.ranges(spark, SF001), DAILY_TEST)
    st = lake.read_star(spark, tmpdir_path)
    last = st.fact.filter("log_type = 'access'").agg(F.max(F.date_trunc("hour", "timestamp"))).first()[0]
    bounded = R.hourly_actuals(st, as_of=last)
    plan = _plan(bounded)
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(event_month" in plan
    assert bounded.exceptAll(R.hourly_actuals(st)).count() == 0 == R.hourly_actuals(st).exceptAll(bounded).count()


def test_windowed_verdicts_approx_mode_runs(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    _write_envelope_files(spark, src, n_files=2)
    events = job.parsed_stream(job.envelope_file_stream(spark, src))
    q = (job.windowed_verdicts(events, DAILY_TEST, watermark="1 hour", approx=True).writeStream
         .format("memory").queryName("approx_verdicts").outputMode("append")
         .option("checkpointLocation", os.path.join(tmpdir_path, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("SELECT count(*) FROM approx_verdicts").first()[0] > 0
