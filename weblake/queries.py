"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables under ``sf_dir`` (raw lines derived
from `events`; geo blocks and codes from `nation`; `documents`) and runs the
library operator on all of it. Output is normalised for comparison:
timestamps as ``timestamp_ntz`` (UTC wall clock), doubles rounded to 6.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType, TimestampType

from weblake import fixtures
from weblake.fixtures import read_table, read_weblog, weblog_fields
from weblake.operators import detect, geo, parse, star as star_mod
from weblake.operators.detect import DAILY_TEST, PER_BATCH
from weblake.plans import forecast as fc
from weblake.plans import reports as R
from weblake.plans.filters import Filters
from weblake.plans.ingest import ensure_lake, process_batch
from weblake.schemas import QUARANTINE_SCHEMA
from weblake.session import checkpoint_dir, prepare
from weblake.sources import envelope, lake, text

# the star the reports read is flagged with daily windows (see DAILY_TEST)
STAR_CONFIG = DAILY_TEST
TIME_FILTER = Filters(start="2024-01-10 00:00:00", end="2024-01-19 23:59:59")
LIST_FILTER = Filters(start="2024-01-05 00:00:00", end="2024-01-25 23:59:59",
                      statuses=(200, 404), countries=("NATION_1", "NATION_2", "NATION_3"),
                      methods=("GET",))
OVERSIZE_TEST_BYTES = 2_000
PART_TEST_BYTES = 500


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, DoubleType):
            c = F.round(c, 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------ inputs
def lines(spark, d):
    return read_weblog(prepare(spark), d)


def events(spark, d):
    return parse.parse_lines(lines(spark, d))


def ranges(spark, d):
    return fixtures.geo_ranges_from_nation(read_table(spark, d, "nation"))


def codes(spark, d):
    return fixtures.country_codes_from_nation(read_table(spark, d, "nation"))


def star_in_memory(spark, d) -> star_mod.Star:
    """The star as one lazy plan from raw lines (no storage)."""
    return star_mod.Star.build(detect.flag(events(spark, d), STAR_CONFIG), ranges(spark, d))


_STARS: dict[tuple[str, str], star_mod.Star] = {}


def star_root(spark, d) -> str:
    inputs = [f"{d.rstrip('/')}/{t}.parquet" for t in ("events", "nation")]
    return ensure_lake(spark, lambda: lines(spark, d), inputs, lambda: ranges(spark, d), STAR_CONFIG)


def star(spark, d) -> star_mod.Star:
    """The star as the reports see it: written once by the batch ingest job
    (parse, quarantine, flag, dims, fact) and read back from the lake."""
    root = star_root(spark, d)
    key = (spark.sparkContext.applicationId, root)
    if key not in _STARS:  # lazy plans only; the data stays in the lake
        _STARS[key] = lake.read_star(spark, root)
    return _STARS[key]


def series(spark, d):
    return fc.materialise(fc.hourly_series(star(spark, d)))


def prediction(spark, d):
    return fc.forecast_additive(series(spark, d))


# ------------------------------------------------------------ queries
def _natural(name: str):
    d = star_mod.DIMS[name]
    return lambda s, p: star(s, p).dim(name).select(*d.keys, *d.attrs)


def _fact_build(s, p):
    f = star(s, p).fact
    return f.select(
        "timestamp", "log_type", "status", "bytes", "is_anomaly", "event_month",
        *[F.col(c).isNotNull().alias(f"has_{c}") for c in
          ("ip_id", "request_id", "agent_id", "error_details_id", "anomaly_type_id")],
    )


def _star_join(s, p):
    return star(s, p).joined().select(
        "timestamp", "log_type", "ip", "country", "request", "method", "page", "referrer",
        "agent", "log_level", "error_message", "status", "bytes", "is_anomaly", "anomaly_type",
    )


def _key_integrity(s, p):
    st = star(s, p)
    out = ids = None
    for name, d in star_mod.DIMS.items():
        dim = st.dim(name)
        stats = dim.agg(
            F.lit(name).alias("dim"), F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(d.id_col).alias("n_ids"),
            F.count_distinct(*[F.col(k) for k in d.keys]).alias("n_keys"),
        )
        out = stats if out is None else out.unionByName(stats)
        held = dim.select(F.lit(name).alias("dim"), F.col(d.id_col).alias("id"))
        ids = held if ids is None else ids.unionByName(held)
    # one scan of the fact, reduced to the rows per id before anything is joined
    refs = st.fact.select(F.explode(F.array(*[F.struct(F.lit(n).alias("dim"), F.col(d.id_col).alias("id")) for n, d in star_mod.DIMS.items()])).alias("r"))
    refs = refs.select("r.*").filter(F.col("id").isNotNull()).groupBy("dim", "id").agg(F.count(F.lit(1)).alias("n"))
    orphans = refs.join(ids.distinct(), ["dim", "id"], "left_anti").groupBy("dim").agg(F.sum("n").alias("orphan_refs"))
    return out.join(orphans, "dim", "left").withColumn("orphan_refs", F.coalesce("orphan_refs", F.lit(0)))


def _uniq_approx(s, p, rsd: float = 0.05):
    st = star(s, p)
    exact = R.kpi_summary(st).select(F.col("unique_ips").alias("exact_unique_ips"))
    a = exact.withColumn("approx", R.kpi_summary(st, approx=True).select("unique_ips").scalar())
    return a.select("exact_unique_ips",
                    (F.abs(F.col("approx") - F.col("exact_unique_ips"))
                     <= 3 * rsd * F.col("exact_unique_ips")).alias("within_bound"))


def _multiline(s, p):
    docs = read_table(s, p, "documents")
    return text.stitch(docs, "text", "[A-Z]", keep=("doc_id",))


def _split_lines(s, p):
    """Each document a file, cut into splits of 16 lines."""
    docs = read_table(s, p, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "line"))
    return docs.select(F.col("doc_id").alias("file"), (F.col("seq") - F.col("seq") % 16).alias("blk"), "seq", "line")


def _stitch_parts(s, p):
    """Records in parts of bounded size; a record goes on over several splits where they have no start line."""
    found = text.stitch_lines(_split_lines(s, p), "[A-D]", max_bytes=PART_TEST_BYTES)
    return found.select(F.col("file").alias("doc_id"), F.col("rec").cast("int").alias("rec"), "part", "record")


def _stitch_lines(s, p):
    """The line-wise stitching of log files."""
    return text.stitch_lines(_split_lines(s, p), "[A-Z]").select(F.col("file").alias("doc_id"), F.col("rec").cast("int").alias("rec"), "record")


def _oversize(s, p):
    docs = envelope.drop_oversize(read_table(s, p, "documents"), "text", OVERSIZE_TEST_BYTES)
    return docs.select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"))


def _envelope_decode(s, p):
    ev = read_table(s, p, "events")
    return envelope.decode(ev, "props", StructType([StructField("k", IntegerType())]), keep=("event_id",))


def _envelope_roundtrip(s, p):
    env = envelope.encode(lines(s, p), keep=("event_id",))
    return envelope.decode(env, keep=("event_id",)).select("event_id", "log_type", "message")


def _keep_last(s, p):
    ev = read_table(s, p, "events")
    return star_mod.keep_last(ev.withColumn("_v", F.struct("ts", "event_id")), "user_id", "_v",
                              ["event_id", "ts", "user_id", "event_type", "value", "props"])


def _windowed(s, p):
    return detect.behaviour_verdict(detect.behaviour_profile(events(s, p), DAILY_TEST), DAILY_TEST)


def _geo_v6(s, p):
    """Addresses of both families: IPv6, IPv4, IPv4 written as IPv6, and text that is neither."""
    e, ip = F.col("event_id"), F.col("ip")
    fields = weblog_fields(read_table(s, p, "events")).select("event_id", "ip", F.split("ip", r"\.")[1].alias("k"))
    own = F.concat(F.lit("2001:db8:"), "k", F.lit("::"), (e % 9999).cast("string"))
    text6 = F.when(e % 5 == 0, F.concat(F.lit("::ffff:"), ip)).when(e % 5 == 1, F.lit("zz::1")).when(e % 5 == 2, ip).otherwise(own)
    index = geo.geo_index(ranges(s, p), ranges_v6=fixtures.geo_ranges_v6_from_nation(read_table(s, p, "nation")))
    return geo.enrich_country(fields.select("event_id", text6.alias("ip")), index)


def _geo_nested(s, p):
    """Addresses of both families in blocks that overlap: the most specific block says the country."""
    nation = read_table(s, p, "nation")
    fields = weblog_fields(read_table(s, p, "events")).select("event_id", "ip")
    own = read_table(s, p, "events").select("event_id", F.concat(F.lit("2001:db8:"), (F.col("user_id") % 13).cast("string"), F.lit("::"), (F.col("event_id") % 9999).cast("string")).alias("own"))
    text = fields.join(own, "event_id").select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("own")).otherwise(F.col("ip")).alias("ip"))
    return geo.enrich_country(text, geo.geo_index(fixtures.nested_ranges_from_nation(nation), ranges_v6=fixtures.nested_ranges_v6_from_nation(nation)))


def _country_iso(s, p):
    enriched = geo.enrich_country(events(s, p), ranges(s, p))
    known = enriched.filter(geo.known_country()).select("country").distinct()
    return geo.with_iso(known, codes(s, p))


def _month_counts(s, p):
    return star(s, p).fact.groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"))


def _filter_time(s, p):
    st = star(s, p)
    rows = st.attach(R._fact(st, TIME_FILTER), ["dim_ip", "dim_request"])
    return rows.select("timestamp", "log_type", "ip", "page", "status")


def _actuals(s, p):
    return R.actuals_of(series(s, p))


def _scaling(s, p):
    hours = series(s, p)
    return fc.scaling_advice(fc.forecast_additive(hours), R.actuals_of(hours))


def _actual_vs_forecast(s, p):
    hours = series(s, p)
    return fc.actual_vs_forecast(R.actuals_of(hours), fc.forecast_additive(hours))


def _fresh(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _forecast_read(s, p):
    root = _fresh(s, "forecast")
    lake.write_predictions(prediction(s, p), root)
    return R.forecast_read(lake.read_predictions(s, root))


def _flagging(s, p):
    """Flags of whole input: the lines are parsed once, as in a backfill; counts and rows derive from the staged events."""
    return detect.flag(lake.staged(events(s, p), _fresh(s, "flagging"), 0), PER_BATCH)


def _flags_from_cuts(s, p):
    """Three batches cut across every window, read with the verdicts of all their counts."""
    root, geo_rows = _fresh(s, "cuts"), geo.geo_index(ranges(s, p))
    for k in range(3):
        process_batch(lines(s, p).filter(F.col("event_id") % 3 == k), k, root, geo_rows, STAR_CONFIG, whole=False)
    st = lake.read_star(s, root, STAR_CONFIG)
    return st.joined(["dim_ip", "dim_anomaly_type"]).select("timestamp", "log_type", "ip", "status", "is_anomaly", "anomaly_type")


def _broken_lines(s, p):
    """The lines, some with a date that is none, without a message, of unknown type, or oversize."""
    at = lines(s, p)
    message = (F.when(F.col("event_id") % 101 == 0, F.lit(None).cast("string"))
               .when(F.col("event_id") % 107 == 0, F.concat("message", F.repeat(F.lit(" "), 3000)))
               .when(F.col("event_id") % 97 == 0, F.regexp_replace("message", r"^(\S+ - - \[)\d\d/\w+", "$199/Foo")).otherwise(F.col("message")))
    kind = F.when(F.col("event_id") % 103 == 0, F.lit(None).cast("string")).when(F.col("event_id") % 109 == 0, F.lit("other")).otherwise(F.col("log_type"))
    return at.select("event_id", kind.alias("log_type"), message.alias("message"))


def _conservation(s, p):
    """Per type: input lines, fact rows, quarantined lines; nothing is lost between them."""
    root, given = _fresh(s, "conservation"), _broken_lines(s, p)
    process_batch(given, 0, root, ranges(s, p), STAR_CONFIG, max_bytes=OVERSIZE_TEST_BYTES)
    kind = F.coalesce("log_type", F.lit("(none)")).alias("log_type")
    fact, bad = lake.read_table(s, root, "fact", star_mod.FACT_SCHEMA), lake.read_table(s, root, "quarantine", QUARANTINE_SCHEMA)
    counted = [t.select(kind, *[F.lit(int(i == j)).alias(c) for j, c in enumerate(("n_input", "n_fact", "n_quarantine"))], u.alias("n_untimed"))
               for i, (t, u) in enumerate(((given, F.lit(0)), (fact, F.col("timestamp").isNull().cast("int")), (bad, F.lit(0))))]
    rows = counted[0].unionByName(counted[1]).unionByName(counted[2])
    sums = rows.groupBy("log_type").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n_input", "n_fact", "n_quarantine", "n_untimed")])
    return sums.withColumn("conserved", F.col("n_input") == F.col("n_fact") + F.col("n_quarantine"))


def _dim_refresh(s, p):
    """Two batches, the second with new countries: the newest wins."""
    root, old = _fresh(s, "refresh"), ranges(s, p)
    new = old.withColumn("country", F.concat("country", F.lit("_NEW")))
    for k, table in enumerate((old, new)):
        process_batch(lines(s, p), k, root, table, PER_BATCH)
    return lake.read_dim(s, root, "dim_ip").select("ip", "country")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # scans, sources, layout
    "envelope_decode": _envelope_decode,
    "envelope_roundtrip": _envelope_roundtrip,
    "multiline_stitch": _multiline,
    "oversize_filter": _oversize,
    "month_partition_counts": _month_counts,
    "replacing_dedupe": _keep_last,
    "multiline_stitch_lines": _stitch_lines,
    "multiline_stitch_parts": _stitch_parts,
    "quarantine": lambda s, p: lake.read_table(s, star_root(s, p), "quarantine", QUARANTINE_SCHEMA).select("log_type", "message"),
    "ingest_conservation": _conservation,
    "dim_ip_refresh": _dim_refresh,
    # parse, union
    "parse_access": lambda s, p: parse.access_events(lines(s, p)).filter(F.col("ip") != ""),
    "parse_error": lambda s, p: parse.error_events(lines(s, p)).filter(F.col("ip") != ""),
    "unified_events": events,
    # detection
    "signature_flags": lambda s, p: detect.with_signature(events(s, p)),
    "behavioral_profile": lambda s, p: detect.behaviour_profile(events(s, p), PER_BATCH),
    "behavioral_verdict": lambda s, p: detect.behaviour_verdict(
        detect.behaviour_profile(events(s, p), PER_BATCH), PER_BATCH),
    "behavioral_windowed": _windowed,
    "anomaly_flagging": _flagging,
    "windowed_flags_from_cuts": _flags_from_cuts,
    # geo
    "geo_enrich": lambda s, p: geo.enrich_country(events(s, p), ranges(s, p)),
    "geo_enrich_v6": _geo_v6,
    "geo_enrich_nested": _geo_nested,
    "country_iso": _country_iso,
    # star
    "dim_ip": _natural("dim_ip"),
    "dim_request": _natural("dim_request"),
    "dim_user_agent": _natural("dim_user_agent"),
    "dim_error_details": _natural("dim_error_details"),
    "dim_anomaly_type": _natural("dim_anomaly_type"),
    "fact_build": _fact_build,
    "star_join": _star_join,
    "surrogate_key_integrity": _key_integrity,
    "uniq_approx_within_bound": _uniq_approx,
    # filters
    "filter_time_range": _filter_time,
    "filter_in_lists": lambda s, p: R.kpi_summary(star(s, p), LIST_FILTER),
    # reports
    "kpi_summary": lambda s, p: R.kpi_summary(star(s, p)),
    "time_bounds": lambda s, p: R.time_bounds(star(s, p)),
    "distinct_statuses": lambda s, p: R.distinct_statuses(star(s, p)),
    "distinct_countries": lambda s, p: R.distinct_countries(star(s, p)),
    "distinct_methods": lambda s, p: R.distinct_methods(star(s, p)),
    "requests_by_class_per_minute": lambda s, p: R.requests_by_class_per_minute(star(s, p)),
    "avg_bytes_per_minute": lambda s, p: R.avg_bytes_per_minute(star(s, p)),
    "requests_by_country": lambda s, p: R.requests_by_country(star(s, p), codes(s, p)),
    "error_rate_by_country": lambda s, p: R.error_rate_by_country(star(s, p), codes(s, p)),
    "top_pages": lambda s, p: R.top_pages(star(s, p)),
    "top_ips_by_traffic": lambda s, p: R.top_ips_by_traffic(star(s, p)),
    "status_distribution": lambda s, p: R.status_distribution(star(s, p)),
    "top_ips_by_errors": lambda s, p: R.top_ips_by_errors(star(s, p)),
    "error_heatmap": lambda s, p: R.error_heatmap(star(s, p)),
    "error_heatmap_pivot": lambda s, p: R.error_heatmap_pivot(star(s, p)),
    "anomaly_timeline": lambda s, p: R.anomaly_timeline(star(s, p)),
    "anomaly_by_type": lambda s, p: R.anomaly_by_type(star(s, p)),
    "anomaly_summary": lambda s, p: R.anomaly_summary(star(s, p)),
    "top_error_messages": lambda s, p: R.top_error_messages(star(s, p)),
    "error_levels_per_minute": lambda s, p: R.error_levels_per_minute(star(s, p)),
    "recent_errors": lambda s, p: R.recent_errors(star(s, p)),
    "hourly_actuals": _actuals,
    # forecast
    "hourly_series": lambda s, p: fc.hourly_series(star(s, p)),
    "hourly_series_filled": lambda s, p: fc.fill_gaps(series(s, p)),
    "forecast_additive": prediction,
    "forecast_fourier": lambda s, p: fc.forecast_fourier(series(s, p)),
    "forecast_by_country": lambda s, p: fc.forecast_many(fc.materialise(fc.hourly_series_by(star(s, p), "dim_ip", "country")), "country"),
    "forecast_read": _forecast_read,
    "fourier_normal_equations": lambda s, p: fc.normal_equations(series(s, p)),
    "forecast_peak": lambda s, p: fc.forecast_peak(prediction(s, p)),
    "load_p95": lambda s, p: fc.load_p95(_actuals(s, p)),
    "scaling_advice": _scaling,
    "actual_vs_forecast": _actual_vs_forecast,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda f: lambda s, p: present(f(prepare(s), p)))(f) for name, f in QUERIES.items()}
