"""Rollups kept by the ingest, and reports answered from them.

Every batch adds two small tables, published with it and merged by compaction like all others:

* ``rollup``: rows and bytes per minute, line type, status, method and error level. Sums of sums stay exact.
* ``sketches``: a HyperLogLog sketch of the addresses with access rows, per hour. A union of sketches is the sketch of the union,
  in any order, so unique addresses of any range need no scan of its rows.

:func:`minutes` says whether filters allow an answer from the rollup: no country (it is not in it), and times that begin
and end with a minute. If not, it gives None and the report reads the fact. :func:`unique_addresses` takes whole hours from
the sketches and scans the fact only for the parts of hours at the edges.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblake.operators.star import DIMS, Star, _owns, event_month
from weblake.plans.filters import Filters, apply

KEYS = ("minute", "tail", "log_type", "status", "method", "log_level", "event_month")
LOG_K = 12  # 4,096 registers: a relative standard error of 1.6 %


def rollup_of(events: DataFrame) -> DataFrame:
    """Sums per minute and key; `tail` marks times after a minute's last whole second."""
    at = F.unix_micros("timestamp")
    keyed = events.select(
        F.date_trunc("minute", "timestamp").alias("minute"), (F.pmod(at, F.lit(60_000_000)) > 59_000_000).alias("tail"), "log_type", "status",
        F.when(_owns(DIMS["dim_request"]), F.col("method")).alias("method"), F.when(_owns(DIMS["dim_error_details"]), F.col("log_level")).alias("log_level"),
        event_month().alias("event_month"), "bytes")
    return keyed.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes_sum"), F.count("bytes").alias("bytes_count"))


def sketches_of(events: DataFrame) -> DataFrame:
    """A sketch of address ids per hour."""
    rows = events.filter((F.col("log_type") == "access") & F.col("ip").isNotNull() & F.col("timestamp").isNotNull())
    hour = F.date_trunc("hour", "timestamp")
    return rows.groupBy(hour.alias("hour"), event_month().alias("event_month")).agg(F.hll_sketch_agg(F.xxhash64("ip"), F.lit(LOG_K)).alias("ips"))


def merged_rollup(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("n", "bytes_sum", "bytes_count")], F.max("batch_id").alias("batch_id"))


def merged_sketches(rows: DataFrame) -> DataFrame:
    return rows.groupBy("hour", "event_month").agg(F.hll_union_agg("ips").alias("ips"), F.max("batch_id").alias("batch_id"))


def when(value: datetime | str | None) -> datetime | None:
    """A filter's time; raises ValueError if it is not one that Python reads."""
    return datetime.fromisoformat(value) if isinstance(value, str) else value


def minutes(star: Star, flt: Filters) -> DataFrame | None:
    """The rollup's rows that the filters leave, None if it cannot answer them."""
    if star.rollup is None or flt.countries is not None:
        return None
    try:
        start, end = when(flt.start), when(flt.end)
    except ValueError:
        return None
    if any(t is not None and t.tzinfo is not None for t in (start, end)) or (start and (start.second or start.microsecond)) or (end and (end.second != 59 or end.microsecond)):
        return None
    preds = [p for p in flt.time_predicates("minute", with_month=True)]
    if end:
        preds.append(~(F.col("tail") & (F.col("minute") == F.lit(str(end.replace(second=0))).cast("timestamp"))))
    if flt.statuses is not None:
        preds.append(F.col("status").isin(*flt.statuses))
    if flt.methods is not None:
        preds.append(F.col("method").isin(*flt.methods))
    return apply(star.rollup, preds)


def unique_addresses(star: Star, flt: Filters) -> DataFrame | None:
    """One row `unique_ips`: the estimate for access rows of a time range cut anywhere; None if the filters name more than times."""
    if star.sketches is None or flt != flt.time_only():
        return None
    try:
        start, end = when(flt.start), when(flt.end)
    except ValueError:
        return None
    if any(t is not None and t.tzinfo is not None for t in (start, end)):
        return None

    def floor(t: datetime) -> datetime:
        return t.replace(minute=0, second=0, microsecond=0)

    first = floor(start + timedelta(hours=1, microseconds=-1)) if start else None  # the first whole hour
    last = floor(end) if end else None  # the hour of the end, which is cut
    whole, edges = star.sketches.select("hour", "event_month", "ips"), []

    def at(t: datetime) -> Column:
        return F.lit(str(t)).cast("timestamp")

    if first:
        whole = whole.filter((F.col("hour") >= at(first)) & (F.col("event_month") >= F.date_format(at(first), "yyyyMM")))
        if first > start:
            edges.append(Filters(start, min(first - timedelta(microseconds=1), end) if end else first - timedelta(microseconds=1)))
    if last:
        whole = whole.filter((F.col("hour") < at(last)) & (F.col("event_month") <= F.date_format(at(last), "yyyyMM")))
        if not (first and last < first):
            edges.append(Filters(last, end))
    parts = whole.select("ips")
    for edge in edges:
        rows = apply(star.fact, edge.time_predicates(with_month=True)).filter((F.col("log_type") == "access") & F.col("ip_id").isNotNull())
        parts = parts.unionByName(rows.agg(F.hll_sketch_agg("ip_id", F.lit(LOG_K)).alias("ips")))
    return parts.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("ips")), F.lit(0)).alias("unique_ips"))
