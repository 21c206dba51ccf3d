"""Dashboard reports over the star schema, one DataFrame function each.

Plan shape. Grouping by a dimension attribute (page, address, country,
message, anomaly type) first aggregates the *fact* by the surrogate id(s)
and only then joins the dimension and rolls up by the attribute. The fact is
the only large input, and a partial aggregate on an id combines map-side, so
neither the fact rows nor a hot key (one address with a third of the
traffic) cross the network: only one row per id and map task does. Country
and method filters add their id to that grouping and apply after the join.
Counts per minute, hour and status come from the rollup that the ingest keeps, where the filters allow it
(:mod:`weblake.plans.rollups`), and so do unique addresses by sketch.
"Latest n rows" reports walk the months newest first until n rows are found, so older ones are not read, then find the n-th newest timestamp on the fact
(a top-n over one column), keep the rows at or after it (ties included), and
join dimensions to those rows only. Top-k lists sort by the key as the last
column, so ties resolve the same way every run.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblake.operators.geo import known_country, with_iso
from weblake.operators.star import DIMS, Star
from weblake.plans.filters import NO_FILTERS, Filters, apply
from weblake.plans.forecast import hourly_series
from weblake.plans.forecast import materialise as materialised
from weblake.plans.rollups import minutes, unique_addresses, when


def _access() -> Column:
    return F.col("log_type") == "access"


def _error() -> Column:
    return F.col("log_type") == "error"


def _status_between(lo: int, hi: int | None = None) -> Column:
    s = F.col("status")
    return (s >= lo) if hi is None else ((s >= lo) & (s < hi))


def _pct(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double")) * 100


def _minute() -> Column:
    return F.date_trunc("minute", "timestamp").alias("minute")


def _fact(star: Star, flt: Filters, where: Column | None = None, fact_filters: bool = True) -> DataFrame:
    fact = star.fact
    month = "event_month" in fact.columns
    preds = flt.fact_predicates(month) if fact_filters else flt.time_predicates(with_month=month)
    if where is not None:
        preds = [where, *preds]
    return apply(fact, preds)


def _rollup(star: Star, flt: Filters, fact: DataFrame, by: list, dims: list[str],
            metrics: dict[str, Column]) -> DataFrame:
    """Aggregate `fact` by `by` + the ids of `dims` (and of dims the filters
    name), join those dims, apply the dim filters. Metric columns are partial
    aggregates; callers re-aggregate them by natural attributes."""
    names = list(dims) + [d for d in flt.dims_needed() if d not in dims]
    ids = [DIMS[d].id_col for d in names]
    pre = fact.groupBy(*by, *ids).agg(*[c.alias(n) for n, c in metrics.items()])
    return apply(star.attach(pre, names), flt.dim_predicates())


def _top(df: DataFrame, metric: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.col(metric).desc_nulls_last(), F.col(key).asc_nulls_first()).limit(n)


def _latest(star: Star, flt: Filters, fact: DataFrame, n: int) -> DataFrame:
    """Rows whose timestamp is among the n newest (ties at the edge kept). Where the star knows its months, they are counted
    newest first, twice as many each time, until n rows are found; only those are read."""
    months = _months(star, flt)
    at, step, found = 0, 1, 0
    while at + step < len(months) and found < n:
        low = months[at + step - 1]
        found += fact.filter(F.col("event_month").between(low, months[at])).limit(n).count()
        at, step = at + step, 2 * step
    if found >= n:
        fact = fact.filter(F.col("event_month") >= low)
    edge = fact.select("timestamp").orderBy(F.col("timestamp").desc()).limit(n).agg(
        F.min("timestamp")
    )
    return fact.filter(F.col("timestamp") >= edge.scalar())


def _months(star: Star, flt: Filters) -> list[str]:
    """The star's months that the filters leave, newest first; none if they aren't known."""
    try:
        start, end = when(flt.start), when(flt.end)
    except ValueError:
        return []
    low, high = start.strftime("%Y%m") if start else "", end.strftime("%Y%m") if end else "~"
    return sorted((m for m in star.months if low <= m <= high), reverse=True)


# ---------------------------------------------------------------- R1 - R4
def kpi_summary(star: Star, flt: Filters = NO_FILTERS, approx: bool = False) -> DataFrame:
    """Access rows: total, unique_ips, avg_bytes, server/client error %; zeros where there are no rows.

    Exact: grouped by address id first, so unique_ips is the number of groups (no
    distinct aggregate) and the global step sees one row per address. ``approx=True``
    counts addresses by a HyperLogLog sketch: from the stored ones, if the filters name times only (the other figures come
    from the rollup, then), else in one pass."""
    ips = unique_addresses(star, flt) if approx else None
    rows = minutes(star, flt) if ips is not None else None
    if rows is not None:
        rows = rows.filter(_access()).groupBy("status").agg(*[F.sum(c).alias(c) for c in ("n", "bytes_sum", "bytes_count")])
        n, b, c = (F.sum(x) for x in ("n", "bytes_sum", "bytes_count"))
        c5, c4 = (F.coalesce(F.sum(F.when(x, F.col("n"))), F.lit(0)) for x in (_status_between(500), _status_between(400, 500)))
        ips = F.coalesce(F.first(ips.scalar()), F.lit(0))
    elif approx:
        rows = apply(star.attach(_fact(star, flt, _access()), flt.dims_needed()), flt.dim_predicates())
        n, b, c, c5, c4 = (F.count(F.lit(1)), F.sum("bytes"), F.count("bytes"), F.count_if(_status_between(500)),
                           F.count_if(_status_between(400, 500)))
        ips = F.approx_count_distinct("ip_id")
    else:
        rows = _kpi_pre(star, flt)
        n, b, c, c5, c4 = (F.sum(x) for x in ("n", "bsum", "bcnt", "c5", "c4"))
        ips = F.count("ip_id")
    zero = F.lit(0.0)
    return rows.agg(
        F.coalesce(n, F.lit(0)).alias("total"),
        ips.alias("unique_ips"),
        F.coalesce(F.try_divide(b.cast("double"), c.cast("double")), zero).alias("avg_bytes"),
        F.coalesce(_pct(c5, n), zero).alias("server_error_rate"),
        F.coalesce(_pct(c4, n), zero).alias("client_error_rate"),
    )


def _kpi_pre(star: Star, flt: Filters) -> DataFrame:
    fact = _fact(star, flt, _access())
    names = [d for d in flt.dims_needed()]
    ids = ["ip_id"] + [DIMS[d].id_col for d in names if d != "dim_ip"]
    pre = fact.groupBy(*ids).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("bytes").alias("bsum"),
        F.count("bytes").alias("bcnt"),
        F.count_if(_status_between(500)).alias("c5"),
        F.count_if(_status_between(400, 500)).alias("c4"),
    )
    pre = apply(star.attach(pre, names), flt.dim_predicates())
    if len(ids) > 1:  # a method filter split addresses over request ids
        pre = pre.groupBy("ip_id").agg(*[F.sum(c).alias(c) for c in ("n", "bsum", "bcnt", "c5", "c4")])
    return pre


def time_bounds(star: Star) -> DataFrame:
    """Of the fact's first and last month, if the star knows its months."""
    fact = star.fact
    if len(star.months) > 2:
        fact = fact.filter(F.col("event_month").isin(star.months[0], star.months[-1]))
    return fact.agg(F.min("timestamp").alias("min_ts"), F.max("timestamp").alias("max_ts"))


def distinct_statuses(star: Star) -> DataFrame:
    return star.fact.filter(F.col("status").isNotNull()).select("status").distinct().orderBy("status")


def distinct_countries(star: Star) -> DataFrame:
    return (star.dim("dim_ip").filter(known_country()).select("country").distinct()
            .orderBy("country"))


def distinct_methods(star: Star) -> DataFrame:
    m = F.col("method")
    return (star.dim("dim_request").filter(m.isNotNull() & (m != "")).select("method")
            .distinct().orderBy("method"))


# ---------------------------------------------------------------- R5 - R6
def requests_by_class_per_minute(star: Star, flt: Filters = NO_FILTERS) -> DataFrame:
    classes = {
        "success_2xx": _status_between(200, 300),
        "redirects_3xx": _status_between(300, 400),
        "client_errors_4xx": _status_between(400, 500),
        "server_errors_5xx": _status_between(500),
    }
    rows = minutes(star, flt)
    if rows is not None:
        sums = [F.sum(F.when(v, F.col("n")).otherwise(0)).alias(k) for k, v in classes.items()]
        return rows.filter(_access()).groupBy("minute").agg(*sums).orderBy("minute")
    pre = _rollup(star, flt, _fact(star, flt, _access()), [_minute()], [],
                  {k: F.count_if(v) for k, v in classes.items()})
    return pre.groupBy("minute").agg(*[F.sum(k).alias(k) for k in classes]).orderBy("minute")


def avg_bytes_per_minute(star: Star, flt: Filters = NO_FILTERS) -> DataFrame:
    rows = minutes(star, flt)
    if rows is not None:
        pre = rows.filter(_access()).select("minute", F.col("bytes_sum").alias("bsum"), F.col("bytes_count").alias("bcnt"))
    else:
        pre = _rollup(star, flt, _fact(star, flt, _access()), [_minute()], [],
                      {"bsum": F.sum("bytes"), "bcnt": F.count("bytes")})
    return pre.groupBy("minute").agg(
        F.try_divide(F.sum("bsum").cast("double"), F.sum("bcnt").cast("double")).alias("avg_bytes")
    ).orderBy("minute")


# ---------------------------------------------------------------- R7 - R8
def _by_country(star: Star, flt: Filters, metrics: dict[str, Column]) -> DataFrame:
    pre = _rollup(star, flt, _fact(star, flt), [], ["dim_ip"], metrics)
    return pre.filter(known_country()).groupBy("country").agg(
        *[F.sum(k).alias(k) for k in metrics]
    )


def requests_by_country(star: Star, codes: DataFrame, flt: Filters = NO_FILTERS) -> DataFrame:
    df = _by_country(star, flt, {"cnt": F.count(F.lit(1))})
    return with_iso(df, codes).withColumnRenamed("iso_alpha3", "iso_alpha")


def error_rate_by_country(star: Star, codes: DataFrame, flt: Filters = NO_FILTERS) -> DataFrame:
    df = _by_country(star, flt, {
        "error_count": F.count_if(_status_between(400)), "total_count": F.count(F.lit(1)),
    }).filter(F.col("total_count") > 0)
    df = df.withColumn("error_rate", _pct(F.col("error_count"), F.col("total_count")))
    return (with_iso(df, codes).withColumnRenamed("iso_alpha3", "iso_alpha")
            .orderBy(F.col("error_rate").desc_nulls_last(), F.col("country")))


# ---------------------------------------------------------------- R9 - R12
def top_pages(star: Star, flt: Filters = NO_FILTERS, n: int = 10) -> DataFrame:
    pre = _rollup(star, flt, _fact(star, flt, _access()), [], ["dim_request"], {"hits": F.count(F.lit(1))})
    return _top(pre.groupBy("page").agg(F.sum("hits").alias("hits")), "hits", "page", n)


def top_ips_by_traffic(star: Star, flt: Filters = NO_FILTERS, n: int = 10) -> DataFrame:
    pre = _rollup(star, flt, _fact(star, flt, _access()), [], ["dim_ip"], {"bsum": F.sum("bytes")})
    df = pre.groupBy("ip").agg((F.sum("bsum") / 1024 / 1024).alias("total_mb"))
    return _top(df, "total_mb", "ip", n)


def status_distribution(star: Star, flt: Filters = NO_FILTERS) -> DataFrame:
    rows = minutes(star, flt)
    if rows is not None:
        pre = rows.filter(_access()).select("status", F.col("n").alias("cnt"))
    else:
        pre = _rollup(star, flt, _fact(star, flt, _access()), ["status"], [], {"cnt": F.count(F.lit(1))})
    return pre.groupBy("status").agg(F.sum("cnt").alias("cnt")).orderBy(F.col("status").asc_nulls_first())


def top_ips_by_errors(star: Star, flt: Filters = NO_FILTERS, n: int = 10) -> DataFrame:
    # no access predicate: error-log rows have no status, so `status >= 400` excludes them
    pre = _rollup(star, flt, _fact(star, flt, _status_between(400)), [], ["dim_ip"],
                  {"errors": F.count(F.lit(1))})
    return _top(pre.groupBy("ip").agg(F.sum("errors").alias("errors")), "errors", "ip", n)


def busiest_pages(star: Star, flt: Filters = NO_FILTERS, n: int = 15) -> DataFrame:
    """Top-n pages over all rows (error rows form the NULL page group)."""
    pre = _rollup(star, flt, _fact(star, flt), [], ["dim_request"], {"c": F.count(F.lit(1))})
    return _top(pre.groupBy("page").agg(F.sum("c").alias("c")), "c", "page", n).select("page")


def error_heatmap(star: Star, flt: Filters = NO_FILTERS, n_pages: int = 15) -> DataFrame:
    """(page, status, count) of 4xx/5xx rows on the n busiest pages."""
    pre = _rollup(star, flt, _fact(star, flt, _status_between(400)), ["status"], ["dim_request"],
                  {"count": F.count(F.lit(1))})
    top = busiest_pages(star, flt, n_pages)  # <= n rows: broadcast
    return (pre.join(F.broadcast(top), on="page", how="left_semi")
            .groupBy("page", "status").agg(F.sum("count").alias("count")))


def error_heatmap_pivot(star: Star, flt: Filters = NO_FILTERS, n_pages: int = 15) -> DataFrame:
    """Pages x statuses, zero where a pair has no rows."""
    heat = materialised(error_heatmap(star, flt, n_pages))  # n_pages x statuses: pivot looks the statuses up in it
    return heat.groupBy("page").pivot("status").agg(F.first("count")).na.fill(0)


# ---------------------------------------------------------------- R13 - R15
def _anomalies(star: Star, flt: Filters) -> DataFrame:
    # anomaly reports filter by time only; an anomalous row always has a type id
    where = (F.col("is_anomaly") == 1) & F.col("anomaly_type_id").isNotNull()
    return _fact(star, flt.time_only(), where)


def _nonblank_type() -> Column:
    return F.col("anomaly_type") != ""


def anomaly_timeline(star: Star, flt: Filters = NO_FILTERS, n: int = 500) -> DataFrame:
    rows = star.attach(_latest(star, flt, _anomalies(star, flt), n), ["dim_ip", "dim_anomaly_type"])
    return (rows.filter(_nonblank_type()).select("timestamp", "ip", "anomaly_type")
            .orderBy(F.col("timestamp").desc(), "ip", "anomaly_type").limit(n))


def anomaly_by_type(star: Star, flt: Filters = NO_FILTERS) -> DataFrame:
    pre = star.attach(
        _anomalies(star, flt).groupBy("anomaly_type_id").agg(F.count(F.lit(1)).alias("cnt")),
        ["dim_anomaly_type"],
    )
    return pre.filter(_nonblank_type()).groupBy("anomaly_type").agg(F.sum("cnt").alias("cnt"))


def anomaly_summary(star: Star, flt: Filters = NO_FILTERS, n: int = 20) -> DataFrame:
    pre = _anomalies(star, flt).groupBy("ip_id", "anomaly_type_id").agg(
        F.max("timestamp").alias("last_seen"), F.count(F.lit(1)).alias("request_count")
    )
    df = (star.attach(pre, ["dim_ip", "dim_anomaly_type"]).filter(_nonblank_type())
          .groupBy("ip", "country", "anomaly_type")
          .agg(F.max("last_seen").alias("last_seen"), F.sum("request_count").alias("request_count")))
    return df.orderBy(F.col("last_seen").desc(), "ip", "anomaly_type").limit(n)


# ---------------------------------------------------------------- R16 - R18
def _errors(star: Star, flt: Filters) -> DataFrame:
    return _fact(star, flt.time_only(), _error())


def top_error_messages(star: Star, flt: Filters = NO_FILTERS, n: int = 10) -> DataFrame:
    pre = star.attach(
        _errors(star, flt).groupBy("error_details_id").agg(F.count(F.lit(1)).alias("cnt")),
        ["dim_error_details"],
    )
    return _top(pre.groupBy("error_message").agg(F.sum("cnt").alias("cnt")), "cnt", "error_message", n)


def error_levels_per_minute(star: Star, flt: Filters = NO_FILTERS) -> DataFrame:
    rows = minutes(star, flt.time_only())
    if rows is not None:
        pre = rows.filter(_error())
    else:
        pre = star.attach(
            _errors(star, flt).groupBy(_minute(), "error_details_id").agg(F.count(F.lit(1)).alias("n")),
            ["dim_error_details"],
        )
    lvl = F.col("log_level")
    return pre.groupBy("minute").agg(
        F.coalesce(F.sum(F.when(lvl == "error", F.col("n"))), F.lit(0)).alias("errors"),
        F.coalesce(F.sum(F.when(lvl == "warn", F.col("n"))), F.lit(0)).alias("warnings"),
    ).orderBy("minute")


def has_level_activity(levels: DataFrame) -> bool:
    """Guard before charting: any error or warning at all."""
    return not levels.filter((F.col("errors") > 0) | (F.col("warnings") > 0)).isEmpty()


def recent_errors(star: Star, flt: Filters = NO_FILTERS, n: int = 100) -> DataFrame:
    rows = star.attach(_latest(star, flt, _errors(star, flt), n), ["dim_ip", "dim_error_details"])
    return (rows.select("timestamp", "ip", "country", "log_level", "error_message")
            .orderBy(F.col("timestamp").desc(), "ip", "error_message").limit(n))


# ---------------------------------------------------------------- R19 - R20
def hourly_actuals(star: Star, as_of=None, days: int = 3) -> DataFrame:
    """(hour, actual_requests) of the last `days` days: from a bounded part of the fact if `as_of` is given, else
    up to the last hour with traffic, from the hourly series (one scan of the fact)."""
    if as_of is None:
        return actuals_of(materialised(hourly_series(star)), days)
    since = F.lit(str(as_of)).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    try:
        rows = minutes(star, Filters(start=when(str(as_of)) - timedelta(days=int(days))))
    except ValueError:
        rows = None
    if rows is not None:
        return rows.filter(_access()).groupBy(F.date_trunc("hour", "minute").alias("hour")).agg(F.sum("n").alias("actual_requests")).orderBy("hour")
    rows = star.fact.filter(_access() & (F.col("timestamp") >= since))
    if "event_month" in star.fact.columns:
        rows = rows.filter(F.col("event_month") >= F.date_format(since, "yyyyMM"))
    return rows.groupBy(F.date_trunc("hour", "timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("actual_requests")).orderBy("hour")


def actuals_of(series: DataFrame, days: int = 3) -> DataFrame:
    """The last `days` days of an hourly series."""
    since = series.agg(F.max("ds")).scalar() - F.expr(f"INTERVAL {int(days)} DAYS")
    return series.filter(F.col("ds") >= since).select(F.col("ds").alias("hour"), F.col("y").alias("actual_requests")).orderBy("hour")


def forecast_read(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        F.col("timestamp").alias("hour"), "predicted_requests", "predicted_lower", "predicted_upper"
    ).orderBy("hour")
