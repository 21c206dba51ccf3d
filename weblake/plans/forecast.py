"""Hourly load forecast: series, fit, 24-hour prediction with bounds, advice.

The only large step is the hourly series (an aggregate over the fact). The
series has one row per hour of history, so it is materialised once with a
reliable ``checkpoint()`` (to ``spark.checkpoint.dir``) and the fit reads the
small copy; one-row statistics enter as scalar subqueries.

Two fits with the same components (trend + daily + weekly seasonality):

* :func:`forecast_additive` -- closed form: least-squares trend, then mean
  residual by hour of day, then mean remainder by day of week; bounds are
  yhat -/+ z(0.9) * (std of the remainder), an 80 % band.
* :func:`forecast_fourier` -- Fourier regression (trend, 4 daily and 3 weekly
  harmonics) with ``pyspark.ml`` ``LinearRegression`` (normal equations);
  :func:`normal_equations` checks a fit.

:func:`forecast_many` fits the Fourier regression for every key (page, country, ...) in one aggregation.

A forecast needs two points at least; from fewer there are no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblake.operators.star import DIMS, Star
from weblake.plans.filters import NO_FILTERS
from weblake.plans.rollups import minutes
from weblake.session import checkpoint_dir

Z80 = 1.2815515655446004  # standard normal quantile 0.9 (80 % two-sided band)
HORIZON = 24
DAILY_HARMONICS = 4
WEEKLY_HARMONICS = 3


def hourly_series(star_or_fact, access_only: bool = True) -> DataFrame:
    """`(ds, y)`: rows per hour; hours without rows are absent (not zero). From the rollup, if the star has one."""
    rows = minutes(star_or_fact, NO_FILTERS) if isinstance(star_or_fact, Star) else None
    if rows is not None:
        rows = rows.filter(F.col("log_type") == "access") if access_only else rows
        return rows.groupBy(F.date_trunc("hour", "minute").alias("ds")).agg(F.sum("n").alias("y")).orderBy("ds")
    fact = star_or_fact.fact if isinstance(star_or_fact, Star) else star_or_fact
    if access_only:
        fact = fact.filter(F.col("log_type") == "access")
    return (fact.groupBy(F.date_trunc("hour", "timestamp").alias("ds"))
            .agg(F.count(F.lit(1)).alias("y")).orderBy("ds"))


def fill_gaps(series: DataFrame) -> DataFrame:
    """`(ds, y)` with the hours between the first and the last that have no rows as zeros."""
    hours = series.agg(F.explode(F.sequence(F.min("ds"), F.max("ds"), F.expr("INTERVAL 1 HOUR"))).alias("ds"))
    return hours.join(series, "ds", "left").select("ds", F.coalesce("y", F.lit(0)).alias("y")).orderBy("ds")


def materialise(series: DataFrame) -> DataFrame:
    """Cut lineage: write the (small) series to the shared checkpoint folder."""
    checkpoint_dir(series.sparkSession)
    return series.checkpoint(eager=True)


def _hours_since(ds: Column, t0: Column) -> Column:
    return (F.unix_seconds(ds) - F.unix_seconds(t0)).cast("double") / 3600.0


def _future(series: DataFrame, horizon: int) -> DataFrame:
    last = F.max("ds")
    return series.agg(F.count("ds").alias("n"), F.sequence(
        last + F.expr("INTERVAL 1 HOUR"), last + F.expr(f"INTERVAL {int(horizon)} HOURS"),
        F.expr("INTERVAL 1 HOUR")).alias("hours")).filter("n >= 2").select(F.explode("hours").alias("ds"))


def _as_of_filter(pred: DataFrame, series: DataFrame, as_of) -> DataFrame:
    cut = series.agg(F.max("ds")).scalar() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    return pred.filter(F.col("timestamp") > cut)


def forecast_additive(series: DataFrame, horizon: int = HORIZON, as_of=None,
                      z: float = Z80) -> DataFrame:
    """`(timestamp, predicted_requests, predicted_lower, predicted_upper)`."""
    t0 = series.agg(F.min("ds")).scalar()
    s = series.select("ds", F.col("y").cast("double").alias("y"),
                      _hours_since(F.col("ds"), t0).alias("t"))
    slope = s.agg(F.regr_slope("y", "t")).scalar()
    intercept = s.agg(F.regr_intercept("y", "t")).scalar()
    trend = lambda t: F.coalesce(intercept, F.lit(0.0)) + F.coalesce(slope, F.lit(0.0)) * t
    r1 = s.select("ds", "t", (F.col("y") - trend(F.col("t"))).alias("r1"),
                  F.hour("ds").alias("hod"), F.dayofweek("ds").alias("dow"))
    daily = r1.groupBy("hod").agg(F.avg("r1").alias("daily"))          # <= 24 rows
    r2 = r1.join(F.broadcast(daily), "hod").withColumn("r2", F.col("r1") - F.col("daily"))
    weekly = r2.groupBy("dow").agg(F.avg("r2").alias("weekly"))        # <= 7 rows
    r3 = r2.join(F.broadcast(weekly), "dow").withColumn("r3", F.col("r2") - F.col("weekly"))
    sigma = r3.agg(F.stddev_samp("r3")).scalar()

    fut = (_future(series, horizon)
           .withColumn("t", _hours_since(F.col("ds"), t0))
           .withColumn("hod", F.hour("ds")).withColumn("dow", F.dayofweek("ds"))
           .join(F.broadcast(daily), "hod", "left").join(F.broadcast(weekly), "dow", "left"))
    yhat = trend(F.col("t")) + F.coalesce(F.col("daily"), F.lit(0.0)) + F.coalesce(F.col("weekly"), F.lit(0.0))
    pred = fut.select(
        F.col("ds").alias("timestamp"),
        yhat.alias("predicted_requests"),
        (yhat - F.lit(z) * sigma).alias("predicted_lower"),
        (yhat + F.lit(z) * sigma).alias("predicted_upper"),
    )
    return _as_of_filter(pred, series, as_of).orderBy("timestamp")


# ------------------------------------------------------------ Fourier fit
def _fourier_exprs(ds: Column) -> list[Column]:
    hod = F.hour(ds).cast("double")
    how = ((F.dayofweek(ds) - 1) * 24 + F.hour(ds)).cast("double")
    cols = []
    for k in range(1, DAILY_HARMONICS + 1):
        w = 2 * math.pi * k / 24.0
        cols += [F.sin(hod * w).alias(f"d_sin{k}"), F.cos(hod * w).alias(f"d_cos{k}")]
    for k in range(1, WEEKLY_HARMONICS + 1):
        w = 2 * math.pi * k / 168.0
        cols += [F.sin(how * w).alias(f"w_sin{k}"), F.cos(how * w).alias(f"w_cos{k}")]
    return cols


FEATURES = ["t"] + [f"d_{f}{k}" for k in range(1, DAILY_HARMONICS + 1) for f in ("sin", "cos")] \
    + [f"w_{f}{k}" for k in range(1, WEEKLY_HARMONICS + 1) for f in ("sin", "cos")]


def fourier_design(df: DataFrame, t0: Column) -> DataFrame:
    return df.select("*", _hours_since(F.col("ds"), t0).alias("t"), *_fourier_exprs(F.col("ds")))


def fit_fourier(series: DataFrame):
    """Fit the Fourier regression; returns (model, t0 column, residual std column)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    t0 = series.agg(F.min("ds")).scalar()
    design = fourier_design(series.withColumn("y", F.col("y").cast("double")), t0)
    va = VectorAssembler(inputCols=FEATURES, outputCol="features")
    lr = LinearRegression(featuresCol="features", labelCol="y", solver="normal", regParam=0.0,
                          standardization=False)
    model = lr.fit(va.transform(design))
    resid = model.transform(va.transform(design)).select((F.col("y") - F.col("prediction")).alias("r"))
    sigma = resid.agg(F.stddev_samp("r")).scalar()
    return model, va, t0, sigma


def forecast_fourier(series: DataFrame, horizon: int = HORIZON, as_of=None, z: float = Z80) -> DataFrame:
    if series.limit(2).count() < 2:
        return series.sparkSession.createDataFrame([], "timestamp timestamp, predicted_requests double, predicted_lower double, predicted_upper double")
    model, va, t0, sigma = fit_fourier(series)
    fut = va.transform(fourier_design(_future(series, horizon), t0))
    yhat = F.col("prediction")
    pred = model.transform(fut).select(
        F.col("ds").alias("timestamp"),
        yhat.alias("predicted_requests"),
        (yhat - F.lit(z) * sigma).alias("predicted_lower"),
        (yhat + F.lit(z) * sigma).alias("predicted_upper"),
    )
    return _as_of_filter(pred, series, as_of).orderBy("timestamp")


def normal_equations(series: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Per feature of the Fourier fit (and the constant): whether the residuals are orthogonal to it, as a least-squares
    fit's are, up to `tolerance` of the size of the sum's terms; n_rows, the training rows."""
    model, va, t0, _ = fit_fourier(series)
    fitted = model.transform(va.transform(fourier_design(series, t0))).withColumn("r", F.col("y") - F.col("prediction"))
    names = ["constant", *FEATURES]
    value = {n: F.lit(1.0) if n == "constant" else F.col(n) for n in names}
    sums = fitted.agg(F.count(F.lit(1)).alias("n_rows"), *[F.struct(
        F.sum(F.col("r") * v).alias("dot"), F.sum(F.abs(F.col("y") * v)).alias("size")).alias(n) for n, v in value.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("s")) for n in names])
    return sums.select("n_rows", F.explode(rows).alias("f")).select(
        F.col("f.feature").alias("feature"), "n_rows", (F.abs(F.col("f.s.dot")) <= tolerance * (1 + F.col("f.s.size"))).alias("orthogonal"))


# ------------------------------------------------------------ many series
def hourly_series_by(star: Star, dim: str, column: str) -> DataFrame:
    """`(column, ds, y)`: access rows per hour and value of a dimension's column; rows without one are left out."""
    d = DIMS[dim]
    rows = star.fact.filter((F.col("log_type") == "access") & F.col("timestamp").isNotNull())
    counts = rows.groupBy(d.id_col, F.date_trunc("hour", "timestamp").alias("ds")).agg(F.count(F.lit(1)).alias("n"))
    return star.attach(counts, [dim]).filter(F.col(column).isNotNull()).groupBy(column, "ds").agg(F.sum("n").alias("y"))


def _features(hinges: int) -> list[Column]:
    """Columns of the design for `ds`, given a key's first hour `t0` and `span` in hours: constant, trend over the span, harmonics, and
    the trend's bends, spread over the first four fifths of the span."""
    t = _hours_since(F.col("ds"), F.col("t0")) / F.greatest(F.col("span"), F.lit(1.0))
    bends = [F.greatest(t - 0.8 * (j + 1) / (hinges + 1), F.lit(0.0)) for j in range(hinges)]
    return [F.lit(1.0), t, *_fourier_exprs(F.col("ds")), *bends]


def fit_many(series: DataFrame, key: str, hinges: int = 0, ridge: float = 1.0) -> DataFrame:
    """The Fourier regression of every key's series at once: `(key, t0, span, n, coef, sigma)`, keys of two hours and more.

    One aggregation sums each key's normal equations (features times features, features times y), combined map-side, so a key costs one row
    of fixed size however long its history; they are solved in batches of keys. `hinges` lets the trend bend at that many
    places, with the squares of the bends weighted by `ridge`. Where the hours don't determine all coefficients, the
    smallest solution is taken."""
    size = 2 + 2 * (DAILY_HARMONICS + WEEKLY_HARMONICS) + hinges
    spans = series.groupBy(key).agg(F.min("ds").alias("t0"), F.max("ds").alias("last"))
    spans = spans.select(F.col(key).alias("_key"), "t0", _hours_since(F.col("last"), F.col("t0")).alias("span"))
    rows = series.join(spans, F.col(key) == F.col("_key")).select(key, "t0", "span", F.col("y").cast("double").alias("y"), *[c.alias(f"x{i}") for i, c in enumerate(_features(hinges))])
    x = [F.col(f"x{i}") for i in range(size)]
    sums = rows.groupBy(key, "t0", "span").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("y") * F.col("y")).alias("yy"), F.array(*[F.sum(c * F.col("y")) for c in x]).alias("xy"),
        F.array(*[F.sum(x[i] * x[j]) for i in range(size) for j in range(i, size)]).alias("xx"))
    upper = np.triu_indices(size)
    bends = np.arange(size - hinges, size)

    @F.arrow_udf("coef array<double>, sigma double")
    def solved(xx: pa.Array, xy: pa.Array, yy: pa.Array, n: pa.Array) -> pa.Array:
        a = np.zeros((len(xx), size, size))
        a[:, upper[0], upper[1]] = a[:, upper[1], upper[0]] = np.asarray(xx.flatten()).reshape(-1, len(upper[0]))
        plain, b = a.copy(), np.asarray(xy.flatten()).reshape(-1, size)
        a[:, bends, bends] += ridge
        coef = np.einsum("kij,kj->ki", np.linalg.pinv(a, rcond=1e-12, hermitian=True), b)
        left = np.asarray(yy) - 2 * (coef * b).sum(axis=1) + np.einsum("ki,kij,kj->k", coef, plain, coef)
        sigma = np.sqrt(np.maximum(left, 0) / (np.asarray(n) - 1))
        lists = pa.ListArray.from_arrays(np.arange(0, coef.size + 1, size, dtype=np.int32), coef.ravel())
        return pa.StructArray.from_arrays([lists, pa.array(sigma)], ["coef", "sigma"])

    return sums.filter("n >= 2").select(key, "t0", "span", "n", solved("xx", "xy", "yy", "n").alias("f")).select(key, "t0", "span", "n", "f.coef", "f.sigma")


def forecast_many(series: DataFrame, key: str, horizon: int = HORIZON, as_of=None, z: float = Z80, hinges: int = 0, ridge: float = 1.0) -> DataFrame:
    """`(key, timestamp, predicted_requests, predicted_lower, predicted_upper)` for the hours after the last one of all series."""
    last, hour = series.agg(F.max("ds")).scalar(), F.expr("INTERVAL 1 HOUR")
    hours = F.sequence(last + hour, last + F.expr(f"INTERVAL {int(horizon)} HOURS"), hour)
    at = fit_many(series, key, hinges, ridge).withColumn("ds", F.explode(hours)).withColumn("x", F.array(*_features(hinges)))
    yhat = F.aggregate(F.zip_with("x", "coef", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    pred = at.select(key, F.col("ds").alias("timestamp"), yhat.alias("predicted_requests"), (yhat - F.lit(z) * F.col("sigma")).alias("predicted_lower"), (yhat + F.lit(z) * F.col("sigma")).alias("predicted_upper"))
    return _as_of_filter(pred, series, as_of)


# ------------------------------------------------------------ F4 - F6, D18
def forecast_peak(pred: DataFrame) -> DataFrame:
    """The future hour with the highest upper bound (earliest on ties)."""
    return (pred.orderBy(F.col("predicted_upper").desc(), F.col("timestamp").asc()).limit(1)
            .select(F.col("timestamp").alias("hour"), "predicted_requests", "predicted_upper"))


def load_p95(actuals: DataFrame, col: str = "actual_requests") -> DataFrame:
    """Interpolated 95th percentile (pandas ``quantile(0.95)``)."""
    return actuals.agg(F.percentile(F.col(col).cast("double"), 0.95).alias("p95"))


def scaling_advice(pred: DataFrame, actuals: DataFrame) -> DataFrame:
    """Peak hour plus `scale_up`: its upper bound exceeds the p95 of actual load."""
    thr = load_p95(actuals).scalar()
    return forecast_peak(pred).select(
        "*", thr.alias("critical_threshold"), (F.col("predicted_upper") > thr).alias("scale_up")
    )


def actual_vs_forecast(actuals: DataFrame, pred: DataFrame) -> DataFrame:
    a = actuals.select("hour", F.col("actual_requests").cast("double").alias("requests"),
                       F.lit("actual").alias("type"))
    p = pred.select(F.col("timestamp").alias("hour"), F.col("predicted_requests").alias("requests"),
                    F.lit("forecast").alias("type"))
    return a.unionByName(p)


# ------------------------------------------------------------ persistence
def train(series: DataFrame, model_dir: str) -> None:
    """Fit the Fourier model and save it with Spark ML persistence, plus a
    one-row table of what prediction needs (first hour, last hour, sigma)."""
    model, _va, _t0, sigma = fit_fourier(series)
    model.write().overwrite().save(f"{model_dir}/model")
    meta = series.agg(F.min("ds").alias("t0"), F.max("ds").alias("last")).select(
        "t0", "last", sigma.alias("sigma"))
    meta.write.mode("overwrite").parquet(f"{model_dir}/meta")


def predict_saved(spark, model_dir: str, horizon: int = HORIZON, as_of=None, z: float = Z80) -> DataFrame:
    """Load a saved model and forecast `horizon` hours after its last hour;
    with `as_of`, only hours after it are kept (a stale model yields fewer)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegressionModel

    model = LinearRegressionModel.load(f"{model_dir}/model")
    meta = spark.read.parquet(f"{model_dir}/meta")
    fut = meta.select(
        "t0", "sigma",
        F.explode(F.sequence(F.col("last") + F.expr("INTERVAL 1 HOUR"),
                             F.col("last") + F.expr(f"INTERVAL {int(horizon)} HOURS"),
                             F.expr("INTERVAL 1 HOUR"))).alias("ds"))
    design = fut.select("*", _hours_since(F.col("ds"), F.col("t0")).alias("t"), *_fourier_exprs(F.col("ds")))
    va = VectorAssembler(inputCols=FEATURES, outputCol="features")
    yhat = F.col("prediction")
    pred = model.transform(va.transform(design)).select(
        F.col("ds").alias("timestamp"), yhat.alias("predicted_requests"),
        (yhat - F.lit(z) * F.col("sigma")).alias("predicted_lower"),
        (yhat + F.lit(z) * F.col("sigma")).alias("predicted_upper"),
    )
    if as_of is not None:
        pred = pred.filter(F.col("timestamp") > F.lit(str(as_of)).cast("timestamp"))
    return pred.orderBy("timestamp")
