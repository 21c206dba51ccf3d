"""Forecast fits against numpy; sources (envelopes, multi-line, oversize, tagged text)."""

import datetime as dt
import os
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weblake.plans import forecast as fc
from weblake.sources import envelope, text


def design(ds, t0):
    """The features of the fit, in numpy."""
    ds = pd.to_datetime(ds)
    hod = ds.dt.hour.to_numpy().astype(float)
    how = ((ds.dt.dayofweek.to_numpy() + 1) % 7) * 24.0 + hod  # Sunday first
    cols = [np.ones(len(ds)), (ds - pd.Timestamp(t0)).dt.total_seconds().to_numpy() / 3600.0]
    for x, harmonics, period in ((hod, fc.DAILY_HARMONICS, 24.0), (how, fc.WEEKLY_HARMONICS, 168.0)):
        for k in range(1, harmonics + 1):
            cols += [np.sin(x * 2 * np.pi * k / period), np.cos(x * 2 * np.pi * k / period)]
    return np.column_stack(cols)


def _series(spark, hours=24 * 10):
    t0 = dt.datetime(2024, 1, 1)
    rng = np.random.default_rng(7)
    rows = []
    for h in range(hours):
        ts = t0 + dt.timedelta(hours=h)
        y = 50 + 0.1 * h + 10 * np.sin(2 * np.pi * ts.hour / 24) + 5 * (ts.weekday() >= 5) + rng.normal(0, 1)
        rows.append((ts, int(round(y))))
    return spark.createDataFrame(rows, "ds timestamp, y bigint"), pd.DataFrame(rows, columns=["ds", "y"])


def test_fourier_matches_numpy_lstsq(spark):
    sdf, pdf = _series(spark)
    pred = fc.forecast_fourier(sdf).toPandas()
    X = design(pdf["ds"], pdf["ds"].min())
    beta, *_ = np.linalg.lstsq(X, pdf["y"].to_numpy(float), rcond=None)
    fut = pd.Series(pd.date_range(pdf["ds"].max() + pd.Timedelta(hours=1), periods=24, freq="h"))
    want = design(fut, pdf["ds"].min()) @ beta
    assert len(pred) == 24
    np.testing.assert_allclose(pred["predicted_requests"].to_numpy(), want, rtol=1e-6, atol=1e-6)
    assert (pred["predicted_lower"] < pred["predicted_requests"]).all()
    assert (pred["predicted_upper"] > pred["predicted_requests"]).all()


def test_fit_is_orthogonal_to_its_features(spark):
    sdf, _ = _series(spark)
    rows = fc.normal_equations(sdf).collect()
    assert [r.feature for r in rows] == ["constant", *fc.FEATURES]
    assert all(r.orthogonal and r.n_rows == 240 for r in rows)


def test_short_series_have_no_forecast(spark):
    sdf, _ = _series(spark, hours=30)
    for n in (0, 1):
        short = sdf.orderBy("ds").limit(n)
        assert fc.forecast_additive(short).collect() == [] and fc.forecast_fourier(short).collect() == []
    assert fc.forecast_additive(sdf.orderBy("ds").limit(2)).count() == 24


def test_gaps_are_filled_with_zeros(spark):
    sdf, pdf = _series(spark, hours=10)
    filled = fc.fill_gaps(sdf.filter(F.hour("ds").isin(0, 3, 9))).collect()
    assert [r.y for r in filled] == [y if h in (0, 3, 9) else 0 for h, y in enumerate(pdf["y"])]
    assert fc.fill_gaps(sdf.limit(0)).collect() == []


def test_additive_forecast_future_only_and_peak(spark):
    sdf, _ = _series(spark)
    pred = fc.forecast_additive(sdf)
    assert pred.count() == 24
    last = sdf.agg(F.max("ds")).first()[0]
    assert pred.filter(F.col("timestamp") <= F.lit(last)).count() == 0
    # as_of after the last training hour: a stale model yields fewer rows
    assert fc.forecast_additive(sdf, as_of=last + dt.timedelta(hours=20)).count() == 4
    peak = fc.forecast_peak(pred).first()
    assert peak.predicted_upper == pred.agg(F.max("predicted_upper")).first()[0]
    actuals = sdf.withColumnRenamed("ds", "hour").withColumnRenamed("y", "actual_requests")
    adv = fc.scaling_advice(pred, actuals).first()
    p95 = float(np.percentile(actuals.toPandas()["actual_requests"], 95))
    assert abs(adv.critical_threshold - p95) < 1e-9
    assert adv.scale_up == (adv.predicted_upper > p95)


def test_envelope_decode_permissive(spark):
    df = spark.createDataFrame([('{"message": "m", "log_type": "access", "x": 1}',), ("not json",), (None,)],
                               "value string")
    got = [(r.message, r.log_type) for r in envelope.decode(df).collect()]
    assert got == [("m", "access"), (None, None), (None, None)]
    rt = envelope.decode(envelope.encode(spark.createDataFrame([("a\"b\nc", "error")], "message string, log_type string")))
    assert rt.first().message == "a\"b\nc"


def test_oversize_drop(spark):
    df = spark.createDataFrame([("é" * 10,), ("a" * 25,)], "value string")
    assert [len(r.value) for r in envelope.drop_oversize(df, max_bytes=20).collect()] == [10]


def test_stitch_records(spark):
    docs = spark.createDataFrame([
        (1, "pre\nA one\n more\nB two"),
        (2, "Alpha\nbeta"),
        (3, ""),
        (4, "x\n"),
    ], "doc_id int, text string")
    got = sorted((r.doc_id, r.rec, r.record) for r in text.stitch(docs, keep=("doc_id",)).collect())
    assert got == [(1, 0, "pre"), (1, 1, "A one\n more"), (1, 2, "B two"), (2, 1, "Alpha\nbeta"),
                   (3, 0, ""), (4, 0, "x\n")]


def test_tagged_text_and_stitched_files(spark, tmpdir_path):
    acc, err = os.path.join(tmpdir_path, "access.log"), os.path.join(tmpdir_path, "error.log")
    with open(acc, "w") as f:
        f.write("line1\nline2\n")
    with open(err, "w") as f:
        f.write("2025/10/28 10:00:00 [error] first\n  continued\n2025/10/28 10:00:01 [warn] second\n")
    df = text.read_tagged(spark, {"access": acc})
    assert sorted((r.log_type, r.message) for r in df.collect()) == [("access", "line1"), ("access", "line2")]
    recs = sorted((r.rec, r.message) for r in text.read_stitched(spark, err).collect())
    assert recs == [(1, "2025/10/28 10:00:00 [error] first\n  continued"),
                    (2, "2025/10/28 10:00:01 [warn] second")]


def test_stitched_files_across_splits(spark, tmpdir_path):
    """Files cut into ~200-byte splits give the same records as whole texts,
    including records whose continuation lines run into later splits."""
    rnd = np.random.default_rng(7)
    paths = []
    for fi in range(3):
        p = os.path.join(tmpdir_path, f"e{fi}.log")
        with open(p, "w") as f:
            if fi == 1:
                f.write("orphan head\n  more head\n")
            for i in range(60):
                f.write(f"2025/10/28 10:{fi:02d}:{i:02d} [error] rec{i}\n")
                for k in range(int(rnd.choice([0, 0, 1, 3, 12]))):
                    f.write(f"  cont {i}.{k}\n")
        paths.append(p)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        n_splits = text.file_lines(spark, paths).select("file", "blk").distinct().count()
        got = sorted((r.file, r.rec, r.message) for r in text.read_stitched(spark, paths).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\n$", "").alias("text"))
    want = sorted((r.file, r.rec, r.record) for r in
                  text.stitch(whole, "text", text.ERROR_RECORD_START, keep=("file",)).collect())
    assert n_splits > 20
    assert got == want


def _parts(lines, start, most):
    """{(rec, part): record} of one file."""
    out, rec, before = {}, 0, 0
    for line in lines:
        if re.match(start, line):
            rec, before = rec + 1, 0
        out.setdefault((rec, before // most), []).append(line)
        before += len(line.encode()) + 1
    return {k: "\n".join(v) for k, v in out.items()}


def _odd_files():
    rnd = np.random.default_rng(9)
    def tail(n):
        return [f"  é {k} " + "x" * int(rnd.integers(0, 30)) for k in range(n)]
    return {"none": tail(300), "late": tail(70) + ["2025/10/28 10:00:00 a"] + tail(90), "many": [x for i in range(40) for x in (f"2025/10/28 10:00:{i:02d} b", *tail(int(rnd.choice([0, 1, 2, 30]))))],
            "long": ["2025/10/28 10:00:00 c", "y" * 5000, *tail(3), "2025/10/28 10:00:01 d"]}


def test_records_in_parts_over_many_splits(spark, tmpdir_path):
    """A file without a start, records over many splits, a line longer than a part: each part is exact and bounded."""
    files = _odd_files()
    for name, lines in files.items():
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        got = text.read_stitched(spark, tmpdir_path, max_bytes=256).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {(n, *k): v for n, lines in files.items() for k, v in _parts(lines, text.ERROR_RECORD_START, 256).items()}
    assert {(os.path.basename(r.file), r.rec, r.part): r.message for r in got} == want and len(got) == len(want)
    assert max(len(r.message.encode()) for r in got if "y" * 100 not in r.message) < 256 + 60


def test_a_stream_cut_inside_records_equals_the_files(spark, tmpdir_path):
    files, src, out = _odd_files(), os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    rows = [(n, i, line) for n, lines in files.items() for i, line in enumerate(lines)] + [(n, 10_000, None) for n in files]
    schema = "file string, place long, line string"
    for cut in range(0, 10_001, 37):  # each micro-batch has a stretch of every file
        part = [r for r in rows if cut <= r[1] < cut + 37]
        if part and cut < 400 or cut + 37 > 10_000:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(src)
    def run():
        lines = spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).json(src)
        (text.stitch_stream(lines, max_bytes=256).writeStream.format("json").option("path", out).option("checkpointLocation", os.path.join(tmpdir_path, "ckpt"))
         .trigger(availableNow=True).start().awaitTermination())
    run()
    run()  # a restart adds nothing
    got = spark.read.schema("file string, rec long, part long, record string").json(out).collect()
    want = {(n, *k): v for n, lines in files.items() for k, v in _parts(lines, text.ERROR_RECORD_START, 256).items()}
    assert {(r.file, r.rec, r.part): r.record for r in got} == want and len(got) == len(want)


def test_train_save_load_predict(spark, tmpdir_path):
    sdf, _ = _series(spark)
    fc.train(sdf, tmpdir_path)
    saved = fc.predict_saved(spark, tmpdir_path).toPandas()
    direct = fc.forecast_fourier(sdf).toPandas()
    np.testing.assert_allclose(saved["predicted_upper"].to_numpy(), direct["predicted_upper"].to_numpy(),
                               rtol=1e-9, atol=1e-9)
    last = sdf.agg(F.max("ds")).first()[0]
    assert fc.predict_saved(spark, tmpdir_path, as_of=last + dt.timedelta(hours=22)).count() == 2


def _plan(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_stitched_plan_is_split_bounded(spark, tmpdir_path):
    """The running count is windowed per file split, never per whole file."""
    p = os.path.join(tmpdir_path, "plan.log")
    with open(p, "w") as f:
        f.write("2025/10/28 10:00:00 [error] a\n  b\n")
    plan = _plan(text.read_stitched(spark, p))
    assert "file_block_start" in plan
    assert re.search(r"windowspecdefinition\(file#\d+, blk#\d+L?, seq", plan)
    assert "wholetext" not in plan.lower()


def _many(spark, hours=24 * 21):
    rnd, rows = np.random.default_rng(2), []
    for k in range(5):
        for h in range(hours):
            if k < 4 and rnd.random() < 0.9 or h < (1 if k == 4 else 0):
                y = 40 + 5 * k + 0.02 * k * h + 8 * np.sin(2 * np.pi * h / 24) + (0.3 * max(0, h - 200) if k == 3 else 0) + rnd.normal()
                rows.append((f"k{k}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(y)))
    return spark.createDataFrame(rows, "key string, ds timestamp_ntz, y double").withColumn("ds", F.col("ds").cast("timestamp"))


@pytest.mark.parametrize("hinges", [0, 4])
def test_many_fits_equal_least_squares_per_key(spark, hinges):
    series = _many(spark)
    fits = {r.key: r for r in fc.fit_many(series, "key", hinges, ridge=0.0).collect()}
    assert set(fits) == {"k0", "k1", "k2", "k3"}  # one hour is no series
    design = series.join(fc.fit_many(series, "key", hinges).select("key", "t0", "span"), "key").select("key", "ds", "y", F.array(*fc._features(hinges)).alias("x")).collect()
    for key, fit in fits.items():
        x, y = np.array([r.x for r in design if r.key == key]), np.array([r.y for r in design if r.key == key])
        want = np.linalg.lstsq(x, y, rcond=None)[0]
        assert np.allclose(fit.coef, want, rtol=1e-6, atol=1e-6) and fit.n == len(y)
        assert abs(fit.sigma - np.std(y - x @ want, ddof=1)) < 1e-6


def test_bends_follow_a_change_point_and_future_hours_are_those_after_all_series(spark):
    series = _many(spark)
    straight, bent = (fc.forecast_many(series, "key", hinges=h, ridge=1e-3).filter("key = 'k3'").orderBy("timestamp").collect() for h in (0, 12))
    last = series.agg(F.max("ds")).first()[0]
    truth = np.array([55 + 0.06 * h + 8 * np.sin(2 * np.pi * h / 24) + 0.3 * (h - 200) for h in range(24 * 21, 24 * 22)])
    assert [r.timestamp for r in bent] == [last + dt.timedelta(hours=h) for h in range(1, 25)]
    error = [np.abs(np.array([r.predicted_requests for r in rows]) - truth).mean() for rows in (straight, bent)]
    assert error[1] < 3 < error[0] and all(r.predicted_lower < r.predicted_requests < r.predicted_upper for r in bent)
    assert fc.forecast_many(series, "key", as_of=last + dt.timedelta(hours=20)).groupBy("key").count().filter("count != 4").count() == 0


def test_one_aggregation_fits_all_keys_and_short_ones_have_the_smallest_solution(spark):
    series = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, h), float(3 + h)) for h in range(3)], "key string, ds timestamp_ntz, y double").withColumn("ds", F.col("ds").cast("timestamp"))
    fit = fc.fit_many(series, "key").first()
    x = np.array([r.x for r in series.withColumns({"t0": F.lit(fit.t0), "span": F.lit(fit.span)}).orderBy("ds").select(F.array(*fc._features(0)).alias("x")).collect()])
    assert np.allclose(x @ fit.coef, [3, 4, 5], atol=1e-4) and np.linalg.norm(fit.coef) < 1.01 * np.linalg.norm(np.linalg.pinv(x) @ [3, 4, 5])
    assert fc.forecast_many(series.limit(0), "key").count() == 0
