"""Filter elision and conjunction, schemas, the level guard, forecast overwrite."""

import os

from pyspark.sql import functions as F

from conftest import SF001
from weblake import queries as Q
from weblake import schemas
from weblake.operators.parse import parse_lines
from weblake.plans import reports as R
from weblake.plans.filters import Filters, conjunction, elide
from weblake.sources import lake


def test_elision():
    assert elide([]) is None and elide(None) is None
    assert elide([200, 404], [200, 404]) is None            # everything selected
    assert elide([200], [200, 404]) == (200,)
    f = Filters.from_selection(statuses=[200, 404], all_statuses=[200, 404], methods=["GET"],
                               all_methods=["GET", "POST"])
    assert f.statuses is None and f.methods == ("GET",) and f.dims_needed() == ["dim_request"]
    assert conjunction([]) is None


def test_filters_restrict_rows(spark):
    st = Q.star(spark, SF001)
    total = R.kpi_summary(st).first().total
    only_get = R.kpi_summary(st, Filters(methods=("GET",))).first().total
    only_404 = R.kpi_summary(st, Filters(statuses=(404,))).first().total
    both = R.kpi_summary(st, Filters(methods=("GET",), statuses=(404,))).first().total
    acc = st.joined(["dim_request"]).filter("log_type = 'access'")
    assert only_get == acc.filter("method = 'GET'").count()
    assert only_404 == acc.filter("status = 404").count()
    assert both == acc.filter("method = 'GET' AND status = 404").count()
    assert total > only_get > both


def test_event_schema_matches_parser(spark):
    lines = Q.lines(spark, SF001)
    got = {f.name: f.dataType for f in parse_lines(lines).schema.fields}
    assert got == {f.name: f.dataType for f in schemas.EVENT_SCHEMA.fields}
    assert set(schemas.ALL) >= {"fact", "dim_ip", "predictions", "envelope"}


def test_level_guard(spark):
    levels = R.error_levels_per_minute(Q.star(spark, SF001))
    assert R.has_level_activity(levels)
    assert not R.has_level_activity(levels.filter(F.lit(False)))


def test_forecast_overwrite_sink(spark, tmpdir_path):
    pred = Q.prediction(spark, SF001)
    for _ in range(2):  # truncate + insert: the second write replaces the first
        lake.write_predictions(pred, tmpdir_path)
    stored = lake.read_predictions(spark, tmpdir_path)
    assert stored.count() == 24
    assert R.forecast_read(stored).columns == ["hour", "predicted_requests", "predicted_lower",
                                               "predicted_upper"]
    assert os.path.isdir(os.path.join(tmpdir_path, "predictions"))
