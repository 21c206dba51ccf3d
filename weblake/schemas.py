"""Declared schemas of every table the engine reads or writes (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from weblake.operators.star import DIMS, FACT_SCHEMA
from weblake.sources.envelope import ENVELOPE_SCHEMA

S, L, I, T, D = StringType(), LongType(), IntegerType(), TimestampType(), DoubleType()

EVENT_SCHEMA = StructType([
    StructField("timestamp", T), StructField("log_type", S), StructField("ip", S),
    StructField("method", S), StructField("page", S), StructField("request", S),
    StructField("status", I), StructField("bytes", L), StructField("referrer", S),
    StructField("agent", S), StructField("log_level", S), StructField("error_message", S),
])

PREDICTIONS_SCHEMA = StructType([
    StructField("timestamp", T), StructField("predicted_requests", D),
    StructField("predicted_lower", D), StructField("predicted_upper", D),
])

GEO_RANGES_SCHEMA = StructType([
    StructField("start_ip", L), StructField("end_ip", L), StructField("country", S),
])

COUNTRY_CODES_SCHEMA = StructType([StructField("country", S), StructField("iso_alpha3", S)])

QUARANTINE_SCHEMA = StructType([
    StructField("log_type", S), StructField("message", S), StructField("batch_id", L),
])

PAGE_COUNTS_SCHEMA = StructType([
    StructField("window_start", T), StructField("ip", S), StructField("page", S), StructField("n", L),
    StructField("lp", L), StructField("ip_id", L), StructField("batch_id", L), StructField("event_month", S),
])

VERDICTS_SCHEMA = StructType([
    StructField("window_start", T), StructField("ip_id", L), StructField("rank", I), StructField("batch_id", L), StructField("event_month", S),
])

ROLLUP_SCHEMA = StructType([
    StructField("minute", T), StructField("tail", BooleanType()), StructField("log_type", S), StructField("status", I), StructField("method", S),
    StructField("log_level", S), StructField("n", L), StructField("bytes_sum", L), StructField("bytes_count", L), StructField("batch_id", L), StructField("event_month", S),
])

SKETCHES_SCHEMA = StructType([StructField("hour", T), StructField("ips", BinaryType()), StructField("batch_id", L), StructField("event_month", S)])

DIM_SCHEMAS = {name: d.schema for name, d in DIMS.items()}

ALL = {
    "envelope": ENVELOPE_SCHEMA, "event": EVENT_SCHEMA, "fact": FACT_SCHEMA,
    "predictions": PREDICTIONS_SCHEMA, "geo_ranges": GEO_RANGES_SCHEMA,
    "country_codes": COUNTRY_CODES_SCHEMA, "quarantine": QUARANTINE_SCHEMA, "page_counts": PAGE_COUNTS_SCHEMA, "verdicts": VERDICTS_SCHEMA,
    "rollup": ROLLUP_SCHEMA, "sketches": SKETCHES_SCHEMA, **DIM_SCHEMAS,
}
