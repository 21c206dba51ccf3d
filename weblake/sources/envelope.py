"""JSON envelopes ``{"message": ..., "log_type": ...}``: decode and encode.

Fixed schema, nothing inferred: undeclared fields are ignored and malformed
JSON decodes to NULLs (PERMISSIVE), which the ``log_type`` filters of the
parser then drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from weblake.functions.patterns import MAX_MESSAGE_BYTES

ENVELOPE_SCHEMA = StructType([
    StructField("message", StringType()),
    StructField("log_type", StringType()),
])


def decode(df: DataFrame, value: str = "value", schema: StructType = ENVELOPE_SCHEMA,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """Binary or string column of JSON -> the schema's columns (plus `keep`)."""
    data = F.from_json(F.col(value).cast("string"), schema).alias("data")
    return df.select(*keep, data).select(*keep, "data.*")


def encode(df: DataFrame, columns: tuple[str, ...] = ("message", "log_type"),
           keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows -> one JSON string column `value` (what goes to a topic)."""
    return df.select(*keep, F.to_json(F.struct(*columns)).alias("value"))


def fits(col: Column | str, max_bytes: int = MAX_MESSAGE_BYTES) -> Column:
    """True when the UTF-8 size of `col` is within `max_bytes`."""
    c = F.col(col) if isinstance(col, str) else col
    return F.octet_length(c) <= max_bytes


def drop_oversize(df: DataFrame, col: str = "value", max_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """The messages of at most `max_bytes`, as a shipper would send. Ingest keeps the others in the
    quarantine (``process_batch(..., max_bytes=)``)."""
    return df.filter(fits(col, max_bytes))
