"""weblake: web-server log analytics on Spark.

Access and error lines (batch or stream) are parsed into one event table,
flagged by request signatures and per-address behaviour, given a country by
a range join on address blocks, stored as a star schema with replay-safe
writes, and queried by a fixed set of reports and an hourly load forecast.

Layout:
  sources/    readers and writers (text, JSON envelopes, Kafka, JDBC, lake)
  functions/  column-level helpers (fixed patterns, IPv4, time parsing)
  operators/  parse, detect, geo, star (DataFrame -> DataFrame)
  plans/      filters, reports, forecast, batch ingest job
  streaming/  Structured Streaming job (foreachBatch, windowed verdicts)
"""

from weblake.session import build_session, prepare

__all__ = ["build_session", "prepare"]
