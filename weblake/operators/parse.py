"""Parse raw lines into the unified event table; keep what does not parse.

Input: any DataFrame with ``message`` and ``log_type`` (`access` / `error`).
Output (unified event): ip, method, page, referrer, agent, log_type, request,
error_message, log_level (string), status (int), bytes (bigint),
timestamp (timestamp, UTC).

Everything is a row-local projection (no shuffle). A line whose pattern does
not match yields empty groups, hence an empty ``ip``; such lines are dropped
from the event table and returned by :func:`quarantine` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblake.functions.patterns import (
    ACCESS_PATTERN,
    ACCESS_TIME_FORMAT,
    ERROR_PATTERN,
    ERROR_TIME_FORMAT,
)

EVENT_COLUMNS = (
    "timestamp", "log_type", "ip", "method", "page", "request", "status", "bytes",
    "referrer", "agent", "log_level", "error_message",
)


# Single-pass extraction: one regex match per line rewrites the line to
# SEP g1 SEP g2 ... (Java replacement syntax), and a split on SEP gives every
# group. `\A(?s:.*?)(?:P)(?s:.*)` matches where find() would: the lazy prefix
# tries each start position in order. The rewrite is its own projection so it
# runs once per line (Catalyst does not inline a costly expression that is
# used several times). The rewrite is guarded by `spark_partition_id()`
# (always >= 0, but non-deterministic), so Catalyst does not push the later
# `ip != ''` filter below it: otherwise the filter would repeat the rewrite under the
# projection (twice the regex work per line) and, for a small input spread
# over more tasks, run it inside the single scan task before the spread.
# A line that already contains SEP cannot be split safely; those lines (none
# in practice) take the per-group regexp_extract.
SEP = "\u0001"


def _rewritten(m: Column, pattern: str, groups: list[int]) -> Column:
    whole = r"\A(?s:.*?)(?:" + pattern + r")(?s:.*)"
    return F.regexp_replace(m, whole, "".join(SEP + f"${g}" for g in groups))


def all_events(lines: DataFrame, keep: tuple[str, ...] = (), access_pattern: str = ACCESS_PATTERN,
               error_pattern: str = ERROR_PATTERN, max_bytes: int | None = None) -> DataFrame:
    """Every line in the unified schema, in one pass over the input: the line's type picks its pattern.

    A line that does not parse has ``ip = ''``: its pattern does not match, its type is unknown or NULL, the
    message is NULL, or it is larger than `max_bytes`. Columns named in `keep` pass through unchanged."""
    access, error = [1, 2, 3, 4, 6, 7, 8, 9], [1, 2, 3, 4]
    m, kind = F.col("message"), F.col("log_type")
    usable = F.lit(True) if max_bytes is None else F.octet_length(m) <= max_bytes
    rewritten = F.when((kind == "access") & usable, _rewritten(m, access_pattern, access)).when(
        (kind == "error") & usable, _rewritten(m, error_pattern, error))
    df = lines.select(*keep, kind.alias("log_type"), m.alias("_msg"), F.when(F.spark_partition_id() >= 0, rewritten).alias("_rw"),
                      F.contains(m, F.lit(SEP)).alias("_unsafe"), usable.alias("_fits"))
    # one split for all fields, in a projection of its own; NULL where the rewrite did not match
    df = df.withColumn("_parts", F.when(F.startswith("_rw", F.lit(SEP)), F.split(F.expr("substring(_rw, 2)"), SEP)))
    parts, matched = F.col("_parts"), F.col("_parts").isNotNull()

    def group(of: str, pattern: str, groups: list[int], g: int) -> Column:
        fast = F.when(matched, parts[groups.index(g)]).otherwise(F.lit(""))
        text = F.when(F.col("_unsafe") & F.col("_fits"), F.regexp_extract("_msg", pattern, g)).otherwise(fast)
        return F.when(F.col("log_type") == of, text)

    def a(g: int) -> Column:
        return group("access", access_pattern, access, g)

    def e(g: int) -> Column:
        return group("error", error_pattern, error, g)

    return df.select(
        *keep,
        F.coalesce(F.try_to_timestamp(a(2), F.lit(ACCESS_TIME_FORMAT)), F.try_to_timestamp(e(1), F.lit(ERROR_TIME_FORMAT))).alias("timestamp"),
        "log_type",
        F.coalesce(a(1), F.split(e(3), ",")[0], F.lit("")).alias("ip"),
        a(3).alias("method"),
        a(4).alias("page"),
        a(4).alias("request"),
        a(6).try_cast("int").alias("status"),
        a(7).try_cast("bigint").alias("bytes"),
        a(8).alias("referrer"),
        a(9).alias("agent"),
        e(2).alias("log_level"),
        e(4).alias("error_message"),
    )


def access_events(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Access lines in the unified schema, parsed or not (unparsed: ip = '')."""
    return all_events(lines.filter(F.col("log_type") == "access"), keep)


def error_events(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Error lines in the unified schema, parsed or not (unparsed: ip = '')."""
    return all_events(lines.filter(F.col("log_type") == "error"), keep)


def parse_lines(lines: DataFrame) -> DataFrame:
    """The unified event table: parsed lines only (``ip != ''``)."""
    return all_events(lines).filter(F.col("ip") != "")


def unparsed(events: DataFrame) -> DataFrame:
    """The quarantine `(log_type, message)` of events that kept their `message`: parsed and quarantined
    lines together are the input."""
    return events.filter(F.col("ip") == "").select("log_type", "message")


def quarantine(lines: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """The lines that do not parse: ``(log_type, message)``."""
    return unparsed(all_events(lines, keep=("message",), max_bytes=max_bytes))
