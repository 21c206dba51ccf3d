"""Anomaly detection: request signatures, per-address behaviour, combined flag.

Signature rules are one ``when`` cascade over the row (no shuffle).
Behaviour is an aggregate per address, either over the whole input
(``per_batch``: one verdict per micro-batch or batch, the parity mode) or per
event-time tumbling window (``windowed``). The verdict goes back to *every* row
of that address (and window), error rows included. A line without a readable
time belongs to no window: it is kept, without a behaviour verdict.

Where the input comes in pieces (a stream), a window's rows may lie in several
of them. :func:`page_counts` is what a piece contributes; the counts of all
pieces together give the same verdicts as the whole input (:func:`apply_verdicts`).

Scale notes. The exact distinct-page count is written as two plain
aggregations, ``(keys, page)`` then ``keys``, instead of ``count(DISTINCT)``:
both levels combine map-side, so an address holding a third of all rows
sends one row per distinct page to the second level, not its raw rows, and
Spark needs no Expand of the input. Only addresses with a verdict are joined
back. The rows of a key with more than `HOT_ROWS` rows are spread over `SALTS` parts
by the plan itself; only the verdicts of those keys are repeated for each part.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblake.functions.patterns import (
    LOGIN_ATTACK,
    LOGIN_ATTACK_THRESHOLD,
    LOGIN_METHOD,
    LOGIN_PAGE,
    REQUEST_RATE_ANOMALY,
    REQUEST_RATE_THRESHOLD,
    SCANNING_ACTIVITY,
    SCANNING_THRESHOLD,
    SIGNATURE_RULES,
)


@dataclass(frozen=True)
class DetectConfig:
    mode: str = "windowed"  # "per_batch" (reference parity) or "windowed"
    window: str = "1 hour"  # tumbling event-time window for "windowed"
    login_threshold: int = LOGIN_ATTACK_THRESHOLD
    scan_threshold: int = SCANNING_THRESHOLD
    rate_threshold: int = REQUEST_RATE_THRESHOLD

    def __post_init__(self):
        if self.mode not in ("per_batch", "windowed"):
            raise ValueError(f"unknown behaviour mode {self.mode!r}")


PER_BATCH = DetectConfig(mode="per_batch")
# Daily windows with thresholds that fire at test scale (about 7 rows per
# address and day in the fixture); used by the star tables the reports read.
DAILY_TEST = DetectConfig(
    mode="windowed", window="1 day", login_threshold=1, scan_threshold=3, rate_threshold=3
)


def signature_type(rules=SIGNATURE_RULES) -> Column:
    """First matching rule's anomaly type, else NULL (NULL columns never match)."""
    out = None
    for name, column, pattern, case_insensitive in rules:
        p = ("(?i)" if case_insensitive else "") + pattern
        cond = F.col(column).rlike(p)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(None).cast("string"))


def with_signature(events: DataFrame, rules=SIGNATURE_RULES) -> DataFrame:
    return events.withColumn("signature_anomaly_type", signature_type(rules))


SALTS, HOT_ROWS = 16, 1_000_000
_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def window_seconds(window: str) -> int:
    """`"1 hour"` -> 3600."""
    n, unit = window.split()
    return int(n) * _SECONDS[unit.lower().removesuffix("s")]


def window_start(cfg: DetectConfig) -> Column:
    """Start of the row's tumbling window, NULL without a time. Plain arithmetic: `F.window` would add
    a filter on the time and so lose rows."""
    at = F.unix_seconds("timestamp")
    return F.timestamp_seconds(at - F.pmod(at, F.lit(window_seconds(cfg.window))))


def behaviour_keys(cfg: DetectConfig) -> list[str]:
    return ["ip"] if cfg.mode == "per_batch" else ["window_start", "ip"]


def _keyed(events: DataFrame, cfg: DetectConfig) -> DataFrame:
    if cfg.mode == "windowed":
        return events.withColumn("window_start", window_start(cfg))
    return events


def page_counts(events: DataFrame, cfg: DetectConfig = PER_BATCH) -> DataFrame:
    """Per key and page: rows `n` and login posts `lp` of the access rows (of those with a time, if windowed)."""
    access = _keyed(events.filter(F.col("log_type") == "access"), cfg)
    if cfg.mode == "windowed":
        access = access.filter(F.col("window_start").isNotNull())
    login = (F.col("page") == LOGIN_PAGE) & (F.col("method") == LOGIN_METHOD)
    return access.groupBy(*behaviour_keys(cfg), "page").agg(F.count(F.lit(1)).alias("n"), F.count_if(login).alias("lp"))


def profile_of(counts: DataFrame, cfg: DetectConfig) -> DataFrame:
    """Per key: request_count, distinct_pages, login_posts from page counts (one row per key and page)."""
    return counts.groupBy(*behaviour_keys(cfg)).agg(
        F.sum("n").alias("request_count"),
        F.count("page").alias("distinct_pages"),
        F.sum("lp").alias("login_posts"),
    )


def behaviour_profile(events: DataFrame, cfg: DetectConfig = PER_BATCH) -> DataFrame:
    """Per key: request_count, distinct_pages, login_posts over access rows."""
    return profile_of(page_counts(events, cfg), cfg)


def verdict_type(cfg: DetectConfig) -> Column:
    return (
        F.when(F.col("login_posts") > cfg.login_threshold, F.lit(LOGIN_ATTACK))
        .when(F.col("distinct_pages") > cfg.scan_threshold, F.lit(SCANNING_ACTIVITY))
        .when(F.col("request_count") > cfg.rate_threshold, F.lit(REQUEST_RATE_ANOMALY))
        .otherwise(F.lit(None).cast("string"))
    )


def behaviour_verdict(profile: DataFrame, cfg: DetectConfig = PER_BATCH) -> DataFrame:
    return profile.withColumn("behavioral_anomaly_type", verdict_type(cfg))


def flag(events: DataFrame, cfg: DetectConfig = PER_BATCH, rules=SIGNATURE_RULES) -> DataFrame:
    """Events + signature_anomaly_type, behavioral_anomaly_type, anomaly_type
    ('' when none), is_anomaly (0/1). Signature wins over behaviour."""
    return combined(with_verdicts(with_signature(events, rules), page_counts(events, cfg), cfg))


def flag_signatures(events: DataFrame, rules=SIGNATURE_RULES) -> DataFrame:
    """Like :func:`flag`, for a piece of a longer input: no behaviour verdicts yet."""
    return combined(with_signature(events, rules).withColumn("behavioral_anomaly_type", F.lit(None).cast("string")))


def _hot_keys(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than `HOT_ROWS` rows, error rows included; few by construction, so they are broadcast."""
    return F.broadcast(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_ROWS).select(*keys, F.lit(True).alias("_hot")))


def with_verdicts(rows: DataFrame, counts: DataFrame, cfg: DetectConfig, hot: str = "ip") -> DataFrame:
    """`rows` plus `behavioral_anomaly_type` by their key; `hot` names the address column of both."""
    keys = [hot if k == "ip" else k for k in behaviour_keys(cfg)]
    keyed = _keyed(rows, cfg)
    hot_keys, parts = _hot_keys(keyed, keys), F.when(F.col("_hot"), SALTS - 1).otherwise(0)
    verdicts = (
        behaviour_verdict(profile_of(counts.withColumnRenamed(hot, "ip"), cfg), cfg)
        .filter(F.col("behavioral_anomaly_type").isNotNull()).withColumnRenamed("ip", hot)
        .join(hot_keys, keys, "left")
        .select(*keys, "behavioral_anomaly_type", F.explode(F.sequence(F.lit(0), parts)).alias("_salt"))
    )
    salt = F.pmod(F.xxhash64("timestamp", *[c for c in ("page", "request_id", "status") if c in rows.columns]), F.lit(SALTS)).cast("int")
    spread = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.col("_hot").isNotNull())  # no verdict has a NULL key
    salted = keyed.join(hot_keys, keys, "left").withColumn("_salt", F.when(spread, salt).otherwise(0)).drop("_hot")
    joined = salted.join(verdicts, on=[*keys, "_salt"], how="left").drop("_salt")
    return joined.drop("window_start") if cfg.mode == "windowed" else joined


# A higher rank wins; counts only grow, and with them the rank of a key.
BEHAVIOUR_RANKS = {LOGIN_ATTACK: 3, SCANNING_ACTIVITY: 2, REQUEST_RATE_ANOMALY: 1}
ANOMALY_TYPES = tuple(dict.fromkeys([*(rule[0] for rule in SIGNATURE_RULES), *BEHAVIOUR_RANKS]))  # all that `flag` can give


def ranked_verdict(kind: str) -> Column:
    """Rank of a behaviour verdict, 0 for none."""
    rank = F.lit(0)
    for name, value in BEHAVIOUR_RANKS.items():
        rank = F.when(F.col(kind) == name, value).otherwise(rank)
    return rank


def with_verdict_rows(fact: DataFrame, verdicts: DataFrame, cfg: DetectConfig) -> DataFrame:
    """Fact rows plus `behavioral_anomaly_type` from stored verdicts `(event_month, window_start, ip_id, rank)`, one per key. Months
    are part of the key, so that a filter on them reaches both sides. A key is one address in one window: should its rows fill a
    task nonetheless, Spark's skew join splits them, so the verdicts need not be multiplied, nor held many times by a broadcast."""
    kind = F.lit(None).cast("string")
    for name, value in BEHAVIOUR_RANKS.items():
        kind = F.when(F.col("rank") == value, F.lit(name)).otherwise(kind)
    stored = verdicts.select("event_month", "window_start", "ip_id", kind.alias("behavioral_anomaly_type"))
    return fact.withColumn("window_start", window_start(cfg)).join(stored, ["event_month", "window_start", "ip_id"], "left").drop("window_start")


def combined(joined: DataFrame) -> DataFrame:
    """Add anomaly_type and is_anomaly from the two verdicts."""
    anomaly = F.coalesce(F.col("signature_anomaly_type"), F.col("behavioral_anomaly_type"))
    return joined.withColumns({
        "is_anomaly": F.when(anomaly.isNotNull(), 1).otherwise(0),
        "anomaly_type": F.coalesce(anomaly, F.lit("")),
    })
