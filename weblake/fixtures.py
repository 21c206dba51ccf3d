"""Inputs of the registered queries and tests, derived from the driver's tables; nothing else in the library uses them.

The driver's data have no raw logs, so each event becomes one nginx-style line (access, or error for
``event_type = 'error'``); address blocks and country codes come from `nation`. The rules are deterministic and written
the same way in the DuckDB oracle, so both engines see byte-identical lines. They are pure projections: they scale with their
table and never shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# the vocabulary of the derived lines
PAGES = (
    "/", "/shop/kettles", "/shop/lamps", "/shop/rugs?colour=blue", "/basket", "/login", "/orders/latest", "/help/returns",
    "/help/delivery", "/journal/2024/spring", "/about", "/feed.xml", "/api/stock", "/assets/site.js", "/assets/hero.webp",
    "/manuals/kettle.txt",
)
ERROR_MESSAGES = (
    "upstream timed out while reading the response header",
    "cannot open /srv/www/robots.txt: permission denied",
    "client closed the connection while waiting for the request",
    "request body is larger than 8388608 bytes",
)
STATUSES = ((70, 200), (76, 302), (88, 404), (94, 502), (100, 401))  # (below this k, status)
SQLI_PAGE = "/p?id=1%27--"
SPACED_PAGE = "/p?id=1 OR 1=1"
TRAVERSAL_PAGE = "/static/../../etc/passwd"
SCAN_PAGE = "/wp-admin/"
REFERRER_PREFIX = "http://ref.example/"


def _sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _array(values) -> str:
    return "array(" + ", ".join(_sql(v) for v in values) + ")"


# Written as SQL expressions: one call per projection instead of one
# driver-to-JVM call per function (planning cost, not execution cost).
FIELD_EXPRS = [
    "event_id",
    "ts",
    "CASE WHEN event_type = 'error' THEN 'error' ELSE 'access' END AS log_type",
    "concat_ws('.', CAST(1 + user_id % 200 AS STRING), CAST(user_id % 7 AS STRING), "
    "CAST(user_id % 251 AS STRING), CAST(1 + user_id % 250 AS STRING)) AS ip",
    "CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS method",
    f"CASE WHEN event_id % 53 = 0 THEN {_sql(SQLI_PAGE)} WHEN event_id % 59 = 0 THEN {_sql(SPACED_PAGE)} "
    f"WHEN event_id % 61 = 0 THEN {_sql(TRAVERSAL_PAGE)} WHEN event_id % 67 = 0 THEN {_sql(SCAN_PAGE)} "
    f"WHEN event_type = 'signup' THEN '/login' "
    f"ELSE {_array(PAGES)}[CAST(event_id % {len(PAGES)} AS INT)] END AS page",
    "CASE " + " ".join(f"WHEN k < {below} THEN {status}" for below, status in STATUSES) + " END AS status",
    "CAST(floor(value * 100) AS INT) AS bytes",
    f"concat({_sql(REFERRER_PREFIX)}, CAST(event_id % 5 AS STRING)) AS referrer",
    "CASE WHEN event_id % 71 = 0 THEN 'sqlmap/1.7' WHEN event_id % 73 = 0 THEN 'Nikto' "
    "ELSE concat('UA-', CAST(user_id % 17 AS STRING)) END AS agent",
    "CASE WHEN k % 2 = 0 THEN 'error' ELSE 'warn' END AS log_level",
    f"{_array(ERROR_MESSAGES)}[CAST(event_id % {len(ERROR_MESSAGES)} AS INT)] AS error_message",
]

MESSAGE_EXPR = (
    "CASE WHEN log_type = 'access' THEN concat(ip, ' - - [', date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), "
    "' +0000] \"', method, ' ', page, ' HTTP/1.1\" ', CAST(status AS STRING), ' ', "
    "CAST(bytes AS STRING), ' \"', referrer, '\" \"', agent, '\"') "
    "ELSE concat(date_format(ts, 'yyyy/MM/dd HH:mm:ss'), ' [', log_level, "
    "'] 12345#12345: *6789 client: ', ip, ', server: localhost, request: \"GET /x HTTP/1.1\", ', "
    "error_message, ', host: \"localhost:8080\"') END AS message"
)


def weblog_fields(events: DataFrame) -> DataFrame:
    """Per-event line fields (before formatting)."""
    k = events.selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
    return k.selectExpr(*FIELD_EXPRS)


def weblog_lines(events: DataFrame) -> DataFrame:
    """`(event_id, ts, log_type, message)`: one raw log line per event."""
    return weblog_fields(events).selectExpr("event_id", "ts", "log_type", MESSAGE_EXPR)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_weblog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines from `<sf_dir>/events.parquet`."""
    return weblog_lines(read_table(spark, sf_dir, "events"))


def geo_ranges_from_nation(nation: DataFrame) -> DataFrame:
    """Synthetic address blocks for tests: nation n owns first octets 8n+1..8n+8;
    nations with n % 5 = 4 own none (so `Unknown` occurs)."""
    n = F.col("n_nationkey").cast("bigint")
    return nation.filter(F.col("n_nationkey") % 5 != 4).select(
        ((8 * n + 1) * (1 << 24)).alias("start_ip"),
        ((8 * n + 9) * (1 << 24) - 1).alias("end_ip"),
        F.col("n_name").alias("country"),
    )


def geo_ranges_v6_from_nation(nation: DataFrame) -> DataFrame:
    """Synthetic IPv6 blocks for tests: nation n of 0..9 owns 2001:db8:n::/48, but for n % 5 = 4."""
    n = F.col("n_nationkey").cast("string")
    return nation.filter((F.col("n_nationkey") < 10) & (F.col("n_nationkey") % 5 != 4)).select(
        F.concat(F.lit("2001:db8:"), n, F.lit("::")).alias("start_ip"),
        F.concat(F.lit("2001:db8:"), n, F.lit(":ffff:ffff:ffff:ffff:ffff")).alias("end_ip"),
        F.col("n_name").alias("country"),
    )


def country_codes_from_nation(nation: DataFrame) -> DataFrame:
    """Synthetic ISO alpha-3 codes; nations with n % 7 = 6 have none."""
    return nation.filter(F.col("n_nationkey") % 7 != 6).select(
        F.col("n_name").alias("country"),
        F.upper(F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")))
        .alias("iso_alpha3"),
    )


def nested_ranges_from_nation(nation: DataFrame) -> DataFrame:
    """Overlapping blocks: nation n owns the octets of `geo_ranges_from_nation`; inside them the next nation but one owns the second
    octets 2..4, and the third one the second octet 3 and, equal to it, once more. So one address lies in up to four blocks."""
    n, size = F.col("n_nationkey").cast("bigint"), 1 << 24
    base = nation.filter(F.col("n_nationkey") % 5 != 4).select(n.alias("n"), F.explode(F.sequence(8 * n + 1, 8 * n + 8)).alias("octet"))
    inner = base.select(F.explode(F.array(*[
        F.struct((F.col("octet") * size + a * 65536).alias("start_ip"), (F.col("octet") * size + b * 65536 - 1).alias("end_ip"), (F.col("n") + k).alias("owner"))
        for a, b, k in ((2, 5, 2), (3, 4, 3), (3, 4, 4))])).alias("r")).select("r.*", F.concat(F.lit("NATION_"), F.col("owner").cast("string")).alias("country"))
    return geo_ranges_from_nation(nation).unionByName(inner.drop("owner"))


def nested_ranges_v6_from_nation(nation: DataFrame) -> DataFrame:
    """Overlapping IPv6 blocks: those of `geo_ranges_v6_from_nation`, the whole 2001:db8::/32, and the addresses below 1388 (hex) of each /48."""
    n = F.col("n_nationkey").cast("string")
    low = nation.filter(F.col("n_nationkey") < 10).select(
        F.concat(F.lit("2001:db8:"), n, F.lit("::")).alias("start_ip"), F.concat(F.lit("2001:db8:"), n, F.lit("::1387")).alias("end_ip"), F.lit("LOW").alias("country"))
    whole = nation.filter(F.col("n_nationkey") == 0).select(F.lit("2001:db8::").alias("start_ip"), F.lit("2001:db8:ffff:ffff:ffff:ffff:ffff:ffff").alias("end_ip"), F.lit("WIDE").alias("country"))
    return geo_ranges_v6_from_nation(nation).unionByName(low).unionByName(whole)
