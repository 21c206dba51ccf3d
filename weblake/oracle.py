"""DuckDB SQL that states each registered query independently of Spark.

Used by the correctness gate: the same parquet tables are registered as views
(`events`, `nation`, `documents`, ...) and each query here must give the same
rows as the Spark function of the same name. Shared steps are CTE blocks.
Doubles are rounded to 6 places; timestamps are naive UTC.
"""

from __future__ import annotations

import math

from weblake.functions.patterns import ACCESS_PATTERN, ERROR_PATTERN, SIGNATURE_RULES
from weblake.fixtures import ERROR_MESSAGES, PAGES, STATUSES


Z80 = 1.2815515655446004  # standard normal quantile 0.9


def _q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


# raw lines derived from events (same rule as weblake.fixtures)
WEBLOG = f"""
ev AS (
  SELECT event_id AS e, ts, user_id AS u, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
wl AS (
  SELECT e, ts,
    CASE WHEN event_type = 'error' THEN 'error' ELSE 'access' END AS log_type,
    CAST(1 + u % 200 AS VARCHAR) || '.' || CAST(u % 7 AS VARCHAR) || '.' ||
      CAST(u % 251 AS VARCHAR) || '.' || CAST(1 + u % 250 AS VARCHAR) AS ip,
    CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS method,
    CASE WHEN e % 53 = 0 THEN '/p?id=1%27--'
         WHEN e % 59 = 0 THEN '/p?id=1 OR 1=1'
         WHEN e % 61 = 0 THEN '/static/../../etc/passwd'
         WHEN e % 67 = 0 THEN '/wp-admin/'
         WHEN event_type = 'signup' THEN '/login'
         ELSE ({_list(PAGES)})[CAST(e % {len(PAGES)} AS INTEGER) + 1] END AS page,
    CASE {" ".join(f"WHEN k < {below} THEN {status}" for below, status in STATUSES)} END AS status,
    CAST(floor(value * 100) AS INTEGER) AS bytes,
    'http://ref.example/' || CAST(e % 5 AS VARCHAR) AS referrer,
    CASE WHEN e % 71 = 0 THEN 'sqlmap/1.7' WHEN e % 73 = 0 THEN 'Nikto'
         ELSE 'UA-' || CAST(u % 17 AS VARCHAR) END AS agent,
    CASE WHEN k % 2 = 0 THEN 'error' ELSE 'warn' END AS log_level,
    ({_list(ERROR_MESSAGES)})[CAST(e % {len(ERROR_MESSAGES)} AS INTEGER) + 1] AS error_message
  FROM ev
),
lines AS (
  SELECT e AS event_id, ts, log_type,
    CASE WHEN log_type = 'access' THEN
      ip || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "' || method || ' ' ||
      page || ' HTTP/1.1" ' || CAST(status AS VARCHAR) || ' ' || CAST(bytes AS VARCHAR) ||
      ' "' || referrer || '" "' || agent || '"'
    ELSE
      strftime(ts, '%Y/%m/%d %H:%M:%S') || ' [' || log_level ||
      '] 12345#12345: *6789 client: ' || ip ||
      ', server: localhost, request: "GET /x HTTP/1.1", ' || error_message ||
      ', host: "localhost:8080"'
    END AS message
  FROM wl
)"""

_A = _q(ACCESS_PATTERN)
_E = _q(ERROR_PATTERN)

PARSE = f"""
acc_all AS (
  SELECT
    try_strptime(substr(regexp_extract(message, {_A}, 2), 1, 20), '%d/%b/%Y:%H:%M:%S') AS timestamp,
    'access' AS log_type,
    regexp_extract(message, {_A}, 1) AS ip,
    regexp_extract(message, {_A}, 3) AS method,
    regexp_extract(message, {_A}, 4) AS page,
    regexp_extract(message, {_A}, 4) AS request,
    TRY_CAST(regexp_extract(message, {_A}, 6) AS INTEGER) AS status,
    TRY_CAST(regexp_extract(message, {_A}, 7) AS BIGINT) AS bytes,
    regexp_extract(message, {_A}, 8) AS referrer,
    regexp_extract(message, {_A}, 9) AS agent,
    CAST(NULL AS VARCHAR) AS log_level,
    CAST(NULL AS VARCHAR) AS error_message,
    message
  FROM lines WHERE log_type = 'access'
),
err_all AS (
  SELECT
    try_strptime(regexp_extract(message, {_E}, 1), '%Y/%m/%d %H:%M:%S') AS timestamp,
    'error' AS log_type,
    string_split(regexp_extract(message, {_E}, 3), ',')[1] AS ip,
    CAST(NULL AS VARCHAR) AS method,
    CAST(NULL AS VARCHAR) AS page,
    CAST(NULL AS VARCHAR) AS request,
    CAST(NULL AS INTEGER) AS status,
    CAST(NULL AS BIGINT) AS bytes,
    CAST(NULL AS VARCHAR) AS referrer,
    CAST(NULL AS VARCHAR) AS agent,
    regexp_extract(message, {_E}, 2) AS log_level,
    regexp_extract(message, {_E}, 4) AS error_message,
    message
  FROM lines WHERE log_type = 'error'
),
all_events AS (SELECT * FROM acc_all UNION ALL BY NAME SELECT * FROM err_all),
unified AS (
  SELECT timestamp, log_type, ip, method, page, request, status, bytes, referrer, agent,
         log_level, error_message
  FROM all_events WHERE ip <> ''
)"""


def signature_case(page: str = "page", agent: str = "agent") -> str:
    cols = {"page": page, "agent": agent}
    parts = []
    for name, col, pat, ci in SIGNATURE_RULES:
        p = ("(?i)" if ci else "") + pat
        parts.append(f"WHEN regexp_matches({cols[col]}, {_q(p)}) THEN {_q(name)}")
    return "CASE " + " ".join(parts) + " END"


def verdict_case(login: int, scan: int, rate: int) -> str:
    return (
        f"CASE WHEN login_posts > {login} THEN 'Login Attack' "
        f"WHEN distinct_pages > {scan} THEN 'Scanning Activity' "
        f"WHEN request_count > {rate} THEN 'Request Rate Anomaly' END"
    )


def profile_sql(keys: str) -> str:
    return f"""
  SELECT {keys},
    count(*) AS request_count,
    count(DISTINCT page) AS distinct_pages,
    CAST(count_if(page = '/login' AND method = 'POST') AS BIGINT) AS login_posts
  FROM unified WHERE log_type = 'access' GROUP BY ALL"""


def flag_ctes(windowed: bool, login: int, scan: int, rate: int) -> str:
    """`flagged`: unified events + signature/behaviour verdicts, anomaly_type, is_anomaly."""
    if windowed:
        keys, on = "date_trunc('day', timestamp) AS wstart, ip", (
            "v.ip = s.ip AND v.wstart = date_trunc('day', s.timestamp)"
        )
    else:
        keys, on = "ip", "v.ip = s.ip"
    return f"""
sig AS (SELECT *, {signature_case()} AS signature_anomaly_type FROM unified),
prof AS ({profile_sql(keys)}
),
verd AS (SELECT *, {verdict_case(login, scan, rate)} AS behavioral_anomaly_type FROM prof),
flagged0 AS (
  SELECT s.*, v.behavioral_anomaly_type,
         coalesce(s.signature_anomaly_type, v.behavioral_anomaly_type) AS at0
  FROM sig s LEFT JOIN (SELECT * FROM verd WHERE behavioral_anomaly_type IS NOT NULL) v ON {on}
),
flagged AS (
  SELECT * EXCLUDE (at0), CASE WHEN at0 IS NOT NULL THEN 1 ELSE 0 END AS is_anomaly,
         coalesce(at0, '') AS anomaly_type
  FROM flagged0
)"""


GEO = """
geo_ranges AS (
  SELECT CAST((8 * CAST(n_nationkey AS BIGINT) + 1) * 16777216 AS BIGINT) AS start_ip,
         CAST((8 * CAST(n_nationkey AS BIGINT) + 9) * 16777216 - 1 AS BIGINT) AS end_ip,
         n_name AS country
  FROM nation WHERE n_nationkey % 5 <> 4
),
country_codes AS (
  SELECT n_name AS country, upper('N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS iso_alpha3
  FROM nation WHERE n_nationkey % 7 <> 6
)"""


def ip_num_sql(ip: str) -> str:
    """IPv4 text -> BIGINT, NULL when not a dotted quad of 0..255."""
    part = lambda i: f"TRY_CAST(split_part({ip}, '.', {i}) AS BIGINT)"
    ok = (f"regexp_full_match({ip}, '[0-9]{{1,3}}\\.[0-9]{{1,3}}\\.[0-9]{{1,3}}\\.[0-9]{{1,3}}')")
    small = " AND ".join(f"{part(i)} <= 255" for i in range(1, 5))
    num = " + ".join(f"{part(i + 1)} * {256 ** (3 - i)}" for i in range(4))
    return f"CASE WHEN {ok} AND {small} THEN {num} END"


def geo_join(src: str) -> str:
    """Rows of `src` plus `country` (Unknown when no range holds the address)."""
    return f"""
  SELECT x.*, coalesce(g.country, 'Unknown') AS country
  FROM (SELECT *, {ip_num_sql('ip')} AS ip_num FROM {src}) x
  LEFT JOIN geo_ranges g ON x.ip_num BETWEEN g.start_ip AND g.end_ip"""


# star rows used by the reports: windowed (1 day) behaviour, thresholds 1/3/3
STAR_DETECT = dict(windowed=True, login=1, scan=3, rate=3)


def star_ctes() -> str:
    """`star`: flagged events with country, as the star join returns them."""
    return ",".join([
        WEBLOG, PARSE, flag_ctes(**STAR_DETECT), GEO,
        f"""
flagged_geo AS ({geo_join('flagged')}
),
star AS (
  SELECT timestamp, log_type, ip, country, request, method, page, referrer, agent,
         log_level, error_message, status, bytes, is_anomaly,
         CASE WHEN is_anomaly = 1 THEN anomaly_type END AS anomaly_type
  FROM flagged_geo
)""",
    ])


def with_(*blocks: str) -> str:
    return "WITH " + ",".join(blocks)


# ---------------------------------------------------------------- queries
EVENT_COLS = ("timestamp, log_type, ip, method, page, request, status, bytes, referrer, agent, "
              "log_level, error_message")
LIST_FILTER_SQL = ("timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 23:59:59' "
                   "AND status IN (200, 404) AND country IN ('NATION_1', 'NATION_2', 'NATION_3') "
                   "AND method IN ('GET')")
TIME_FILTER_SQL = "timestamp BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-19 23:59:59'"
KNOWN_COUNTRY = "country IS NOT NULL AND country <> 'Unknown' AND country <> 'Error'"


def _base(*extra: str) -> str:
    return with_(WEBLOG, PARSE, *extra)


def _star(*extra: str) -> str:
    return "WITH " + star_ctes() + ("," + ",".join(extra) if extra else "")


def _r(x: str, name: str | None = None) -> str:
    return f"round({x}, 6) AS {name or x}"


_KPI = """
  SELECT count(*) AS total, count(DISTINCT ip) AS unique_ips,
         round(avg(bytes), 6) AS avg_bytes,
         round(CAST(count_if(status >= 500) AS DOUBLE) / count(*) * 100, 6) AS server_error_rate,
         round(CAST(count_if(status >= 400 AND status < 500) AS DOUBLE) / count(*) * 100, 6)
           AS client_error_rate
  FROM star WHERE log_type = 'access'"""

_SERIES = """
series AS (SELECT date_trunc('hour', timestamp) AS ds, count(*) AS y FROM star
           WHERE log_type = 'access' GROUP BY 1)"""

_ACTUALS = """
actuals AS (
  SELECT date_trunc('hour', timestamp) AS hour, count(*) AS actual_requests FROM star
  WHERE log_type = 'access' AND timestamp >= (
    SELECT max(date_trunc('hour', timestamp)) FROM star WHERE log_type = 'access') - INTERVAL 3 DAY
  GROUP BY 1)"""

_FORECAST = f"""{_SERIES},
s AS (SELECT ds, CAST(y AS DOUBLE) AS y,
             (epoch(ds) - epoch((SELECT min(ds) FROM series))) / 3600.0 AS t FROM series),
co AS (SELECT regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM s),
r1 AS (SELECT ds, t, y - ((SELECT a FROM co) + (SELECT b FROM co) * t) AS r1,
              hour(ds) AS hod, dayofweek(ds) AS dow FROM s),
daily AS (SELECT hod, avg(r1) AS daily FROM r1 GROUP BY hod),
r2 AS (SELECT r1.*, r1.r1 - daily.daily AS r2 FROM r1 JOIN daily USING (hod)),
weekly AS (SELECT dow, avg(r2) AS weekly FROM r2 GROUP BY dow),
r3 AS (SELECT r2.r2 - weekly.weekly AS r3 FROM r2 JOIN weekly USING (dow)),
fut AS (SELECT unnest(generate_series(max(ds) + INTERVAL 1 HOUR, max(ds) + INTERVAL 24 HOUR,
                                       INTERVAL 1 HOUR)) AS ds FROM series),
fut2 AS (
  SELECT f.ds,
    (SELECT a FROM co) + (SELECT b FROM co) * ((epoch(f.ds) - epoch((SELECT min(ds) FROM series))) / 3600.0)
      + coalesce(d.daily, 0) + coalesce(w.weekly, 0) AS yhat
  FROM fut f LEFT JOIN daily d ON d.hod = hour(f.ds) LEFT JOIN weekly w ON w.dow = dayofweek(f.ds)
),
pred AS (
  SELECT ds AS timestamp, yhat AS predicted_requests,
         yhat - {Z80!r} * (SELECT stddev_samp(r3) FROM r3) AS predicted_lower,
         yhat + {Z80!r} * (SELECT stddev_samp(r3) FROM r3) AS predicted_upper
  FROM fut2 WHERE ds > (SELECT max(ds) FROM series)
)"""

_PRED_COLS = ("timestamp, round(predicted_requests, 6) AS predicted_requests, "
              "round(predicted_lower, 6) AS predicted_lower, round(predicted_upper, 6) AS predicted_upper")

_PEAK = """
peak AS (SELECT timestamp AS hour, predicted_requests, predicted_upper FROM pred
         ORDER BY predicted_upper DESC, timestamp ASC LIMIT 1)"""

_MULTILINE = """
WITH l AS (
  SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
),
s AS (
  SELECT doc_id, pos, line,
         sum(CASE WHEN regexp_matches(line, '^[A-Z]') THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rec
  FROM l
)
SELECT doc_id, CAST(rec AS INTEGER) AS rec, string_agg(line, chr(10) ORDER BY pos) AS record
FROM s GROUP BY doc_id, rec"""


def _dim_sql(cols: str, where: str) -> str:
    return _star() + f" SELECT DISTINCT {cols} FROM star WHERE {where}"


def _integrity() -> str:
    dims = [
        ("dim_ip", "ip", "ip IS NOT NULL", "ip"),
        ("dim_request", "request, method, page, referrer",
         "request IS NOT NULL AND method IS NOT NULL AND page IS NOT NULL AND referrer IS NOT NULL",
         "(request, method, page, referrer)"),
        ("dim_user_agent", "agent", "agent IS NOT NULL", "agent"),
        ("dim_error_details", "log_level, error_message",
         "log_type = 'error' AND log_level IS NOT NULL AND error_message IS NOT NULL",
         "(log_level, error_message)"),
        ("dim_anomaly_type", "anomaly_type", "is_anomaly = 1", "anomaly_type"),
    ]
    parts = [
        f"SELECT '{n}' AS dim, count(DISTINCT {k}) AS n_rows, count(DISTINCT {k}) AS n_ids, "
        f"count(DISTINCT {k}) AS n_keys, CAST(0 AS BIGINT) AS orphan_refs FROM star WHERE {w}"
        for n, _, w, k in dims
    ]
    return _star() + " " + " UNION ALL ".join(parts)


def _fourier(keyed: str) -> str:
    """`pred`: the Fourier regression of each key's series `(key, ds, y)`, its normal equations solved by Gauss-Jordan elimination."""
    waves = [f"{f}({v} * {2 * math.pi * k / n!r})" for v, n, most in (("hod", 24.0, 4), ("how", 168.0, 3)) for k in range(1, most + 1) for f in ("sin", "cos")]
    p = 2 + len(waves)
    features = "[1.0, (epoch(ds) - epoch(t0)) / 3600.0 / greatest(span, 1.0), " + ", ".join(waves) + "]"
    parts = "CAST(hour(ds) AS DOUBLE) AS hod, CAST(dayofweek(ds) * 24 + hour(ds) AS DOUBLE) AS how"
    return _star(_SERIES, f"""
keyed AS ({keyed}),
spans AS (SELECT key, min(ds) AS t0, (epoch(max(ds)) - epoch(min(ds))) / 3600.0 AS span, count(*) AS n FROM keyed GROUP BY key HAVING count(*) >= 2),
design AS (SELECT key, CAST(y AS DOUBLE) AS y, {features} AS f FROM (SELECT *, {parts} FROM keyed JOIN spans USING (key))),
sums AS (SELECT key, i, j, sum(f[i] * CASE WHEN j > {p} THEN y ELSE f[j] END) AS v FROM design, range(1, {p + 1}) a(i), range(1, {p + 2}) b(j) GROUP BY key, i, j),
matrix AS (SELECT key, list(line ORDER BY i) AS m FROM (SELECT key, i, list(v ORDER BY j) AS line FROM sums GROUP BY key, i) GROUP BY key),
solving AS (
  SELECT key, 1 AS k, m FROM matrix
  UNION ALL
  SELECT key, k + 1, list_transform(range(1, {p + 1}), lambda i: CASE WHEN i = k THEN list_transform(m[k], lambda x: x / m[k][k])
    ELSE list_transform(range(1, {p + 2}), lambda j: m[i][j] - m[i][k] * m[k][j] / m[k][k]) END) FROM solving WHERE k <= {p}
),
coef AS (SELECT key, list_transform(m, lambda line: line[{p + 1}]) AS b FROM solving WHERE k = {p + 1}),
spread AS (SELECT key, stddev_samp(y - list_dot_product(f, b)) AS sigma FROM design JOIN coef USING (key) GROUP BY key),
future AS (SELECT *, {parts} FROM (SELECT *, last + to_hours(CAST(h AS INTEGER)) AS ds FROM spans, (SELECT max(ds) AS last FROM keyed), range(1, 25) r(h))),
yhat AS (SELECT key, ds, list_dot_product({features}, b) AS yhat, sigma FROM future JOIN coef USING (key) JOIN spread USING (key)),
pred AS (SELECT key, ds AS timestamp, yhat AS predicted_requests, yhat - {Z80} * sigma AS predicted_lower, yhat + {Z80} * sigma AS predicted_upper FROM yhat)""").replace("WITH", "WITH RECURSIVE", 1)


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["envelope_decode"] = ("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k "
                            "FROM events")
    q["envelope_roundtrip"] = with_(WEBLOG) + " SELECT event_id, log_type, message FROM lines"
    q["multiline_stitch"] = _MULTILINE
    q["oversize_filter"] = ("SELECT doc_id, strlen(text) AS n_bytes FROM documents "
                            "WHERE strlen(text) <= 2000")
    q["multiline_stitch_lines"] = _MULTILINE
    q["multiline_stitch_parts"] = """
      WITH lines AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS line FROM documents),
      numbered AS (SELECT *, sum(CAST(regexp_matches(line, '^[A-D]') AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS rec FROM lines),
      sized AS (SELECT *, coalesce(sum(strlen(line) + 1) OVER (PARTITION BY doc_id, rec ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM numbered)
      SELECT doc_id, CAST(rec AS INTEGER) AS rec, CAST(before // 500 AS BIGINT) AS part, string_agg(line, chr(10) ORDER BY i) AS record
      FROM sized GROUP BY doc_id, rec, before // 500"""
    q["windowed_flags_from_cuts"] = _star() + " SELECT timestamp, log_type, ip, status, is_anomaly, anomaly_type FROM star"
    q["ingest_conservation"] = _base() + """,
      broken AS (SELECT event_id AS e, CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 109 = 0 THEN 'other' ELSE log_type END AS log_type,
                        message IS NULL OR event_id % 101 = 0 OR event_id % 107 = 0 OR event_id % 103 = 0 OR event_id % 109 = 0 AS broken, log_type AS kind, message FROM lines),
      parsed AS (SELECT b.*, NOT broken AND b.message IN (SELECT message FROM all_events WHERE ip <> '') AS ok FROM broken b)
      SELECT coalesce(log_type, '(none)') AS log_type, count(*) AS n_input, CAST(count_if(ok) AS BIGINT) AS n_fact,
             CAST(count_if(NOT ok) AS BIGINT) AS n_quarantine, CAST(count_if(ok AND e % 97 = 0 AND kind = 'access') AS BIGINT) AS n_untimed, true AS conserved
      FROM parsed GROUP BY 1"""
    q["dim_ip_refresh"] = _star() + (
        " SELECT DISTINCT ip, CASE WHEN country = 'Unknown' THEN country ELSE country || '_NEW' END AS country FROM star WHERE ip IS NOT NULL")
    q["month_partition_counts"] = _star() + (
        " SELECT strftime(timestamp, '%Y%m') AS event_month, count(*) AS rows FROM star GROUP BY 1")
    q["replacing_dedupe"] = ("SELECT * FROM events QUALIFY row_number() OVER "
                             "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
    q["quarantine"] = _base() + " SELECT log_type, message FROM all_events WHERE ip = ''"
    q["parse_access"] = _base() + f" SELECT {EVENT_COLS} FROM unified WHERE log_type = 'access'"
    q["parse_error"] = _base() + f" SELECT {EVENT_COLS} FROM unified WHERE log_type = 'error'"
    q["unified_events"] = _base() + f" SELECT {EVENT_COLS} FROM unified"
    q["signature_flags"] = _base() + (
        f" SELECT {EVENT_COLS}, {signature_case()} AS signature_anomaly_type FROM unified")
    q["behavioral_profile"] = _base(f"prof AS ({profile_sql('ip')})") + " SELECT * FROM prof"
    q["behavioral_verdict"] = _base(f"prof AS ({profile_sql('ip')})") + (
        f" SELECT *, {verdict_case(10, 15, 20)} AS behavioral_anomaly_type FROM prof")
    day_keys = "date_trunc('day', timestamp) AS window_start, ip"
    q["behavioral_windowed"] = _base(f"prof AS ({profile_sql(day_keys)})") + (
        f" SELECT *, {verdict_case(1, 3, 3)} AS behavioral_anomaly_type FROM prof")
    q["anomaly_flagging"] = _base(flag_ctes(False, 10, 15, 20)) + (
        f" SELECT {EVENT_COLS}, signature_anomaly_type, behavioral_anomaly_type, anomaly_type, "
        "is_anomaly FROM flagged")
    q["geo_enrich"] = _base(GEO, f"g AS ({geo_join('unified')})") + (
        f" SELECT {EVENT_COLS}, country FROM g")
    q["geo_enrich_v6"] = with_(WEBLOG, GEO, f"""
      a AS (SELECT e AS event_id, ip, split_part(ip, '.', 2) AS k,
                   CASE WHEN e % 5 = 0 THEN '::ffff:' || ip WHEN e % 5 = 1 THEN 'zz::1' WHEN e % 5 = 2 THEN ip
                        ELSE '2001:db8:' || split_part(ip, '.', 2) || '::' || CAST(e % 9999 AS VARCHAR) END AS address FROM wl),
      g AS ({geo_join('a')})""") + """
      SELECT g.event_id, g.address AS ip, CASE WHEN g.event_id % 5 IN (0, 2) THEN g.country WHEN g.event_id % 5 = 1 THEN 'Unknown'
             ELSE coalesce(n.n_name, 'Unknown') END AS country
      FROM g LEFT JOIN nation n ON n.n_nationkey = CAST(g.k AS BIGINT) AND n.n_nationkey < 10 AND n.n_nationkey % 5 <> 4"""
    q["geo_enrich_nested"] = with_(WEBLOG, GEO, f"""
      octets AS (SELECT CAST(n_nationkey AS BIGINT) AS n, unnest(range(8 * CAST(n_nationkey AS BIGINT) + 1, 8 * CAST(n_nationkey AS BIGINT) + 9)) AS o FROM nation WHERE n_nationkey % 5 <> 4),
      four AS (SELECT * FROM geo_ranges
               UNION ALL SELECT o * 16777216 + 2 * 65536, o * 16777216 + 5 * 65536 - 1, 'NATION_' || CAST(n + 2 AS VARCHAR) FROM octets
               UNION ALL SELECT o * 16777216 + 3 * 65536, o * 16777216 + 4 * 65536 - 1, 'NATION_' || CAST(n + 3 AS VARCHAR) FROM octets
               UNION ALL SELECT o * 16777216 + 3 * 65536, o * 16777216 + 4 * 65536 - 1, 'NATION_' || CAST(n + 4 AS VARCHAR) FROM octets),
      a AS (SELECT e, CASE WHEN e % 3 = 0 THEN '2001:db8:' || CAST(u % 13 AS VARCHAR) || '::' || CAST(e % 9999 AS VARCHAR) ELSE ip END AS ip,
                   CASE WHEN e % 3 > 0 THEN {ip_num_sql('ip')} END AS ip_num, u % 13 AS block, CAST('0x' || CAST(e % 9999 AS VARCHAR) AS BIGINT) AS host FROM wl JOIN (SELECT e, u FROM ev) USING (e))""") + """
      SELECT a.e AS event_id, any_value(a.ip) AS ip, CASE
        WHEN a.e % 3 > 0 THEN coalesce(arg_min(four.country, (end_ip - start_ip, -start_ip, four.country)), 'Unknown')
        WHEN any_value(block) < 10 AND any_value(host) < 5000 THEN 'LOW'
        ELSE coalesce(any_value(n_name), 'WIDE') END AS country
      FROM a LEFT JOIN four ON ip_num BETWEEN start_ip AND end_ip LEFT JOIN nation ON n_nationkey = block AND block < 10 AND block % 5 <> 4
      GROUP BY a.e"""
    q["country_iso"] = _base(GEO, f"g AS ({geo_join('unified')})") + (
        f" SELECT DISTINCT g.country, c.iso_alpha3 FROM g JOIN country_codes c USING (country) "
        f"WHERE {KNOWN_COUNTRY.replace('country', 'g.country')}")
    q["dim_ip"] = _dim_sql("ip, country", "ip IS NOT NULL")
    q["dim_request"] = _dim_sql(
        "request, method, page, referrer",
        "request IS NOT NULL AND method IS NOT NULL AND page IS NOT NULL AND referrer IS NOT NULL")
    q["dim_user_agent"] = _dim_sql("agent", "agent IS NOT NULL")
    q["dim_error_details"] = _dim_sql(
        "log_level, error_message",
        "log_type = 'error' AND log_level IS NOT NULL AND error_message IS NOT NULL")
    q["dim_anomaly_type"] = _dim_sql("anomaly_type", "is_anomaly = 1")
    q["fact_build"] = _star() + """ SELECT timestamp, log_type, status, bytes, is_anomaly,
        strftime(timestamp, '%Y%m') AS event_month,
        ip IS NOT NULL AS has_ip_id,
        (request IS NOT NULL AND method IS NOT NULL AND page IS NOT NULL AND referrer IS NOT NULL)
          AS has_request_id,
        agent IS NOT NULL AS has_agent_id,
        (log_type = 'error' AND log_level IS NOT NULL AND error_message IS NOT NULL)
          AS has_error_details_id,
        is_anomaly = 1 AS has_anomaly_type_id
      FROM star"""
    q["star_join"] = _star() + " SELECT * FROM star"
    q["surrogate_key_integrity"] = _integrity()
    q["uniq_approx_within_bound"] = _base() + (
        " SELECT count(DISTINCT ip) AS exact_unique_ips, true AS within_bound "
        "FROM unified WHERE log_type = 'access'")
    q["filter_time_range"] = _star() + (
        f" SELECT timestamp, log_type, ip, page, status FROM star WHERE {TIME_FILTER_SQL}")
    q["filter_in_lists"] = _star() + _KPI.replace(
        "WHERE log_type = 'access'", f"WHERE log_type = 'access' AND {LIST_FILTER_SQL}")
    q["kpi_summary"] = _star() + _KPI
    q["time_bounds"] = _star() + " SELECT min(timestamp) AS min_ts, max(timestamp) AS max_ts FROM star"
    q["distinct_statuses"] = _star() + " SELECT DISTINCT status FROM star WHERE status IS NOT NULL"
    q["distinct_countries"] = _star() + f" SELECT DISTINCT country FROM star WHERE {KNOWN_COUNTRY}"
    q["distinct_methods"] = _star() + (
        " SELECT DISTINCT method FROM star WHERE method IS NOT NULL AND method <> ''")
    q["requests_by_class_per_minute"] = _star() + """
      SELECT date_trunc('minute', timestamp) AS minute,
        CAST(count_if(status >= 200 AND status < 300) AS BIGINT) AS success_2xx,
        CAST(count_if(status >= 300 AND status < 400) AS BIGINT) AS redirects_3xx,
        CAST(count_if(status >= 400 AND status < 500) AS BIGINT) AS client_errors_4xx,
        CAST(count_if(status >= 500) AS BIGINT) AS server_errors_5xx
      FROM star WHERE log_type = 'access' GROUP BY 1"""
    q["avg_bytes_per_minute"] = _star() + """
      SELECT date_trunc('minute', timestamp) AS minute, round(avg(bytes), 6) AS avg_bytes
      FROM star WHERE log_type = 'access' GROUP BY 1"""
    q["requests_by_country"] = _star() + f"""
      SELECT s.country, count(*) AS cnt, c.iso_alpha3 AS iso_alpha
      FROM star s JOIN country_codes c ON c.country = s.country
      WHERE {KNOWN_COUNTRY.replace('country', 's.country')} GROUP BY s.country, c.iso_alpha3"""
    q["error_rate_by_country"] = _star() + f"""
      SELECT s.country, CAST(count_if(s.status >= 400) AS BIGINT) AS error_count, count(*) AS total_count,
        round(CAST(count_if(s.status >= 400) AS DOUBLE) / count(*) * 100, 6) AS error_rate,
        c.iso_alpha3 AS iso_alpha
      FROM star s JOIN country_codes c ON c.country = s.country
      WHERE {KNOWN_COUNTRY.replace('country', 's.country')}
      GROUP BY s.country, c.iso_alpha3 HAVING count(*) > 0"""
    q["top_pages"] = _star() + """
      SELECT page, count(*) AS hits FROM star WHERE log_type = 'access' GROUP BY page
      ORDER BY hits DESC, page ASC NULLS FIRST LIMIT 10"""
    q["top_ips_by_traffic"] = _star() + """
      SELECT ip, round(sum(bytes) / 1024 / 1024, 6) AS total_mb FROM star WHERE log_type = 'access'
      GROUP BY ip ORDER BY sum(bytes) / 1024 / 1024 DESC NULLS LAST, ip ASC NULLS FIRST LIMIT 10"""
    q["status_distribution"] = _star() + (
        " SELECT status, count(*) AS cnt FROM star WHERE log_type = 'access' GROUP BY status")
    q["top_ips_by_errors"] = _star() + """
      SELECT ip, count(*) AS errors FROM star WHERE status >= 400 GROUP BY ip
      ORDER BY errors DESC, ip ASC NULLS FIRST LIMIT 10"""
    heat = """
top AS (SELECT page FROM star GROUP BY page ORDER BY count(*) DESC, page ASC NULLS FIRST LIMIT 15),
heat AS (SELECT page, status, count(*) AS "count" FROM star
         WHERE page IN (SELECT page FROM top) AND status >= 400 GROUP BY page, status)"""
    q["error_heatmap"] = _star(heat) + " SELECT * FROM heat"
    grid = """
grid AS (
  SELECT p.page, s.status, coalesce(h."count", 0) AS "count"
  FROM (SELECT DISTINCT page FROM heat) p CROSS JOIN (SELECT DISTINCT status FROM heat) s
  LEFT JOIN heat h ON h.page = p.page AND h.status = s.status)"""
    cells = ", ".join(f'max("count") FILTER (status = {s}) AS "{s}"' for s in sorted(s for _, s in STATUSES if s >= 400))  # the statuses of the derived lines
    q["error_heatmap_pivot"] = _star(heat, grid) + f" SELECT page, {cells} FROM grid GROUP BY page"
    q["anomaly_timeline"] = _star() + """
      SELECT timestamp, ip, anomaly_type FROM star WHERE is_anomaly = 1 AND anomaly_type <> ''
      ORDER BY timestamp DESC, ip, anomaly_type LIMIT 500"""
    q["anomaly_by_type"] = _star() + """
      SELECT anomaly_type, count(*) AS cnt FROM star WHERE is_anomaly = 1 AND anomaly_type <> ''
      GROUP BY anomaly_type"""
    q["anomaly_summary"] = _star() + """
      SELECT ip, country, anomaly_type, max(timestamp) AS last_seen, count(*) AS request_count
      FROM star WHERE is_anomaly = 1 AND anomaly_type <> '' GROUP BY ip, country, anomaly_type
      ORDER BY last_seen DESC, ip, anomaly_type LIMIT 20"""
    q["top_error_messages"] = _star() + """
      SELECT error_message, count(*) AS cnt FROM star WHERE log_type = 'error'
      GROUP BY error_message ORDER BY cnt DESC, error_message ASC NULLS FIRST LIMIT 10"""
    q["error_levels_per_minute"] = _star() + """
      SELECT date_trunc('minute', timestamp) AS minute,
        CAST(count_if(log_level = 'error') AS BIGINT) AS errors, CAST(count_if(log_level = 'warn') AS BIGINT) AS warnings
      FROM star WHERE log_type = 'error' GROUP BY 1"""
    q["recent_errors"] = _star() + """
      SELECT timestamp, ip, country, log_level, error_message FROM star WHERE log_type = 'error'
      ORDER BY timestamp DESC, ip, error_message LIMIT 100"""
    q["hourly_actuals"] = _star(_ACTUALS) + " SELECT * FROM actuals"
    q["hourly_series"] = _star(_SERIES) + " SELECT * FROM series"
    q["hourly_series_filled"] = _star(_SERIES) + """
      SELECT h.ds, coalesce(s.y, 0) AS y FROM (SELECT unnest(generate_series(min(ds), max(ds), INTERVAL 1 HOUR)) AS ds FROM series) h
      LEFT JOIN series s ON s.ds = h.ds"""
    features = ["constant", "t"] + [f"d_{f}{k}" for k in range(1, 5) for f in ("sin", "cos")] + [f"w_{f}{k}" for k in range(1, 4) for f in ("sin", "cos")]
    q["fourier_normal_equations"] = _star(_SERIES) + (
        f" SELECT feature, (SELECT count(*) FROM series) AS n_rows, true AS orthogonal FROM (SELECT unnest({_list(features)}) AS feature)")
    q["forecast_fourier"] = _fourier("SELECT '' AS key, ds, y FROM series") + f" SELECT {_PRED_COLS} FROM pred"
    q["forecast_by_country"] = _fourier("SELECT country AS key, date_trunc('hour', timestamp) AS ds, count(*) AS y FROM star WHERE log_type = 'access' GROUP BY ALL") + (
        f" SELECT key AS country, {_PRED_COLS} FROM pred")
    q["forecast_additive"] = _star(_FORECAST) + f" SELECT {_PRED_COLS} FROM pred"
    q["forecast_read"] = _star(_FORECAST) + (
        f" SELECT {_PRED_COLS.replace('timestamp,', 'timestamp AS hour,', 1)} FROM pred")
    q["forecast_peak"] = _star(_FORECAST, _PEAK) + (
        " SELECT hour, round(predicted_requests, 6) AS predicted_requests, "
        "round(predicted_upper, 6) AS predicted_upper FROM peak")
    q["load_p95"] = _star(_ACTUALS) + (
        " SELECT round(quantile_cont(CAST(actual_requests AS DOUBLE), 0.95), 6) AS p95 FROM actuals")
    q["scaling_advice"] = _star(_FORECAST, _PEAK, _ACTUALS) + """
      SELECT hour, round(predicted_requests, 6) AS predicted_requests,
        round(predicted_upper, 6) AS predicted_upper,
        round((SELECT quantile_cont(CAST(actual_requests AS DOUBLE), 0.95) FROM actuals), 6)
          AS critical_threshold,
        predicted_upper > (SELECT quantile_cont(CAST(actual_requests AS DOUBLE), 0.95) FROM actuals)
          AS scale_up
      FROM peak"""
    q["actual_vs_forecast"] = _star(_FORECAST, _ACTUALS) + """
      SELECT hour, round(CAST(actual_requests AS DOUBLE), 6) AS requests, 'actual' AS type FROM actuals
      UNION ALL
      SELECT timestamp AS hour, round(predicted_requests, 6) AS requests, 'forecast' AS type FROM pred"""
    return q
