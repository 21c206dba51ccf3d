"""Fixed values that define the semantics; they must stay exactly as written.

Line formats, detection rules, thresholds and sentinels. Patterns are Java
regular expressions, applied with find() semantics (match anywhere).
"""

# --- fixed values: line patterns -------------------------------------------
# access: groups 1 ip, 2 time, 3 method, 4 page, 5 protocol (unused),
#         6 status, 7 bytes, 8 referrer, 9 agent
ACCESS_PATTERN = r'(\S+) - - \[(.*?)\] "(\S+)\s*(\S*)\s*(\S*)" (\d{3}) (\d+) "(.*?)" "(.*?)"'
# error: groups 1 time, 2 level, 3 client address, 4 message
ERROR_PATTERN = r'(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}) \[(\w+)\] .*? client: (\S+), server: .*?, request: ".*?", (.*?), host: ".*?"'
ACCESS_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
ERROR_TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"
# multi-line error records: a new record starts at a line beginning with a date
ERROR_RECORD_START = r"[0-9]{4}/[0-9]{2}/[0-9]{2}"

# --- fixed values: signature rules, first match wins ------------------------
# (anomaly type, column, pattern, case-insensitive)
SIGNATURE_RULES = (
    ("SQL Injection", "page", r"('|%27|--|%2D%2D|union|%75%6E%69%6F%6E)", False),
    ("Path Traversal", "page", r"(\.\./|%2E%2E%2F)", False),
    ("Vulnerability Scan", "page", r"(wp-admin|phpmyadmin|/.git|/solr)", False),
    ("Bad User-Agent", "agent", r"(sqlmap|nikto|nmap|masscan)", False),
)

# --- fixed values: behaviour rules, first match wins, all strict '>' --------
LOGIN_ATTACK = "Login Attack"
SCANNING_ACTIVITY = "Scanning Activity"
REQUEST_RATE_ANOMALY = "Request Rate Anomaly"
LOGIN_ATTACK_THRESHOLD = 10
SCANNING_THRESHOLD = 15
REQUEST_RATE_THRESHOLD = 20
LOGIN_PAGE = "/login"
LOGIN_METHOD = "POST"

# --- fixed values: country sentinels ----------------------------------------
UNKNOWN_COUNTRY = "Unknown"
ERROR_COUNTRY = "Error"

# --- fixed values: shipping --------------------------------------------------
MAX_MESSAGE_BYTES = 1_000_000
