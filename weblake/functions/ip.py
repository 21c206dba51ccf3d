"""IP address helpers as Spark column expressions (JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ipv4_to_long(ip: Column | str) -> Column:
    """Dotted quad -> BIGINT; NULL unless exactly four parts of 1-3 digits, each <= 255."""
    c = F.col(ip) if isinstance(ip, str) else ip
    parts = F.split(c, r"\.")
    valid = (F.size(parts) == 4) & F.forall(
        parts, lambda x: x.rlike(r"^[0-9]{1,3}$") & (x.try_cast("int") <= 255)
    )
    num = F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, x: acc * 256 + x.try_cast("bigint"))
    return F.when(c.isNotNull() & valid, num)


MAPPED = r"^::ffff:([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})$"


def plain_ipv4(ip: Column | str) -> Column:
    """An IPv4 address written as IPv6 (`::ffff:1.2.3.4`) as IPv4; anything else as it is."""
    c = F.col(ip) if isinstance(ip, str) else ip
    return F.regexp_replace(c, "(?i)" + MAPPED, "$1")


def ipv6_key(ip: Column | str) -> Column:
    """IPv6 text -> its 32 hexadecimal digits, which sort like the address; NULL for other text. A zone (`%eth0`) is ignored."""
    c = F.col(ip) if isinstance(ip, str) else ip
    text = F.lower(F.split(c, "%")[0])
    halves = F.split(text, "::")

    def groups(half: Column) -> Column:
        return F.array_remove(F.split(F.coalesce(half, F.lit("")), ":"), "")

    left, right = groups(F.get(halves, F.lit(0))), groups(F.get(halves, F.lit(1)))
    missing = 8 - F.size(left) - F.size(right)
    shape = text.rlike("^[0-9a-f:]+$") & ~text.rlike(":::|^:[^:]|[^:]:$") & (
        ((F.size(halves) == 1) & (missing == 0)) | ((F.size(halves) == 2) & (missing > 0)))
    full = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right)
    ok = shape & F.forall(full, lambda g: F.length(g) <= 4)
    return F.when(ok, F.array_join(F.transform(full, lambda g: F.lpad(g, 4, "0")), ""))
