"""Country lookup as a range join on address blocks, and country -> ISO code.

Spark has no native range join: a plain ``ip BETWEEN start AND end`` plans
as a nested loop. Ranges are therefore exploded to fixed address buckets
(the top ``bucket_prefix`` bits) so the join is an equi-join on the bucket
plus a residual ``BETWEEN``. Disjoint ranges explode to at most
``ranges + 2**bucket_prefix`` rows; the exact count is computed from the
(small) range table before deciding:

* at most ``max_broadcast_rows`` bucket rows: broadcast hash join, the event
  side is never shuffled and a hot address cannot skew it;
* otherwise: look up the *distinct* addresses only (a shuffle join on the
  bucket, with no hot key since addresses are unique), then join that
  mapping back on ``ip`` with AQE skew handling.

Blocks of a geo database nest: a country's block holds a customer's elsewhere. The most specific block
holds an address: the smallest, of equal ones the later, of the same block the least country that it is given. An index whose ranges
overlap (one windowed aggregate says so) is flattened first: :func:`flatten_ranges` sweeps the sorted ends of the
blocks that touch a first octet, one task per octet, and gives disjoint ranges, written once to the shared checkpoint
folder. Each address then lies in one range at most, so a lookup never multiplies rows. Ranges without both ends, or that
end before they start, hold nothing; a block without a country makes its addresses unknown.

No match, blank or malformed addresses give ``Unknown``; ``Error`` (a failing
database reader in per-row lookups) cannot occur here.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weblake.functions.ip import ipv4_to_long, ipv6_key, plain_ipv4
from weblake.functions.patterns import ERROR_COUNTRY, UNKNOWN_COUNTRY
from weblake.session import checkpoint_dir

DEFAULT_BUCKET_PREFIX = 16
# ~60 bytes per bucket row: 500k rows is about 30 MB on every executor
DEFAULT_MAX_BROADCAST_ROWS = 500_000


def _shift(bucket_prefix: int) -> int:
    if not 1 <= bucket_prefix <= 32:
        raise ValueError("bucket_prefix must be in 1..32")
    return 32 - bucket_prefix


def bucketed_ranges(ranges: DataFrame, bucket_prefix: int = DEFAULT_BUCKET_PREFIX) -> DataFrame:
    """`(bucket, start_ip, end_ip, country)`, one row per bucket a range touches."""
    s = _shift(bucket_prefix)
    return ranges.select(
        F.explode(F.sequence(F.shiftright("start_ip", s), F.shiftright("end_ip", s))).alias("bucket"),
        "start_ip", "end_ip", "country",
    )


V6_DIGITS = 6  # a bucket is a /24: a block of that size or smaller touches one


def keyed_v6(ranges: DataFrame) -> DataFrame:
    """IPv6 ranges given as text -> ranges of 32 hexadecimal digits, which sort like the addresses."""
    return ranges.select(ipv6_key("start_ip").alias("start_ip"), ipv6_key("end_ip").alias("end_ip"), "country")


def bucketed_ranges_v6(keyed: DataFrame) -> DataFrame:
    """`(bucket, start_ip, end_ip, country)` of keyed IPv6 ranges, one row per bucket a range touches."""
    first, last = (F.conv(F.substring(c, 1, V6_DIGITS), 16, 10).cast("bigint") for c in ("start_ip", "end_ip"))
    return keyed.select(F.explode(F.sequence(first, last)).alias("bucket"), "start_ip", "end_ip", "country")


def _octets(ranges: DataFrame) -> DataFrame:
    """A row per first octet that a range touches (`octet`)."""
    v4 = dict(ranges.dtypes)["start_ip"] != "string"
    first, last = (F.shiftright(c, 24) if v4 else F.conv(F.substring(c, 1, 2), 16, 10).cast("bigint") for c in ("start_ip", "end_ip"))
    return ranges.withColumn("octet", F.explode(F.sequence(first, last)))


def overlapping(ranges: DataFrame) -> bool:
    """Whether two ranges share an address."""
    before = Window.partitionBy("octet").orderBy("start_ip", "end_ip").rowsBetween(Window.unboundedPreceding, -1)
    meets = _octets(ranges).select((F.col("start_ip") <= F.max("end_ip").over(before)).alias("meets"))
    return bool(meets.agg(F.max("meets")).first()[0])


def sweep(blocks: list[tuple[int, int, str]], low: int, high: int) -> Iterator[tuple[int, int, str]]:
    """Disjoint ranges within low..high, in order: at each address the most specific of the blocks."""
    blocks = sorted(blocks, key=lambda b: b[0])
    edges = sorted({low, high + 1, *(e for a, b, _ in blocks for e in (a, b + 1) if low < e <= high)})
    open_blocks: list[tuple] = []
    k, held = 0, None
    for a, b in zip(edges, edges[1:]):
        while k < len(blocks) and blocks[k][0] <= a:
            start, end, country = blocks[k]
            heapq.heappush(open_blocks, (end - start, -start, country is None, country or "", end))
            k += 1
        while open_blocks and open_blocks[0][-1] < a:
            heapq.heappop(open_blocks)
        country = open_blocks[0][3] if open_blocks and not open_blocks[0][2] else None
        if held and held[2] == country:
            held = (held[0], b - 1, country)
        else:
            if held and held[2] is not None:
                yield held
            held = (a, b - 1, country)
    if held and held[2] is not None:
        yield held


def flatten_ranges(ranges: DataFrame) -> DataFrame:
    """Disjoint ranges that say for each address what its most specific block says; IPv4 numbers or IPv6 keys."""
    kind = dict(ranges.dtypes)["start_ip"]
    read: Callable = int if kind != "string" else lambda x: int(x, 16)
    written: Callable = int if kind != "string" else "{:032x}".format
    bits = 24 if kind != "string" else 120

    def flat(group: pd.DataFrame) -> pd.DataFrame:
        octet = int(group["octet"].iloc[0])
        blocks = [(read(a), read(b), c) for a, b, c in zip(group["start_ip"], group["end_ip"], group["country"])]
        rows = [(written(a), written(b), c) for a, b, c in sweep(blocks, octet << bits, (octet + 1 << bits) - 1)]
        return pd.DataFrame(rows, columns=["start_ip", "end_ip", "country"])

    return _octets(ranges).groupBy("octet").applyInPandas(flat, f"start_ip {kind}, end_ip {kind}, country string")


def disjoint(ranges: DataFrame) -> DataFrame:
    """The ranges themselves if no two overlap, else flattened and written to the shared checkpoint folder."""
    ranges = ranges.filter(F.col("start_ip") <= F.col("end_ip")).select("start_ip", "end_ip", "country")
    if not overlapping(ranges):
        return ranges
    checkpoint_dir(ranges.sparkSession)
    return flatten_ranges(ranges).checkpoint(eager=True)


def bucket_row_count(ranges: DataFrame, bucket_prefix: int = DEFAULT_BUCKET_PREFIX) -> int:
    """Exact number of rows :func:`bucketed_ranges` yields (one small aggregate)."""
    s = _shift(bucket_prefix)
    n = ranges.agg(
        F.sum(F.shiftright("end_ip", s) - F.shiftright("start_ip", s) + 1)
    ).first()[0]
    return int(n or 0)


def _nowhere():
    """Bucket of an address that has none: a negative one, so that such addresses spread over the tasks of a join."""
    return -1 - F.pmod(F.xxhash64("ip"), F.lit(1000))


def _range_join_v6(left: DataFrame, buckets: DataFrame) -> DataFrame:
    """Fill `country` where it is unknown from IPv6 buckets."""
    l = left.withColumn("_key", ipv6_key("ip")).withColumn(
        "_bucket", F.coalesce(F.conv(F.substring("_key", 1, V6_DIGITS), 16, 10).cast("bigint"), _nowhere()))
    b = buckets.select(F.col("bucket").alias("_b"), F.col("start_ip").alias("_s"), F.col("end_ip").alias("_e"), F.col("country").alias("_country"))
    cond = (F.col("_bucket") == F.col("_b")) & F.col("_key").between(F.col("_s"), F.col("_e"))
    return l.join(b, cond, "left").withColumn("country", F.coalesce("_country", "country")).drop("_key", "_bucket", "_b", "_s", "_e", "_country")


def _range_join(left: DataFrame, buckets: DataFrame, bucket_prefix: int) -> DataFrame:
    s = _shift(bucket_prefix)
    l = left.withColumn("_ip_num", ipv4_to_long(plain_ipv4("ip"))).withColumn(
        "_bucket", F.coalesce(F.shiftright("_ip_num", s), _nowhere())
    )
    b = buckets.select(
        F.col("bucket").alias("_b"), F.col("start_ip").alias("_s"),
        F.col("end_ip").alias("_e"), F.col("country").alias("_country"),
    )
    cond = (F.col("_bucket") == F.col("_b")) & F.col("_ip_num").between(F.col("_s"), F.col("_e"))
    return (
        l.join(b, cond, "left")
        .withColumn("country", F.coalesce(F.col("_country"), F.lit(UNKNOWN_COUNTRY)))
        .drop("_ip_num", "_bucket", "_b", "_s", "_e", "_country")
    )


@dataclass(frozen=True)
class GeoIndex:
    """Bucketed ranges plus the broadcast decision, built once and reused
    (a stream builds it at start instead of sizing the ranges every batch)."""

    buckets: DataFrame
    rows: int
    bucket_prefix: int
    broadcast: bool
    v6: DataFrame | None = None

    def join(self, df: DataFrame) -> DataFrame:
        """`df` plus `country`, by broadcast or by bucket."""
        side = F.broadcast if self.broadcast else (lambda x: x)
        df = _range_join(df, side(self.buckets), self.bucket_prefix)
        return df if self.v6 is None else _range_join_v6(df, side(self.v6))


def geo_index(ranges, bucket_prefix: int = DEFAULT_BUCKET_PREFIX,
              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, ranges_v6: DataFrame | None = None) -> GeoIndex:
    """Index of IPv4 ranges (numbers) and, if given, IPv6 ranges (text). Pass it wherever ranges are asked for."""
    if isinstance(ranges, GeoIndex):
        return ranges
    ranges = disjoint(ranges)
    v6 = None if ranges_v6 is None else bucketed_ranges_v6(disjoint(keyed_v6(ranges_v6)))
    rows = bucket_row_count(ranges, bucket_prefix) + (v6.count() if v6 is not None else 0)
    return GeoIndex(bucketed_ranges(ranges, bucket_prefix), rows, bucket_prefix,
                    rows <= max_broadcast_rows, v6)


def lookup_countries(
    ips: DataFrame,
    ranges,
    bucket_prefix: int = DEFAULT_BUCKET_PREFIX,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Distinct `ip` values -> `(ip, country)`, one row each. `ranges`: a range table or a GeoIndex."""
    idx = geo_index(ranges, bucket_prefix, max_broadcast_rows)
    return idx.join(ips.select("ip").distinct())


def enrich_country(
    df: DataFrame,
    ranges,
    bucket_prefix: int = DEFAULT_BUCKET_PREFIX,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Rows of `df` plus `country` from their `ip`."""
    idx = geo_index(ranges, bucket_prefix, max_broadcast_rows)
    if idx.broadcast:
        return idx.join(df)
    mapping = idx.join(df.select("ip").distinct())
    return df.join(mapping, on="ip", how="left").withColumn(
        "country", F.coalesce(F.col("country"), F.lit(UNKNOWN_COUNTRY))
    )


def known_country(col: str = "country"):
    """Country present and not a sentinel."""
    c = F.col(col)
    return c.isNotNull() & ~c.isin(UNKNOWN_COUNTRY, ERROR_COUNTRY)


def with_iso(df: DataFrame, codes: DataFrame, col: str = "country") -> DataFrame:
    """Add `iso_alpha3`; rows without a code are dropped (inner join).

    No hint: the code table is an input of unknown size, so Spark's size
    statistics (and AQE's run-time sizes) decide whether to broadcast it.
    """
    return df.join(codes.withColumnRenamed("country", col), on=col, how="inner")
