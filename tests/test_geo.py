"""IPv4 conversion, range join (both strategies), plan shape, ISO lookup."""

from pyspark.sql import functions as F

from conftest import SF01
from weblake.functions.ip import ipv4_to_long, ipv6_key
from weblake.operators import geo
from weblake import fixtures
from weblake.fixtures import read_table


def test_ipv4_to_long(spark):
    vals = ["1.2.3.4", "255.255.255.255", "0.0.0.0", "256.1.1.1", "1.2.3", "1.2.3.4.", "a.b.c.d",
            " 1.2.3.4", "", None, "01.2.3.4"]
    df = spark.createDataFrame([(v,) for v in vals], "ip string")
    got = [r.n for r in df.select(ipv4_to_long("ip").alias("n")).collect()]
    assert got == [16909060, 4294967295, 0, None, None, None, None, None, None, None, 16909060]


def _ranges(spark):
    return spark.createDataFrame(
        [(16777216, 16777471, "A"), (16777472, 16778239, "B"), (3232235520, 3232301055, "C")],
        "start_ip bigint, end_ip bigint, country string")


def test_range_join_both_strategies_agree(spark):
    ips = ["1.0.0.0", "1.0.0.255", "1.0.1.0", "1.0.3.255", "1.0.4.0", "192.168.7.7", "x", None]
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "id int, ip string")
    want = {0: "A", 1: "A", 2: "B", 3: "B", 4: "Unknown", 5: "C", 6: "Unknown", 7: "Unknown"}
    for kw in ({}, {"max_broadcast_rows": 0}, {"bucket_prefix": 8}, {"bucket_prefix": 24}):
        got = {r.id: r.country for r in geo.enrich_country(df, _ranges(spark), **kw).collect()}
        assert got == want, kw


def test_range_join_plan_has_no_nested_loop(spark):
    df = spark.createDataFrame([("1.0.0.1",)], "ip string")
    for kw in ({}, {"max_broadcast_rows": 0}):
        plan = geo.enrich_country(df, _ranges(spark), **kw)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_bucket_row_count_exact(spark):
    r = _ranges(spark)
    assert geo.bucket_row_count(r, 16) == geo.bucketed_ranges(r, 16).count()
    assert geo.bucket_row_count(r, 24) == geo.bucketed_ranges(r, 24).count()


def test_nation_ranges_and_codes(spark):
    nation = read_table(spark, SF01, "nation")
    assert fixtures.geo_ranges_from_nation(nation).count() == 20
    codes = {r.country: r.iso_alpha3 for r in fixtures.country_codes_from_nation(nation).collect()}
    assert codes["NATION_1"] == "N01" and "NATION_6" not in codes


def test_with_iso_drops_unmapped(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2)], "country string, cnt int")
    codes = spark.createDataFrame([("A", "AAA")], "country string, iso_alpha3 string")
    assert [(r.country, r.iso_alpha3) for r in geo.with_iso(df, codes).collect()] == [("A", "AAA")]
    assert geo.known_country() is not None
    assert df.filter(geo.known_country()).count() == 2
    assert spark.createDataFrame([("Unknown",), ("Error",), (None,)], "country string").filter(
        geo.known_country()).count() == 0
    assert F is not None


def test_geo_index_reused(spark):
    idx = geo.geo_index(_ranges(spark), 16)
    assert idx.broadcast and idx.rows == geo.bucketed_ranges(_ranges(spark), 16).count()
    df = spark.createDataFrame([("1.0.1.5",), ("9.9.9.9",)], "ip string")
    assert {r.country for r in geo.enrich_country(df, idx).collect()} == {"B", "Unknown"}
    small = geo.geo_index(_ranges(spark), 16, max_broadcast_rows=0)
    assert not small.broadcast
    assert {r.country for r in geo.lookup_countries(df, small).collect()} == {"B", "Unknown"}


def test_ipv6_keys(spark):
    import ipaddress
    good = ["::", "::1", "1::", "2001:db8::1", "2001:DB8:0:0:0:0:0:1", "fe80::1%eth0", "1:2:3:4:5:6:7:8", "1::8", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "1:2:3:4:5:6:7::"]
    bad = ["", "1.2.3.4", ":::", "1:2:3", "1::2::3", "12345::", "zz::1", "1:2:3:4:5:6:7:8:9", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "1:2:3:4:5:6:7:8::", None]
    rows = spark.createDataFrame([(a,) for a in good + bad], "ip string").select("ip", ipv6_key("ip").alias("k")).collect()
    want = {a: f"{int(ipaddress.IPv6Address(a.split('%')[0])):032x}" for a in good}
    assert {r.ip: r.k for r in rows} == want | {a: None for a in bad}


def test_both_families_by_broadcast_and_by_shuffle(spark):
    v4 = spark.createDataFrame([(1 << 24, (2 << 24) - 1, "FOUR")], "start_ip long, end_ip long, country string")
    v6 = spark.createDataFrame([("2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff", "SIX"), ("2a00::", "2a00:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "WIDE")], "start_ip string, end_ip string, country string")
    df = spark.createDataFrame([(a,) for a in ("1.2.3.4", "::ffff:1.2.3.4", "2001:db8::9", "2001:db9::", "2a00:abcd::1", "nonsense", None)], "ip string")
    want = {"1.2.3.4": "FOUR", "::ffff:1.2.3.4": "FOUR", "2001:db8::9": "SIX", "2001:db9::": "Unknown", "2a00:abcd::1": "WIDE", "nonsense": "Unknown", None: "Unknown"}
    for rows in (1_000_000, 0):
        index = geo.geo_index(v4, max_broadcast_rows=rows, ranges_v6=v6)
        assert {r.ip: r.country for r in geo.enrich_country(df, index).collect()} == want
        assert {r.ip: r.country for r in geo.lookup_countries(df, index).collect()} == want


def _specific(blocks, address):
    """Country of the smallest block that holds the address; of equal sizes the later start, then the least name, one without a name last."""
    held = [(b - a, -a, c is None, c or "", c) for a, b, c in blocks if a <= address <= b]
    return (min(held)[-1] if held else None) or "Unknown"


def test_nested_equal_and_adjacent_blocks_give_one_row(spark):
    import ipaddress
    import random
    made = random.Random(11)
    blocks = [(1 << 24, (3 << 24) - 1, "OUTER"), (1 << 24, (2 << 24) - 1, "INNER"), (1 << 24, (2 << 24) - 1, "EQUAL"), (2 << 24, (2 << 24) + 255, None), (2 << 24, (2 << 24) + 15, "DEEP"),
              ((2 << 24) + 256, (2 << 24) + 511, "NEXT"), (0, (1 << 32) - 1, "WORLD"), (9, 3, "BACKWARDS"), (None, 8, "HALF")]
    for _ in range(300):
        size = 1 << made.randint(0, 26)
        start = made.randrange(0, 1 << 32, size) if made.random() < 0.8 else made.randrange(1 << 32)
        blocks.append((start, min(start + size, 1 << 32) - 1, made.choice(["A", "B", "C", None])))
    whole = [b for b in blocks if b[0] is not None]
    edges = {e for a, b, _ in whole for e in (a, b, a - 1, b + 1) if 0 <= e < 1 << 32}
    ips = {str(ipaddress.IPv4Address(e)): _specific(whole, e) for e in edges}
    six = 0x20010DB8 << 96
    v6 = spark.createDataFrame([(str(ipaddress.IPv6Address(six + (a << 80))) if a is not None else None, str(ipaddress.IPv6Address(six + ((b + 1) << 80) - 1)), c) for a, b, c in
                                ((a and a >> 16, b >> 16, c) for a, b, c in blocks)], "start_ip string, end_ip string, country string")
    v6_blocks = [(six + (a >> 16 << 80), six + ((b >> 16) + 1 << 80) - 1, c) for a, b, c in whole]
    for a, b, _ in v6_blocks:
        ips |= {str(ipaddress.IPv6Address(e)): _specific(v6_blocks, e) for e in (a, b, a - 1, b + 1)}
    v4 = spark.createDataFrame(blocks, "start_ip long, end_ip long, country string")
    df = spark.createDataFrame([(a,) for a in ips], "ip string")
    for rows in (10_000_000, 0):
        index = geo.geo_index(v4, max_broadcast_rows=rows, ranges_v6=v6)
        assert index.broadcast == (rows > 0)
        for found in (geo.lookup_countries(df, index).collect(), geo.enrich_country(df, index).collect()):
            assert len(found) == len(ips) and {r.ip: r.country for r in found} == ips


def test_flat_ranges_are_disjoint_and_disjoint_ones_stay(spark):
    nation = read_table(spark, SF01, "nation")
    assert geo.overlapping(fixtures.nested_ranges_from_nation(nation)) and not geo.overlapping(fixtures.geo_ranges_from_nation(nation))
    assert not geo.overlapping(geo.flatten_ranges(fixtures.nested_ranges_from_nation(nation)))
    assert not geo.overlapping(geo.keyed_v6(fixtures.geo_ranges_v6_from_nation(nation)))


def test_a_lake_of_nested_blocks_keeps_one_row_per_line(spark, tmpdir_path):
    from weblake.operators.detect import PER_BATCH
    from weblake.plans.ingest import process_batch
    from weblake.sources import lake
    nested = fixtures.nested_ranges_from_nation(read_table(spark, SF01, "nation"))
    process_batch(fixtures.read_weblog(spark, "/root/testdata/sf0.001"), 0, tmpdir_path, nested, PER_BATCH)
    star = lake.read_star(spark, tmpdir_path)
    assert star.joined().count() == star.fact.count() > 0
    assert star.dim("dim_ip").count() == star.dim("dim_ip").select("ip_id").distinct().count()
