import ipaddress

from pyspark.sql import functions as F

from rttlab.functions import ip as IP

# The edge_ip fixture of FIXTURES.md.
EDGE_IP = ["1.2.3.4", "0.0.0.0", "255.255.255.255", "256.1.1.1", "1.2.3", "", None,
           "2001:4ba0:ffe0:ffff::4", "::", "::1", "fe80::", "2001:500:1:0:0:0:0:53",
           "1:2:3:4:5:6:7::", "1::2::3", "zz::1", "::ffff:1.2.3.4"]


def _py_v4(s):
    try:
        return int(ipaddress.IPv4Address(s))
    except Exception:
        return 0


def _py_v6(s):
    if s is None or ":" not in s:
        return None
    try:
        return ipaddress.IPv6Address(s).packed.hex().upper()
    except Exception:
        return None


def test_ip_codec_matches_python(spark):
    df = spark.createDataFrame([(x,) for x in EDGE_IP], "ip string")
    rows = df.select("ip", IP.is_ipv6("ip").alias("v6"), IP.ipv4_to_int("ip").alias("v4"),
                     IP.int_to_ipv4(IP.ipv4_to_int("ip")).alias("txt"),
                     F.hex(IP.ipv6_to_bytes("ip")).alias("hex")).collect()
    for r in rows:
        assert r.v4 == _py_v4(r.ip), r
        assert r.hex == _py_v6(r.ip), r
        if r.v4 > 0:
            assert r.txt == r.ip
        else:
            assert r.txt is None
        assert r.v6 == (None if r.ip is None else ":" in r.ip)


def test_int_roundtrip(spark):
    vals = [1, 255, 256, 16777216, 3232235777, 4294967295]
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    out = df.select("x", IP.ipv4_to_int(IP.int_to_ipv4("x")).alias("y")).collect()
    assert all(r.x == r.y for r in out)


def test_display_columns(spark):
    df = spark.createDataFrame([(True, "2001:db8::1", 0, None, None),
                                (False, "10.0.0.1", 167772161, False, 167772162),
                                (False, "10.0.0.1", 167772161, True, 0),
                                (False, "10.0.0.1", 167772161, None, None)],
                               "dst_is_ipv6 boolean, dst_addr string, dst_ipv4_int long, "
                               "src_is_ipv6 boolean, src_ipv4_int long")
    out = df.select(IP.dst_addr_display().alias("d"), IP.src_addr_display().alias("s")).collect()
    assert [r.d for r in out] == ["2001:db8::1", "10.0.0.1", "10.0.0.1", "10.0.0.1"]
    assert [r.s for r in out] == [None, "10.0.0.2", None, None]


def test_ipv6_bytes_as_a_column_of_a_table(spark):
    more = ["2001:DB8::A", "1:2:3:4:5:6:1.2.3.4", "::1.2.3.256", "::.1.2.3", "1:::2", ":", ":::", "::ffff:0:1.2.3.4", "12345::", "g::", "1.2.3.4:5"]
    df = spark.createDataFrame([(x, "mine") for x in EDGE_IP + more], "ip string, kept string")
    out = IP.with_ipv6_bytes(df, "ip", "packed")
    assert out.columns == ["ip", "kept", "packed"]
    for r in out.select("ip", F.hex("packed").alias("hex"), F.hex(IP.ipv6_to_bytes("ip")).alias("again")).collect():
        assert r.hex == r.again == _py_v6(r.ip), r
    plan = IP.with_ipv6_bytes(df, "ip", "packed")._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 6000 and plan.count("lower(") == 1     # no step is repeated
