import ipaddress
import random

import pytest

from skein.functions.inet import inet_contained_by, inet_text, register, to_inet
from skein.sql import sql


def random_addresses(n):
    r = random.Random(7)
    for _ in range(n):
        if r.random() < 0.5:
            yield f"{ipaddress.ip_address(r.getrandbits(32))}" + r.choice(["", f"/{r.randint(0, 32)}"])
        else:
            v = r.getrandbits(128) & r.choice([(1 << 128) - 1, 0xFFFF, 0xFFFF << 64, (0xFFFF << 112) | 0xFF, 0xFFFF0000FFFF0000FFFF])
            a = ipaddress.IPv6Address(v)
            yield r.choice([str(a), a.exploded, str(a).upper()]) + r.choice(["", f"/{r.randint(0, 128)}"])


def test_parse_and_text(spark):
    given = list(random_addresses(400)) + ["::", "::1", "1::", "::ffff:1.2.3.4", "fe80::1%".rstrip("%"), "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(given)], "i int, s string").select("i", "s", to_inet("s").alias("a")).select("i", "s", "a", inet_text("a").alias("t"))
    for r in df.collect():
        want = ipaddress.ip_interface(r.s)
        assert (r.a.family, bytes(r.a.addr), r.a.prefix) == (want.version, want.ip.packed, want.network.prefixlen), r.s
        back = ipaddress.ip_interface(r.t)
        assert back == want
        if want.version == 4:
            assert r.t == (str(want.ip) if want.network.prefixlen == 32 else str(want))


def test_containment(spark):
    given = list(random_addresses(60)) + ["10.1.2.3", "10.1.0.0/16", "10.0.0.0/8", "0.0.0.0/0", "::/0", "2001:db8::/33", "2001:db8::1"]
    df = spark.createDataFrame([(s,) for s in given], "s string").select("s", to_inet("s").alias("a"))
    other = df.select(df.s.alias("z"), df.a.alias("b"))
    for r in df.crossJoin(other).select("s", "z", inet_contained_by("a", "b").alias("x")).collect():
        a, b = ipaddress.ip_interface(r.s).network, ipaddress.ip_interface(r.z).network
        assert r.x == (a.version == b.version and a.subnet_of(b)), (r.s, r.z)


@pytest.mark.parametrize("bad", ["256.1.1.1", "1.2.3", "1.2.3.4/33", "::1/129", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", ":1:2:3:4:5:6:7", "12345::", "x", "", "1.2.3.4/", "::g"])
def test_bad_addresses_raise(spark, bad):
    with pytest.raises(Exception, match="Failed to parse inet"):
        spark.createDataFrame([(bad,)], "s string").select(to_inet("s")).collect()


def test_null_and_sql_functions(spark):
    register(spark)
    assert spark.sql("SELECT to_inet(NULL) IS NULL, inet_text(to_inet('1.2.3.4/8')), inet_contained_by(to_inet('1.2.3.4'), to_inet('1.0.0.0/8'))").first() == (True, "1.2.3.4/8", True)
    assert sql(spark, "SELECT '1.2.3.4'::inet <<= '1.2.0.0/16'::inet AS a, '1.2.0.0/16'::inet >>= '1.3.0.0'::inet AS b").first() == (True, False)


def test_order_is_unsigned(spark):
    df = spark.createDataFrame([("200.0.0.1",), ("10.0.0.1",), ("::1",)], "s string").orderBy(to_inet("s"))
    assert [r.s for r in df.collect()] == ["10.0.0.1", "200.0.0.1", "::1"]
