import ipaddress

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rillflow.functions import ip as ips
from rillflow.plans import filters
from rillflow.schema import KIND

ROWS = [("10.0.0.1", "192.168.1.1", 53, 1000, 10, 0.5, "alpha"), ("10.0.0.9", "10.0.0.1", 1234, 53, 20, 1.5, "beta"), ("2001:db8::1", "2001:db8::2", 80, 443, 0, 2.5, ""), ("172.16.3.4", "8.8.8.8", 443, 80, 7, -1.0, "gamma")]


@pytest.fixture(scope="module")
def df(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(i, bytearray(ips.packed(r[0])), bytearray(ips.packed(r[1])), *r[2:]) for i, r in enumerate(ROWS)], "id long, SRC_IP binary, DST_IP binary, SRC_PORT int, DST_PORT int, BYTES long, SCALE double, NAME string")
    return rows.withColumn("SRC_IP", F.col("SRC_IP").alias("SRC_IP", metadata={KIND: "ipaddr"})).cache()


def met(df, text):
    return sorted(r["id"] for r in filters.matching(df, text).select("id").collect())


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("", [0, 1, 2, 3]),
        ("SRC_IP == 10.0.0.0/16", [0, 1]),
        ("SRC_IP != 10.0.0.0/16", [2, 3]),
        ("SRC_IP < 10.0.0.0/16", [2]),
        ("SRC_IP > 10.0.0.0/16", [2, 3]),
        ("SRC_IP in [10.0.0.0/30, 2001:db8::/64]", [0, 2]),
        ("host in [10.0.0.1, 8.8.8.8]", [0, 1, 3]),
        ("host == 10.0.0.1", [0, 1]),
        ("host != 10.0.0.1", [2, 3]),
        ("port == 53", [0, 1]),
        ("port in [80, 1000]", [0, 2, 3]),
        ("port != 53", [0, 1, 2, 3]),
        ("BYTES > 5 OR BYTES == 0 AND SRC_PORT == 80", [2]),
        ("BYTES > 5 OR (BYTES == 0 AND SRC_PORT == 80)", [0, 1, 2, 3]),
        ("NOT BYTES > 5 OR SRC_PORT == 53", [0, 2]),
        ("SCALE == 1.5 || SCALE != 0.5 && SCALE < 0", [3]),
        ("SCALE in [0.5, 2.5]", [0, 2]),
        ('NAME == "beta" or NAME =~ "^g"', [1, 3]),
        ("MISSING == 1", []),
        ("NOT MISSING == 1", [0, 1, 2, 3]),
        ('BYTES == "x"', []),
    ],
)
def test_known_filters(df, text, expected):
    assert met(df, text) == expected


@pytest.mark.parametrize("text", ["SRC_IP ==", "SRC_IP in [1.2.3.4, 5]", "SRC_IP in [", "(BYTES == 1", "BYTES == 1 BYTES == 2", "SRC_IP == 300.1.1.1", "? == 1"])
def test_no_filters(text):
    with pytest.raises(filters.FilterError):
        filters.parse(text)


def python_value(tree, row):
    if isinstance(tree, filters.Truth):
        return tree.value
    if isinstance(tree, filters.Not):
        return not python_value(tree.inner, row)
    if isinstance(tree, filters.Both):
        a, b = python_value(tree.left, row), python_value(tree.right, row)
        return (a and b) if tree.op == "and" else (a or b)
    v = row[tree.name]
    if tree.op == "in":
        return v in [int(t.text) for t in tree.value]
    n = int(tree.value.text)
    return {"==": v == n, "!=": v != n, "<": v < n, "<=": v <= n, ">": v > n, ">=": v >= n}[tree.op]


atom = st.builds(lambda c, o, n: f"{c} {o} {n}", st.sampled_from(["BYTES", "SRC_PORT", "DST_PORT"]), st.sampled_from(["==", "!=", "<", "<=", ">", ">="]), st.sampled_from([0, 7, 10, 53, 80, 443]))
tree = st.recursive(atom, lambda x: st.one_of(st.builds("({} AND {})".format, x, x), st.builds("{} or {}".format, x, x), st.builds("NOT {}".format, x), st.builds("({} || {} && {})".format, x, x, x)), max_leaves=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tree)
def test_as_plain_python(df, text):
    names = ["SRC_IP", "DST_IP", "SRC_PORT", "DST_PORT", "BYTES", "SCALE", "NAME"]
    expected = [i for i, r in enumerate(ROWS) if python_value(filters.parse(text), dict(zip(names, r, strict=True)))]
    assert met(df, text) == expected


PREFIX_CASES = [("1.2.3.4", "1.2.2.0/23", True), ("1.2.4.4", "1.2.2.0/23", False), ("1.2.3.200", "1.2.3.128/25", True), ("1.2.3.4", "1.2.3.4/32", True), ("1.2.3.5", "1.2.3.4/32", False), ("1.2.3.4", "0.0.0.0/0", True), ("1.2.3.4", "::/0", False), ("ffff::1", "::/0", True), ("ffff::1", "fffe::/15", True), ("fffd::1", "fffe::/15", False), ("2001:db8::1", "2001:db8::/64", True), ("2001:db8:0:1::1", "2001:db8::/64", False), ("2001:db8::1", "2001:db8::1/128", True), ("::ffff:1.2.3.4", "1.2.3.4/32", False)]


def test_prefixes(spark):
    from pyspark.sql import functions as F

    for text, prefix, expected in PREFIX_CASES:
        df = spark.createDataFrame([(bytearray(ips.packed(text)),)], "ip binary")
        assert df.select(ips.within(F.col("ip"), prefix)).first()[0] is expected, (text, prefix)


def test_addresses(spark):
    from pyspark.sql import functions as F

    texts = ["0.0.0.0", "255.1.2.3", "::", "::1", "1::", "2001:db8::8:0:0:1", "1:0:0:2:0:0:0:3", "fe80::1:2:3:4", "1:2:3:4:5:6:7:8", "0:1:0:1:0:1:0:1", "1:0:0:4:5:0:0:8"]
    bad = ["", "1.2.3", "1.2.3.4.5", "256.1.1.1", "1:2:3", ":::", "1::2::3", "12345::", "x", ":1:2:3:4:5:6:7"]
    df = spark.createDataFrame([(t,) for t in texts + bad + ["::ffff:1.2.3.4"]], "t string")
    got = {r["t"]: (r["p"], r["back"], r["m"]) for r in df.select("t", ips.parse(F.col("t")).alias("p")).select("t", "p", ips.text(F.col("p")).alias("back"), ips.mask(F.col("p"), 13, 45).alias("m")).collect()}
    for t in texts:
        p = ipaddress.ip_address(t)
        assert bytes(got[t][0]) == p.packed and ipaddress.ip_address(got[t][1]) == p and got[t][1] == str(p), (t, got[t])
        assert bytes(got[t][2]) == ipaddress.ip_network((p, 13 if p.version == 4 else 45), strict=False).network_address.packed
    assert all(got[t][0] is None for t in bad), [t for t in bad if got[t][0] is not None]
    assert bytes(got["::ffff:1.2.3.4"][0]) == ipaddress.ip_address("::ffff:1.2.3.4").packed
