"""Known results of aggregation with time-outs; times are seconds after 2016-10-28 17:00."""

import pytest
from pyspark.sql import functions as F

from rillflow.operators import aggregate as ag
from rillflow.operators import segments
from rillflow.operators.aggregate import Agg

IN1 = [(1, 1, 7), (666, 3, 11)]
IN2 = [*IN1, (10, 13, 17), (17, 21, 23), (53, 26, 51)]


def records(spark, rows):
    stamp = lambda c: F.timestamp_seconds(F.lit(1477674000) + F.col(c)).cast("timestamp_ntz")
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, PACKETS long, a long, b long")
    return df.withColumn("TIME_FIRST", stamp("a")).withColumn("TIME_LAST", stamp("b")).drop("a", "b")


def groups(df, spec, aggs, keys=()):
    out = ag.aggregated(segments.segmented(df, list(keys), spec), [*keys, "segment"], aggs)
    base = 1477674000
    sec = lambda c: (F.unix_seconds(F.col(c).cast("timestamp")) - base).alias(c)
    return sorted(tuple(r) for r in out.select(sec("TIME_FIRST"), sec("TIME_LAST"), "COUNT", *[a.name for a in aggs]).collect())


@pytest.mark.parametrize(
    ("rows", "spec", "expected"),
    [
        (IN1, "E:40,20", [(1, 11, 2, 667)]),
        (IN1, "5r", [(1, 11, 2, 667)]),
        (IN1, "5a", [(1, 7, 1, 1), (3, 11, 1, 666)]),
        (IN2, "E:40,20", [(1, 23, 4, 694), (26, 51, 1, 53)]),
        (IN2, "5r", [(1, 11, 2, 667), (13, 17, 1, 10), (21, 23, 1, 17), (26, 51, 1, 53)]),
        (IN2, "5a", [(1, 7, 1, 1), (3, 11, 1, 666), (13, 17, 1, 10), (21, 23, 1, 17), (26, 51, 1, 53)]),
    ],
)
def test_known_results(spark, rows, spec, expected):
    assert groups(records(spark, rows), spec, [Agg("SUM", "PACKETS")]) == expected


def test_other_timeouts(spark):
    df = records(spark, IN2)
    assert groups(df, "A:15", [Agg("SUM", "PACKETS")]) == [(1, 17, 3, 677), (21, 51, 2, 70)]
    assert groups(df, "P:2", [Agg("SUM", "PACKETS")]) == [(1, 17, 3, 677), (21, 23, 1, 17), (26, 51, 1, 53)]
    assert groups(df, "G:10", [Agg("SUM", "PACKETS")]) == [(1, 7, 1, 1), (3, 17, 2, 676), (21, 23, 1, 17), (26, 51, 1, 53)]
    assert groups(df, "M:100,2", [Agg("SUM", "PACKETS")]) == groups(df, "P:2", [Agg("SUM", "PACKETS")])
    with pytest.raises(ValueError):
        segments.segmented(df, [], "X:1")


def test_all_functions(spark):
    one = (0, 1, 7, 333, 5, 5, "", "222", 16, 32, 7.0, "test1", 1, [3, 2, 1], [1, 2, 3])
    two = (1, 1, 11, 333, 1, 4, "test", "", 555, 33, 9.0, "test2", 3, [8, 7, 6], [6, 5, 4])
    schema = "seq long, a long, b long, S long, MI long, MA long, FNE string, LNE string, FI long, LA long, AV double, AP string, BO long, K array<long>, V array<long>"
    df = spark.createDataFrame([one, two], schema)
    stamp = lambda c: F.timestamp_seconds(F.lit(1477674000) + F.col(c)).cast("timestamp_ntz")
    df = df.withColumn("TIME_FIRST", stamp("a")).withColumn("TIME_LAST", stamp("b"))
    aggs = [Agg("SUM", "S"), Agg("MIN", "MI"), Agg("MAX", "MA"), Agg("FIRST_NON_EMPTY", "FNE"), Agg("LAST_NON_EMPTY", "LNE"), Agg("FIRST", "FI"), Agg("LAST", "LA"), Agg("AVG", "AV"), Agg("APPEND", "AP", delimiter=":", size=10), Agg("BITOR", "BO"), Agg("SORTED_MERGE", "V", key="K", size=10)]
    assert groups(df, "E:40,20", aggs) == [(1, 11, 2, 666, 1, 5, "test", "222", 16, 33, 8.0, "test1:", 3, [3, 2, 1, 4, 5, 6])]
    assert [r[6] for r in groups(df.where("seq = 0"), "5a", aggs)] == [""]


def test_distinct_counts(spark):
    times = [(0, 1, 7), (0, 3, 11), (0, 13, 17), (0, 14, 17)]
    df = records(spark, times)
    ints = df.withColumn("T", F.element_at(F.array(*map(F.lit, (7, 666, 666, 6))), (F.col("seq") + 1).cast("int")))
    assert groups(ints, "E:40,20", [Agg("UNIQUE_COUNT", "T")])[0][3] == 3
    texts = df.withColumn("T", F.element_at(F.array(*map(F.lit, ("x", "", "y", "y"))), (F.col("seq") + 1).cast("int")))
    assert groups(texts, "E:40,20", [Agg("UNIQUE_COUNT", "T")])[0][3] == 2
    assert [g[3] for g in groups(texts, "5a", [Agg("UNIQUE_COUNT", "T")])] == [1, 0, 1]


def test_specifications():
    keys, aggs, timeout = ag.parsed_options("-k SRC_IP -s BYTES -F PORT -t M:10,5")
    assert keys == ["SRC_IP"] and timeout == "M:10,5" and [a.function for a in aggs] == ["SUM", "FIRST_NON_EMPTY"]
    xml = '<a><id name="s"><field><name>K</name><type>KEY</type></field><field><name>V</name><type>SORTED_MERGE</type><sort_key>T</sort_key><sort_type>DESC</sort_type><size>4</size></field></id></a>'
    keys, aggs = ag.parsed_xml(xml, "s")
    assert keys == ["K"] and aggs == [Agg("SORTED_MERGE", "V", key="T", descending=True, size=4)]
    with pytest.raises(ValueError):
        ag.parsed_xml(xml, "t")
