"""Order keys for which the order of arrival passes 64 bits, against the SQL with wider integers."""

import shutil
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.plans import catalog, flows

from .conftest import rows_of

#: Queries of the findings on larger tables, and further ones that store, read or return the order of arrival.
FOUND = ("a13_append", "a17_biflow", "a26_top_flows", "a8_a16_nonempty_unique", "f11_host", "f13_in", "f15_protocol_name", "f2_not_binds_next", "f5_signed_compare", "f8_datetime", "j2_prefix_tag_both", "j4_domain_suffix", "j7_one_way", "k5_json_mappings", "p5_byte_swap", "r10_passed", "s2_flow_dump", "s7_k3_recorded_stream", "u2_u3_mux_demux", "x2_mask", "x5_minutes", "a14_sorted_merge", "a1_a10_keyed", "a26_top_flows_by_interval")
FURTHER = ("a15_sorted_merge_dir", "a31_reply_features", "j1_nat_pairs", "k11_text_report", "p3_record_cap", "r5_volume_attack", "s1_k1_csv", "s3_k4_k5_json", "s4_w12_live_interface", "u1_merge", "u1_record_script")


@pytest.fixture(scope="module")
def wide_dir(tmp_path_factory, sf_dir):
    """The tables with every third order key beyond 922 336, so seq has numbers on both sides of 2^63."""
    import duckdb

    out = tmp_path_factory.mktemp("wide")
    for t in Path(sf_dir).glob("*.parquet"):
        if t.stem != "lineitem":
            (shutil.copytree if t.is_dir() else shutil.copy)(t, out / t.name)
    source = Path(sf_dir) / "lineitem.parquet"
    duckdb.sql(f"copy (select * replace (l_orderkey + case when l_orderkey % 3 = 0 then 6000000 else 0 end as l_orderkey) from '{source}{'/*.parquet' if source.is_dir() else ''}') to '{out / 'lineitem.parquet'}' (format parquet)")
    return str(out)


@pytest.fixture(scope="module")
def wide_duck(wide_dir):
    import duckdb

    con = duckdb.connect()
    for t in sorted(Path(wide_dir).glob("*.parquet")):
        con.execute(f"create view {t.stem} as select * from '{t}{'/*.parquet' if t.is_dir() else ''}'")
    return con


def widened(sql):
    """The same SQL with seq in 128 bits; as it stands it fails by an overflow."""
    out = sql.replace("((((l_orderkey * 10", "((((l_orderkey::hugeint * 10").replace("::bigint as seq", " as seq")
    assert out.count("hugeint") == 1
    return out


@pytest.mark.parametrize("name", FOUND + FURTHER)
def test_same_as_sql_beyond_64_bits(spark, wide_dir, wide_duck, name):
    df = catalog.QUERIES[name](spark, wide_dir)
    df = df.select(*[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema.fields])
    rows = wide_duck.sql(widened(catalog.ORACLES[name]))
    texts = ", ".join(f'"{c}"::varchar as "{c}"' if str(t) == "HUGEINT" else f'"{c}"' for c, t in zip(rows.columns, rows.types, strict=True))
    a, b = rows_of(df.toPandas()), rows_of(wide_duck.sql(f"select {texts} from rows").df())
    assert a[0] == b[0]
    assert len(a[1]) > 0
    assert a[1] == b[1]


def test_order_is_exact_and_long_where_it_can_be(spark, sf_dir, wide_dir):
    assert flows.flows(spark, sf_dir).schema["seq"].dataType == T.LongType()
    wide = flows.flows(spark, wide_dir)
    assert wide.schema["seq"].dataType == T.DecimalType(38, 0)
    top = wide.agg(F.max("seq")).first()[0]
    assert top > Decimal(2**63)
    assert wide.select("seq").distinct().count() == wide.count()


#: Queries of the findings, on keys that don't even leave the two halves of seq in 64 bits.
FAR = ("a17_biflow", "a26_top_flows", "a8_a16_nonempty_unique", "f11_host", "f13_in", "f15_protocol_name", "f2_not_binds_next", "f5_signed_compare", "f8_datetime", "j2_prefix_tag_both", "j4_domain_suffix", "j7_one_way", "p5_byte_swap", "r10_passed", "s2_flow_dump", "s7_k3_recorded_stream", "u2_u3_mux_demux", "x2_mask", "x5_minutes", "a14_sorted_merge", "a1_a10_keyed")


def keys_moved(sf_dir, out, moved):
    """The tables with other line items: ``moved`` replaces columns."""
    import duckdb

    for t in Path(sf_dir).glob("*.parquet"):
        if t.stem != "lineitem":
            (shutil.copytree if t.is_dir() else shutil.copy)(t, out / t.name)
    source = Path(sf_dir) / "lineitem.parquet"
    duckdb.sql(f"copy (select * replace ({moved}) from '{source}{'/*.parquet' if source.is_dir() else ''}') to '{out / 'lineitem.parquet'}' (format parquet)")
    return str(out)


@pytest.fixture(scope="module")
def far_dir(tmp_path_factory, sf_dir):
    step = "case when l_orderkey % 3 = 0 then 59000000000000 else 0 end"
    return keys_moved(sf_dir, tmp_path_factory.mktemp("far"), ", ".join(f"{k} + {step} as {k}" for k in ("l_orderkey", "l_partkey", "l_suppkey")))


@pytest.fixture(scope="module")
def far_duck(far_dir):
    import duckdb

    con = duckdb.connect()
    for t in sorted(Path(far_dir).glob("*.parquet")):
        con.execute(f"create view {t.stem} as select * from '{t}{'/*.parquet' if t.is_dir() else ''}'")
    return con


@pytest.mark.parametrize("name", FAR)
def test_same_as_sql_with_far_keys(spark, far_dir, far_duck, name):
    test_same_as_sql_beyond_64_bits(spark, far_dir, far_duck, name)


def test_order_of_any_keys_and_of_none(spark, sf_dir, tmp_path):
    """The largest keys give exact numbers; a key that is null gives null, whatever the others are."""
    top = 2**63 - 1
    out = keys_moved(sf_dir, tmp_path, f"case when l_orderkey % 2 = 0 then {top} else -{top} end as l_orderkey, case when l_linenumber = 1 then null else {top} end as l_partkey, {top} as l_suppkey")
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1990-01-01").cast("date"))
    rows = spark.read.parquet(f"{out}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", days.alias("days")).collect()
    told = [None if p is None else (((o * 10 + n) * 100000 + p) * 1000 + s) * 10000 + d for o, n, p, s, d in rows]
    found = [None if r[0] is None else int(r[0]) for r in flows.flows(spark, out).select("seq").collect()]
    by = lambda v: (v is None, v or 0)
    assert None in told
    assert sorted(found, key=by) == sorted(told, key=by)
