import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parent.parent), os.environ.get("PYTHONPATH", "")])
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {t.stem} as select * from '{t}{'/*.parquet' if t.is_dir() else ''}'")
    return con


def rows_of(frame):
    """Sorted rows by column name; floats rounded, whole floats as integers."""

    def value(v):
        if v is None or v != v:
            return "null"
        if isinstance(v, float) or type(v).__name__.startswith("float"):
            v = round(float(v), 6)
            return str(int(v)) if v == int(v) else str(v)
        return str(v)

    names = sorted(frame.columns)
    return names, sorted(tuple(map(value, r)) for r in frame[names].astype(object).where(frame[names].notna(), None).values.tolist())


@pytest.fixture(scope="session")
def same_rows(duck):
    def check(df, sql):
        a, b = rows_of(df.toPandas()), rows_of(duck.execute(sql).df())
        assert a[0] == b[0]
        assert len(a[1]) == len(b[1])
        assert a[1] == b[1]

    return check
