import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", f"file://{folder}/shared")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def plain(v):
    """A value as both engines give it."""
    if v is None or isinstance(v, (str, bool)):
        return v
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        v = float(v)
        return None if v != v else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(plain(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def duck(small):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(small):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{small}/{f}'")
    return con
