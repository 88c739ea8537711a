import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wayloom.session import session

    conf = {
        "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    s = session("tests", **conf)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def rows(df, digits: int = 6):
    """Rows as a multiset, columns by name, numbers rounded."""
    from collections import Counter

    import pandas as pd

    def plain(v):
        if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
            return tuple(plain(x) for x in v)
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, bool) or type(v).__name__ in ("bool", "bool_"):
            return bool(v)
        return round(float(v), digits) + 0.0 if hasattr(v, "__float__") else v

    df = df[sorted(df.columns)]
    return Counter(tuple(plain(v) for v in r) for r in df.itertuples(index=False, name=None))
