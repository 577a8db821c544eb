import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from paths import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from sentimart.session import build_session, shared_dir
    s = build_session(master="local[4]", shuffle_partitions=8, driver_memory="4g")
    shared_dir(s)  # registers a private checkpoint folder (tests only)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split():
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con
