import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from barloom.session import get_session
    s = get_session("local[4]", app_name="barloom-tests", shuffle_partitions=8,
                    driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for file in sorted(os.listdir(SF0001)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{SF0001}/{file}')")
    return con
