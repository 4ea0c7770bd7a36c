import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tickloom.sources.session import local

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    session = local(int(os.environ.get("TEST_CPUS", "4")), **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def same(df, con, sql: str) -> None:
    """Spark's rows are the SQL's rows, by column name, in any order."""
    columns = sorted(df.columns)
    theirs = con.sql(sql)
    assert sorted(theirs.columns) == columns
    text = lambda rows: sorted(tuple(str(x) for x in r) for r in rows)
    ours, want = text(df.select(*columns).collect()), text(theirs.project(",".join(f'"{c}"' for c in columns)).fetchall())
    assert len(ours) == len(want)
    assert ours == want
