"""Every query against its oracle on the smallest tables; and plain rows for the others."""

import duckdb
import pandas as pd
import pytest

from concordat.queries import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def canon(df: pd.DataFrame) -> list[str]:
    def plain(x):
        if x is None or x is pd.NA or (isinstance(x, float) and x != x):
            return "null"
        return str(int(x)) if isinstance(x, float) and x == int(x) else str(x)

    cols = sorted(df.columns)
    return sorted("|".join(plain(x) for x in r) for r in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    if name not in catalogue.ORACLE_SQL:
        assert len(got)
        return
    want = db.execute(catalogue.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)
