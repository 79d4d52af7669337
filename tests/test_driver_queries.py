"""Every query of the relational primitives against its SQL oracle, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from loomline.plans import driver_queries, game_queries

QUERIES, ORACLES = driver_queries.QUERIES | game_queries.QUERIES, driver_queries.ORACLES | game_queries.ORACLES
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    clean = lambda v: None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else v
    cols = sorted(df.columns)
    return sorted([tuple(str(clean(v)) for v in r) for r in df[cols].astype(object).itertuples(index=False)])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLES[name]).to_arrow_table()
    assert sorted(got.columns) == sorted(want.column_names)
    assert rows(pd.DataFrame(map(tuple, got.collect()), columns=got.columns, dtype=object)) == rows(pd.DataFrame(want.to_pylist(), columns=want.column_names, dtype=object))
