import os

import duckdb
import pandas as pd
import pytest

from tagloom.plans.run_queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def tidy(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: f"{v:.6g}" if isinstance(v, float) else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "part", "customer"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    pd.testing.assert_frame_equal(tidy(QUERIES[name](spark, SF).toPandas()), tidy(con.sql(ORACLES[name]).df()))
