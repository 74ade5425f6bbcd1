"""Every query of the catalogue against its SQL in DuckDB, on the small tables."""

import duckdb
import pandas as pd
import pytest

import marlspark.plans.dataset_queries  # noqa: F401  registers its queries
from marlspark.functions.seeds import stable_seed
from marlspark.plans.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = [tuple(None if pd.isna(x) else (round(x, 5) if isinstance(x, float) else x) for x in r) for r in df.astype(object).itertuples(index=False)]
    return sorted(rows, key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert len(got) or name == "contract_diff"
    if name in SQL:
        con = duckdb.connect()
        for table in TABLES:
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
        assert plain(got) == plain(con.execute(SQL[name]).df())


def test_seed_golden_values():
    assert stable_seed(20260723, "CT", "extract") == 3552487064082204320
    assert stable_seed(20260723, "QF17_CT_00000001") == 4979538402835193101
