import numbers

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr(tuple(None if x is None or x is pd.NA or x != x else round(float(x), 4) if isinstance(x, numbers.Number) and not isinstance(x, bool) else x for x in r)) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert rows(entry.queries()[name](spark, SF).toPandas()) == rows(con.execute(entry.oracle_sql()[name]).df())
