"""Corpus queries against their DuckDB SQL on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from alpina.llm.queries import ORACLE
from conftest import SF_SMALL

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels"]


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(columns, res.fetchall())
