"""Every registered query against its DuckDB oracle (sf0.001), the driver's
correctness gate in miniature."""

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.sources.tables import TABLES
from tools.oracle_check import rows

from .conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


# Keys that no SQL over the given tables can state, and what holds them instead.
DOCUMENTED = {"layout_report": "bytes and files of what the query itself writes: tests/test_layout.py, against the files' metadata"}


def test_every_query_has_oracle_or_is_documented():
    rows_only = {k for k in set(QUERIES) - set(ORACLE) if not k.startswith("op") and k != "pipeline"}
    assert rows_only == set(DOCUMENTED), rows_only


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k in ORACLE and not k.startswith("op") and k != "pipeline"))
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    got = sdf.toPandas()
    exp = con.sql(ORACLE[key]).df()
    c1, r1 = rows(got)
    c2, r2 = rows(exp)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["player_name", "scoring_class", "start_date", "end_date"]
