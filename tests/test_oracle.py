"""Every registered query against its DuckDB oracle on the smallest tables
(the driver's gate runs the same comparison at sf0.01)."""

import re

import duckdb
import pytest

from scripts.check_oracle import TABLES, digest
from tests.conftest import SF001

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def own(keys):
    """Keys of the library's own queries (the training-data ones have tests of their own)."""
    return sorted(k for k in keys if not re.match(r"op\d+_|pipeline$", k))


def test_every_query_has_oracle():
    assert own(entry.queries()) == own(entry.oracle_sql())


@pytest.mark.parametrize("key", own(entry.queries()))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["doc_id", "body", "lang", "source", "text_length", "word_count"]
