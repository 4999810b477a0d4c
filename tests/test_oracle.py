"""Every query against its SQL on the same parquet tables: values, columns and types."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import TESTDATA

QUERIES = {k: v for k, v in contract.queries().items() if k not in contract.CORPUS_QUERIES}
ORACLES = {k: v for k, v in contract.oracle_sql().items() if k not in contract.CORPUS_QUERIES}


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{TESTDATA}/sf0.01/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _kind(value):
    if isinstance(value, decimal.Decimal):
        return "decimal", -value.as_tuple().exponent
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return "date"
    return type(value).__name__


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        tuple((str(row[i]), _kind(row[i])) for i in order) for row in rows
    ), [columns[i] for i in order]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, duck, sf_dir, key):
    frame = QUERIES[key](spark, sf_dir)
    mine, my_columns = _canonical(frame.columns, [tuple(row) for row in frame.collect()])
    result = duck.execute(ORACLES[key])
    columns = [c[0] for c in result.description]
    duck_types = dict(zip(columns, (str(c[1]) for c in result.description)))
    theirs, their_columns = _canonical(columns, result.fetchall())
    assert my_columns == their_columns
    assert len(mine) == len(theirs) > 0
    assert mine == theirs
    spark_types = {
        name: kind.upper().replace("TIMESTAMP_NTZ", "TIMESTAMP").replace("INT", "INTEGER")
        .replace("BIGINTEGER", "BIGINT").replace("STRING", "VARCHAR")
        for name, kind in frame.dtypes
    }
    assert spark_types == duck_types
