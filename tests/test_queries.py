"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.queries.catalog import CATALOG
from tidemark.streaming.workspace import shared_root

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield connection
    connection.close()


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, v) for v in row))


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = CATALOG[name].run(spark, sf_dir)
    columns = sorted(got.columns)
    result = duck.execute(CATALOG[name].sql)
    want_columns = [column[0] for column in result.description]
    assert sorted(want_columns) == columns
    order = [want_columns.index(column) for column in columns]
    want = [tuple(row[i] for i in order) for row in result.fetchall()]
    assert want
    assert ordered(map(tuple, got.select(*columns).collect())) == ordered(want)


def test_contract(spark):
    assert contract.queries().keys() >= contract.oracle_sql().keys() >= CATALOG.keys()
    assert len(contract.entry(spark).columns) == 136


@pytest.mark.parametrize("name", ["raw_passthrough", "json_bad_field_null", "json_landing"])
def test_queries_read_whole_tables(duck, name):
    sql = CATALOG[name].sql.lower()
    assert " limit " not in sql and "sample" not in sql


def test_gen_landing_lands_compressed(spark, duck, sf_dir):
    root = Path(shared_root(spark))
    before = set(root.glob("gen_landing-*"))
    got = CATALOG["gen_landing"].run(spark, sf_dir)
    (folder,) = set(root.glob("gen_landing-*")) - before
    landed = list(folder.rglob("part-*"))
    assert landed
    assert all(path.name.endswith(".gz") for path in landed)
    want = duck.execute(CATALOG["gen_landing"].sql)
    assert got.count() == len(want.fetchall())
