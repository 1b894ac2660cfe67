"""Every registered query against its SQL, on the whole smoke tables."""

import datetime as dt
import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from marlstone.registry import catalog  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES
# a file manifest reads bytes and times of files, which SQL over the tables cannot see
WITHOUT_SQL = {"s17_file_manifest"}
INVENTORY = (
    [f"s{i}" for i in range(1, 20)] + [f"p{i}" for i in range(1, 23)] + [f"j{i}" for i in range(1, 6)]
    + [f"a{i}" for i in range(1, 19)] + [f"t{i}" for i in range(1, 10)] + [f"d{i}" for i in range(1, 6)]
    + [f"q{i}" for i in range(1, 16)] + ["l1", "l2", "l3"])


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def comparable(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_inventory_line_has_a_query():
    prefixes = {name.split("_")[0] for name in QUERIES}
    assert [i for i in INVENTORY if i not in prefixes] == []
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, db, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    expected = db.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    places = [expected.columns.index(c) for c in columns]
    wanted = [[row[i] for i in places] for row in expected.fetchall()]
    assert comparable(df.select(*columns).collect()) == comparable(wanted)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert "total_delay_minutes" in df.columns and not df.isEmpty()


def test_manifest_query(spark, sf_dir):
    rows = {r["logical_name"]: r["status"] for r in QUERIES["s17_file_manifest"](spark, sf_dir).collect()}
    assert rows == {"events": "unchanged_skipped", "orders": "unchanged_skipped", "lineitem": "downloaded"}
