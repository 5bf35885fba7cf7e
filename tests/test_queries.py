"""Every registered query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from tidemark.plans import registry

DATA = Path("/root/testdata/sf0.001")


def text(v):
    return ("nan" if math.isnan(v) else f"{v:.9g}") if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def tables():
    c = duckdb.connect()
    for f in DATA.iterdir():
        c.execute(f"create view {f.stem} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, tables, name):
    df = registry.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(tuple(text(v) for v in row) for row in df.select(*columns).collect())
    assert name in registry.ORACLES
    found = tables.execute(registry.ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(text(row[names.index(c)]) for c in columns) for row in found.fetchall())


def test_flagship_runs(spark):
    import __spark_entry__

    assert registry.FLAGSHIP in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_whole_table_queries_reach_every_entity(spark, tables):
    roots = {r.entity_key for r in registry.QUERIES["lineage_nodes_all"](spark, str(DATA)).where("node_type = 'ENTITY'").collect()}
    assert {k % 10 for k in roots} == set(range(10))
    asked = registry.QUERIES["related_records_all"](spark, str(DATA)).where("kind = 'user'").select("key").distinct().count()
    assert asked == tables.execute("select count(distinct user_id) from events").fetchone()[0]
