"""Every registered query against its reference SQL on the smallest tables."""

import math
import os

import pytest

from __spark_entry__ import entry
from waterline.registry import oracle
from waterline.registry.queries import REGISTRY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
ORACLE = oracle.build()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def comparable(rows, columns, names):
    at = [names.index(c) for c in columns]
    cell = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(cell(r[i]) for i in at) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_registry_is_complete():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    found = REGISTRY[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    columns = sorted(names)
    assert sorted(found.columns) == columns
    got = comparable(found.collect(), columns, found.columns)
    assert got == comparable(cursor.fetchall(), columns, names)
    assert got


def test_the_week_grid_reads_the_facts_once(spark, monkeypatch):
    from waterline.operators import season
    from waterline.plans import history
    from waterline.registry import queries

    stored, real = [], queries.materialise
    for module in (season, history, queries):
        monkeypatch.setattr(module, "materialise", lambda df: stored.append(df) or real(df))
    found = REGISTRY["entity_week_grid"](spark, SF)
    scans = [df._jdf.queryExecution().executedPlan().toString().count("/lineitem.parquet") for df in (*stored, found)]
    assert sum(scans) == 1 and scans[0] == 1


def test_entry(spark):
    assert entry(spark).count() > 0
