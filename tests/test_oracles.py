"""Every registered query equals its DuckDB twin at sf0.01 (rows, names, values)."""

import pytest

import __spark_entry__ as E
from lumen.plans.oracles import ORACLES
from lumen.plans.queries import QUERIES
from tests.conftest import SF01
from tests.helpers import canon

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF01)
    cols = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())
    rel = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert cols == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    want = sorted(tuple(canon(r[i]) for i in idx) for r in rel.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "n_journeys", "avg_weight", "max_depth"]
    assert df.count() > 0


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, duck, name):
    spark_types = dict(E.queries()[name](spark, SF01).dtypes)
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE ({E.oracle_sql()[name]})").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in spark_types.items()} == duck_types
