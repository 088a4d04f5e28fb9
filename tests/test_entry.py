import duckdb
import pytest

import __spark_entry__ as E
from plumage.plans.oracle import ORACLE
from plumage.plans.registry import QUERIES
from plumage.sources.tables import TABLES

from conftest import SF001

NO_ORACLE = {"decision_tree", "random_forest", "train_evaluate",
             "compare_models", "sweep_decision_tree", "sweep_random_forest"}


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(q) and set(QUERIES) - set(o) == NO_ORACLE


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["model", "split", "gender", "predicted_gender", "n"]
    assert len(rows) > 0


def _norm(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    s = E.queries()[key](spark, SF001).toPandas()
    o = duck.execute(E.oracle_sql()[key]).df()
    assert sorted(s.columns) == sorted(o.columns)
    cols = sorted(s.columns)
    rs = sorted((tuple(_norm(r[c]) for c in cols) for r in s.to_dict("records")), key=repr)
    ro = sorted((tuple(_norm(r[c]) for c in cols) for r in o.to_dict("records")), key=repr)
    assert rs == ro
