"""Every registered query against its SQL check on the smallest tables."""

import pytest

from featloom.queries import REGISTRY
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_equals_sql(spark, con, name):
    fitted = name.startswith(("train_", "score_", "prepare_"))  # what scores rows runs a fitted model on them
    assert compare(spark, con, REGISTRY[name], SF, plan=not fitted) is None


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if not q.sql])
def test_runs(spark, name):
    df = REGISTRY[name].run(spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    out = e.entry(spark)
    assert "label" in out.columns and out.count() == 200
