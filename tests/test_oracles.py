"""Every registered query runs, matches its SQL twin row for row, and keeps a scalable plan."""

import os
import re

import pytest

from compare import connect, difference
from hailgrid.catalog import ORACLES, QUERIES
from hailgrid.sources.tables import ResultStore

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FITTED = {"rf_slot_forecast", "gbt_forecast", "test_preds", "model_metrics", "pred_grid"}


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_only_fitted_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == FITTED


@pytest.fixture
def written(monkeypatch):
    """Plans of the tables a query writes before it returns."""
    plans, write = [], ResultStore.write

    def noted(self, df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, *args, **kwargs)

    monkeypatch.setattr(ResultStore, "write", noted)
    return plans


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, written, name):
    result = QUERIES[name](spark, SF_DIR)
    for plan in [*written, result._jdf.queryExecution().executedPlan().toString()]:
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan
        # a window without partition keys would gather all rows in one task
        assert not re.search(r"windowspecdefinition\((specifiedwindowframe|\w+#\d+L? (ASC|DESC))", plan)
    got = result.toPandas()
    if name in ORACLES:
        assert difference(got, database.execute(ORACLES[name]).fetch_df()) is None
    else:
        assert len(got) > 0
        assert got.notna().all().all()
