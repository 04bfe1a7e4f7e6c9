"""Plan lint: no cross products / nested-loop joins in the registered plans."""

import pytest

from conftest import SF001
from panelforge.plans import load_all

SKIP = {"train_shared", "train_per_segment", "train_two_stage", "feature_importance", "score_latest", "cv_mae",
        "param_search", "variant_sweep", "stored_model_eval", "pit_backfill_model", "stream_upsert", "stream_event_rollup"}
NAMES = [n for n in load_all() if n not in SKIP]


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_products(spark, name):
    df = load_all()[name].fn(spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
