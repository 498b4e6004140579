"""Plan invariants of every registered query (see PLANS.md)."""

import pytest

from scripts.plan_audit import audit
from wrenchcast.plans.registry import QUERIES

from .conftest import SF_SMALL


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan_stays_in_the_jvm_without_pair_joins(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    a = audit(plan)
    assert a["python"] == "no"
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
