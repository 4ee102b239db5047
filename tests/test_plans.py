"""Plan lint over every registered query: no cross products and no
row-at-a-time Python UDFs (Python runs only as Arrow-batched map stages)."""

import pytest

from __spark_entry__ import queries
from tessera.plans.queries import QUERIES
from compare import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
NAMES = sorted(n for n in QUERIES if not n.startswith("fit"))


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_cross_product_or_row_udf(spark, name):
    plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan], plan
