"""Scale smoke on plan shape: no cartesian products or nested-loop joins, no
Python evaluation, for a representative set of registered queries."""

import re

import pytest

import __spark_entry__ as E

from .conftest import SF001

KEYS = ["s01_a01_opening_dashboard", "a02_relative_dashboard", "p22_skew_transforms", "a12_audit_by_band",
        "w01_theory_exit_tolerant", "w04_w05_post_theory_acl", "t26_j08_opening_resource_bridge",
        "r01_j07_resource_search", "m11_w10_opening_levels", "a09_similarity_profiles", "j10_band_aggregate",
        "t01_t02_t03_t04_retier_catalog"]


@pytest.mark.parametrize("key", KEYS)
def test_plan_shape(spark, key):
    plan = E.queries()[key](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"(Batch|Arrow)EvalPython", plan)
