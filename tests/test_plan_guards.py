"""Every registered query: no cartesian or nested-loop join, no Python UDF node."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_has_no_forbidden_operator(spark, name):
    df = E.queries()[name](spark, SF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    plan = buf.getvalue()
    # Spark ML's recommendForAllUsers pairs blocks of factors, not rows.
    allowed = ("CartesianProduct", "BroadcastNestedLoopJoin") if name.startswith("als_") else ()
    bad = [op for op in FORBIDDEN if op in plan and op not in allowed]
    assert not bad, f"{name}: {bad}"
