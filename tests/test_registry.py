"""The registered queries: names, plans, and a sample of results."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry

# One or two queries of every family whose plan differs.
PLANS = re.compile(
    r"^(P0|F02|F13|F15_mat|F26|F28|E01|E08|A0[129]|A1|C02|C08|C1[0-4]|K0[24]|K1[1-5]|K26|R0[1258]|R25)"
)


def test_names_and_oracles():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    families = {n[0] for n in queries if n[0].isupper()}
    assert families == set("SPFEACKR")


def test_flagship(spark):
    rows = {r["tier"]: r for r in entry.entry(spark).collect()}
    assert list(rows) == ["Beginner", "Intermediate", "Advanced"]
    assert rows["Beginner"]["opening"] == pytest.approx(17.0225)


def test_no_query_plans_a_cross_join(spark, sf):
    for name, run in entry.queries().items():
        if not PLANS.match(name):
            continue
        plan = run(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan, name
        if name[0] in "SPFEAR":
            assert "InPandas" not in plan, name
