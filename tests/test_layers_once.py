from __future__ import annotations


def test_failing_gold_checks_make_each_layer_once(spark):
    """The checks read layers that were written; none is made again from the source for another check."""
    from tidemark.plans import registry

    df = registry.QUERIES["gold_checks_failing"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_orderkey" not in plan
    assert df.count() == 9
