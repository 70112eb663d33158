"""What a task holds: window features sort short rows."""

from checks import cases_q as Q


def test_laid_out_days_are_not_sorted(spark, data):
    df = Q._features(spark, data, ["CGMInfoBf24h"])
    plan = df._jdf.queryExecution().executedPlan()

    def sorts(node, found):
        if node.nodeName() == "Sort":
            found.append([str(node.output().apply(i).name()) for i in range(node.output().size())])
        for i in range(node.children().size()):
            sorts(node.children().apply(i), found)
        return found

    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    columns = [c for s in sorts(plan, []) for c in s]
    assert "_p_CGM5Min" in columns
    assert not [c for c in columns if c.startswith(("_value_", "_whole_", "_t_", "_h_"))]
