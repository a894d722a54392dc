import __spark_entry__ as e


def test_each_oracle_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 80


def test_entry(spark):
    assert e.entry(spark).count() > 0


def test_pushdown(spark):
    """Filters and column choice reach the scan."""
    plan = e.queries()["f5_year_range"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "l_comment" not in plan and "l_tax" not in plan
