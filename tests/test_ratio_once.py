"""Words of a block are split once for its ratio, its prose test and the filter on both."""

from pagewright.plans.driver_queries import QUERIES


def test_words_are_split_once(spark):
    plan = QUERIES["math_token_ratio"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?U)\\s+, -1)") == 1
