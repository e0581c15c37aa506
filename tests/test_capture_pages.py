from postings import queries


def test_pages_are_grouped_before_their_entries_are_built(spark):
    orders = spark.range(10).selectExpr("id AS o_orderkey", "'1-URGENT' || id AS o_orderpriority", "'O' || id AS o_orderstatus")
    plan = queries._pages(orders, "source_a")._jdf.queryExecution().optimizedPlan().toString()
    gathered = plan.split("collect_list(")[1].split(", 0, 0")[0]
    assert "slug" in plan and "k, " in gathered and "slug" not in gathered
