"""What the plans of some queries must show; test_answers.py looks at what no plan may hold."""

from logtide import plans


def test_work_before_the_last_read_is_seen(spark, data, executed_plans):
    ran = executed_plans(lambda: plans.queries()["score_query"](spark, data).collect())
    assert len(ran) >= 4 and any("Generate" in plan for plan in ran)


def test_plans_are_found_after_more_executions_than_are_kept(spark, executed_plans):
    for _ in range(1050):  # Spark keeps 1,000
        spark.range(1).write.format("noop").mode("overwrite").save()
    for _ in range(3):
        assert len(executed_plans(lambda: [spark.range(5).write.format("noop").mode("overwrite").save() for _ in range(8)])) == 8


def test_flagship_sums_before_it_joins(spark, data, plan_of):
    plan = plan_of(plans.queries()["media_traffic_minute"](spark, data))
    assert "BroadcastHashJoin" in plan and plan.index("BroadcastHashJoin") < plan.index("HashAggregate")
    assert plan.count("partial_sum") >= 1
    # Only the columns that the lines are made of are read.
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan
