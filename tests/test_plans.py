"""Plan assertions: the physical plans we want at scale."""

from dayflow.plans.all import QUERIES

from conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_month_filter_pushed_to_scan(spark):
    p = _plan(QUERIES["month_filter"](spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "LessThan(o_orderdate" in p


def test_scan_is_column_pruned(spark):
    p = _plan(QUERIES["daily_flow"](spark, SF001))
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderdate:" in p
    assert "o_orderpriority" not in p


def test_topk_uses_window_group_limit(spark):
    # a partial limit below the group shuffle: a hot city ships k rows per map task
    lines = _plan(QUERIES["topk_per_group"](spark, SF001)).splitlines()
    ex = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(city_id" in line)
    final = [i for i, line in enumerate(lines)
             if "WindowGroupLimit" in line and line.rstrip().endswith("Final")]
    partial = [i for i, line in enumerate(lines)
               if "WindowGroupLimit" in line and line.rstrip().endswith("Partial")]
    assert final and partial and final[0] < ex < partial[0]


def test_lag_features_is_one_window_no_join(spark):
    df = QUERIES["lag_features"](spark, SF001)
    opt = _optimized(df)
    assert "Join" not in opt
    assert opt.count("Window [") == 1


def test_keyed_windows_never_single_partition(spark):
    # the only single-partition exchanges allowed feed the final step of a
    # global (keyless) aggregate such as the scalar min/max day subqueries
    for name in ("forward_fill", "exog_join_ffill", "lag_features", "rollout_var"):
        lines = _plan(QUERIES[name](spark, SF001)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "HashAggregate(keys=[]" in lines[i + 1], (name, line)


def test_exogenous_series_are_broadcast(spark):
    p = _plan(QUERIES["exog_join_ffill"](spark, SF001))
    assert p.count("BroadcastExchange") >= 2


def test_user_flow_aggregates_before_join(spark):
    opt = _optimized(QUERIES["user_month_flow"](spark, SF001))
    # the aggregate over orders sits below the join with customer
    assert opt.index("Join") < opt.rindex("Aggregate")


def test_rollouts_have_no_python(spark):
    p = _plan(QUERIES["rollout_ar"](spark, SF001))
    assert "ArrowEvalPython" not in p and "FlatMapGroupsInPandas" not in p
    assert "Generate posexplode" in p
    # 4 targets x 61 features: the automatic engine choice is the SQL one
    p = _plan(QUERIES["rollout_var"](spark, SF001))
    assert "FlatMapGroupsInPandas" not in p and "ArrowEvalPython" not in p


def _exchange_inputs(plan: str):
    """(exchange line, first operator line below it) pairs of a plan string."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and i + 1 < len(lines):
            yield line, lines[i + 1]


def test_aggregates_are_partial_before_their_shuffle(spark):
    # a key holding a third of all rows leaves each map task as one partial row:
    # the exchange of each grouping is fed by a partial aggregate.  Where the
    # grouping key is the join key, facts are aggregated before the join and the
    # join reuses that partitioning; otherwise the join comes first (one fact
    # shuffle) and the aggregate after it is partial.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name, key in (("user_month_flow", "user_id"), ("segment_counts", "report_date"),
                          ("avg_balance_by_city", "o_custkey"),
                          ("exog_join_ffill", "c_nationkey")):
            plan = _plan(QUERIES[name](spark, SF001))
            fed = [below for ex, below in _exchange_inputs(plan)
                   if f"hashpartitioning({key}#" in ex and "partial_" in below]
            assert fed, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_sql_text_parameters_reach_the_scan(spark):
    p = _plan(QUERIES["sql_topk_per_group"](spark, SF001))
    assert "GreaterThanOrEqual(o_orderdate,2000-08-01" in p and "WindowGroupLimit" in p


def test_facts_are_scanned_once(spark):
    # the (user, day) aggregate is written once; the panels never scan events again
    for name in ("fillna_measures", "forward_fill", "horizon_union", "panel_spine", "date_spine"):
        assert "props" not in _optimized(QUERIES[name](spark, SF001))
        files = _plan(QUERIES[name](spark, SF001))
        assert "events.parquet" not in files, name


def test_feature_frame_is_scanned_once_per_model_set(spark):
    from dayflow.operators import moments
    from dayflow.plans import model_queries as q
    for spec, data in ((q.SPEC, q.assembled_features(spark, SF001)),
                       (q.WIDE_SPEC, q.wide_features(spark, SF001))):
        n = len(spec.feature_names())
        states = moments.state_rows(data, "features", n, spec.targets, "split")
        assert _optimized(states).count("Relation [") == 1
