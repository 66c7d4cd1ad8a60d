"""Merged lists of an alert: no list goes through a shuffle, whatever the alerts ask for."""

import pytest
from pyspark.sql import functions as F

from raillark.operators import id_lists, joins


def given(spark):
    selectors = spark.range(3000).selectExpr("concat('al', id div 6) as alert_id", "element_at(array('route_short_name', 'stop_code', 'direction_id'), int(id % 3 + 1)) as selector_type", "string(id * 7 % 11) as selector_value")
    odd = "select 'odd' as alert_id, * from values ('route_short_name', string(null)), ('direction_id', null), (null, 'x'), ('other', 'y'), ('stop_code', 'none'), ('route_short_name', 'nulls'), ('route_short_name', '1'), ('route_short_name', '2') union all select null, 'stop_code', '1' union all select 'bare', 'direction_id', '1'"
    routes = spark.range(400).selectExpr("concat('r', id) as route_id", "if(id % 7 = 0, '', string(id % 9)) as short_name")
    # a route of two names, and a name whose only id is null
    routes = routes.union(spark.sql("select 'r10', '2' union all select 'r10', '1' union all select null, 'nulls' union all select 'ré', '2'"))
    stops = spark.range(60).selectExpr("concat('p', id) as stop_id", "string(id % 5) as stop_code")
    return selectors.union(spark.sql(odd)), routes, stops


def by_hand(selectors, routes, stops):
    asked = {}
    for r in selectors.collect():
        asked.setdefault(r.alert_id, set()).add((r.selector_type, r.selector_value))
    of = {"route_short_name": {}, "stop_code": {}}
    for r in routes.where("route_id is not null and short_name <> ''").collect():
        of["route_short_name"].setdefault(r.short_name, set()).add(r.route_id)
    for r in stops.collect():
        of["stop_code"].setdefault(r.stop_code, set()).add(r.stop_id)
    want = {}
    for alert, pairs in asked.items():
        ids = [sorted(set().union(*(of[k].get(v, ()) for t, v in pairs if t == k))) for k in of]
        way = sorted(v for t, v in pairs if t == "direction_id" and v is not None)
        lost = sorted({":".join(x for x in (t, v) if x is not None) for t, v in pairs if not of.get(t, {}).get(v) and not (t == "direction_id" and v is not None)})
        want[alert] = (*ids, way, lost)
    return want


@pytest.mark.parametrize("most", [1 << 26, 0])
def test_lists_equal_those_by_hand(spark, monkeypatch, most):
    """Also where the ids are too many to be sent and are joined as rows."""
    monkeypatch.setattr(joins, "LISTS_BYTES", most)
    monkeypatch.setattr(id_lists, "BATCH_IDS", 500)
    tables = given(spark)
    want = by_hand(*tables)
    assert {r[0]: tuple(r[1:]) for r in joins.alert_targets(*tables).collect()} == want
    text = {r[0]: tuple(r[1:]) for r in joins.alert_targets(*tables, text=True).collect()}
    assert text == {k: tuple(",".join(x) for x in v) for k, v in want.items()}


def test_no_list_is_shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.alert_targets(*given(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "collect_list" not in plan and "SortMergeJoin" not in plan and plan.count("Exchange") == 1
    empty = joins.alert_targets(given(spark)[0], *(df.limit(0) for df in given(spark)[1:]), text=True)
    assert empty.where("route_ids <> '' or stop_ids <> ''").isEmpty() and empty.count() == 503


def test_alerts_view_shuffles_no_list(spark):
    from raillark.plans import jobs

    tables = given(spark)
    view = jobs.alerts_view(*tables)
    assert "collect_list" not in view._jdf.queryExecution().executedPlan().toString()
    got = {r.alert_id: (r.route_ids, r.stop_ids, r.directions, r.unmapped) for r in view.collect()}
    assert got == {k: tuple(",".join(x) for x in v) for k, v in by_hand(*tables).items()}
