"""Plan properties that matter at scale."""

import re

from larkspur import catalog as C
from larkspur.operators import routing as RT
from larkspur.sources import records as R
from larkspur.sources.tables import table

SF = "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filter_reaches_scan(spark):
    p = _plan(C.src_from_timestamp(spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>", p)


def test_routing_config_is_broadcast(spark):
    p = _plan(C.route_latest(spark, SF))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "BroadcastHashJoin" in _plan(C.route_asof(spark, SF))


def test_sequence_windows_are_segmented(spark):
    for q in (C.bounce_all, C.login_fail_alert, C.unique_visit_exact, C.strict_runs):
        p = _plan(q(spark, SF))
        specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", p)
        assert specs, q.__name__
        for part, order in specs:
            # data windows run per (key, segment); the only key-wide windows
            # are over per-segment summaries, ordered by segment
            assert "_seg" in part or order.startswith("_seg"), (q.__name__, part, order)


def test_partial_aggregation_for_latest_per_key(spark):
    for q in (C.unique_visit, C.config_latest, C.window_tumbling_sum):
        p = _plan(q(spark, SF))
        assert "Window" not in p and ("partial_" in p), q.__name__


def test_create_dimension_tables(spark):
    latest = RT.latest_config(RT.config_versions(R.config_feed(table(spark, "/root/testdata/sf0.001", "orders"))))
    made = RT.create_dimension_tables(spark, latest, schema="dimtest")
    assert made == ["dimtest.dim_customer", "dimtest.dim_lineitem"]
    cols = [f.name for f in spark.table("dimtest.dim_lineitem").schema.fields]
    assert cols[0] == "l_orderkey" and len(cols) == 6
    assert [f.name for f in spark.table("dimtest.dim_customer").schema.fields][0] == "id"


def test_json_parsed_once_per_record(spark):
    # the dirty / start filters sit on parsed fields; the parse must not be
    # substituted into them (one parse per record in a single-branch query)
    for q in (C.json_extract_paths, C.displays_explode, C.cdc_normalize):
        p = _plan(q(spark, SF))
        assert p.count("parseJson") == 1, (q.__name__, p.count("parseJson"))
