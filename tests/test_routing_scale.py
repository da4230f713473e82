"""What each change event costs on its way through normalising and routing, read off the plans."""

import json

import pytest
from pyspark.sql import functions as F

from larkspur import catalog as C
from larkspur.functions import json as J
from larkspur.operators import cdc as CDC

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def large(spark):
    """As with tables whose estimates are too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_op_is_read_once(spark):
    assert _plan(C.cdc_normalize(spark, SF)).count("$.op,") == 1


def test_data_json_has_no_detour(spark):
    """The map is written as it is, keys in order, and reads as the text of the variant object."""
    assert "to_variant_object" not in _plan(C.cdc_normalize(spark, SF))
    after = {"z": 1.5, "a": None, "é": "x\t\"\\ ü ", "": [1, {"k": None}], "A": True, "n": "1", "\U0001f600": 2}
    rec = json.dumps({"before": None, "after": after, "op": "C", "source": {"db": "d", "table": "t"}})
    n = CDC.normalize_change_events(spark.createDataFrame([("a.d.t", rec)], "topic string, value string"))
    r = n.select("operation", F.to_json(F.to_variant_object("data")).alias("was"), C._data_json().alias("now")).first()
    assert r.operation == "create" and r.now == r.was and json.loads(r.now) == after


def test_unknown_and_missing_ops_stay_null(spark):
    rows = [(f'{{"op":{op}}}',) for op in ('"t"', "null", '"D"', '"r"', "5")] + [("{}",), ("{bad",)]
    n = CDC.normalize_change_events(spark.createDataFrame(rows, "value string"), topic=None)
    assert [r.operation for r in n.select("operation").collect()] == [None, None, "delete", "read", None, None, None]


def test_latest_config_is_broadcast_whatever_the_estimate(spark, large):
    p = _plan(C.route_latest(spark, SF))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_column_list_is_split_once_a_record(spark):
    assert "array_contains(split(" not in _plan(C.map_prune_columns(spark, SF))
    m = F.expr("map('a', 1, 'b', 2, '', 3, 'a,b', 4)")
    lists = spark.createDataFrame([("a,b",), ("a, b",), ("",), ("b,",), ("a|b",), (None,)], "l string")
    got = [r[0] for r in lists.select(F.map_keys(J.prune_columns(m, "l"))).collect()]
    assert got == [["a", "b"], ["a"], [""], ["b", ""], [], []]


def test_dimension_rows_are_sorted_by_their_own_key_first(spark):
    p = _plan(C.dim_upsert_latest(spark, SF))
    assert "SortAggregate(key=[pk#" in p and "SortAggregate(key=[sink_table#" not in p


def test_asof_merge_carries_only_what_is_routed(spark, large):
    p = _plan(C.route_asof(spark, SF))
    assert "data, data#" in p                               # the row that travels
    assert "value, value#" not in p and "topic, topic#" not in p
    assert "BroadcastHashJoin" in p                         # the last config of each key
