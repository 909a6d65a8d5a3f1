"""What the physical plans must not, and must, contain."""

import re

import pytest

import __spark_entry__ as entry
from kerbside.operators import series_windows as S
from kerbside.operators.quality import rules as R
from kerbside.plans import all_queries
from kerbside.plans.tables import Tables

SMALL = "/root/testdata/sf0.001"
LAZY = [
    name
    for name, query in sorted(all_queries().items())
    if query.sql and not query.run.__module__.endswith(("stream_queries", "learning_queries"))
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As if every dimension were too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_cross_joins_and_no_python(spark, no_broadcast):
    for name in LAZY:
        text = plan(entry.queries()[name](spark, SMALL))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "ArrowEvalPython", "MapInPandas"):
            assert word not in text, (name, word)


def test_row_level_queries_do_not_shuffle(spark):
    for name in ("en_distcat", "en_route", "fx_lateness", "dec_explode", "val_sensor", "tx_enrich", "evt_format"):
        assert "Exchange" not in plan(entry.queries()[name](spark, SMALL)), name


def test_one_shuffle_per_tumbling_report(spark):
    for name in ("tw_trips", "tw_districts", "tw_taxi_types", "wm_none", "wm_lateness", "st_tumble", "st_by_type"):
        assert plan(entry.queries()[name](spark, SMALL)).count("Exchange ") == 1, name


def test_scans_read_and_filter_what_is_needed(spark):
    t = Tables(spark, SMALL)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(R.rule_fare_per_km(t.trips))).group(1)
    assert {field.split(":")[0] for field in schema.split(",")} == {"l_quantity", "l_extendedprice"}
    assert re.search(r"PushedFilters: \[[^]]*In\(event_type, \[purchase,signup\]\)", plan(S.st_tumble(t.trades)))
