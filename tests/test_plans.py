"""The physical plans are the ones intended."""

from dataclasses import replace

import pytest

import __spark_entry__ as entry_point
from beaconfold.plans import queries as catalogue
from beaconfold import fixtures as fx
from beaconfold.operators.events import dedupe_events
from beaconfold.operators.sessions import ad_sessions
from beaconfold.profiles import PINTEREST, SNAPCHAT
from beaconfold.sources.events import day_events, read_events

SF_DIR = "/root/testdata/sf0.001"
DATE, OFFSET = "2024-01-15", -18000


def final_plan(df):
    """The plan adaptive execution ended with."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("profile", [SNAPCHAT, PINTEREST], ids=lambda p: p.name)
def test_one_shuffle_and_one_sort_when_no_session_is_oversized(spark, profile):
    profile = replace(profile, event_order="event_seq")
    events = day_events(fx.raw_events(spark, SF_DIR), profile, DATE, OFFSET)
    plan = final_plan(ad_sessions(events, profile, DATE, OFFSET))
    assert plan.count("Exchange ") == 1
    assert plan.count("Sort [") == 1
    assert "Join" not in plan


def test_both_session_routes_read_the_events_once(spark, tmp_path):
    fx.one_large_session(fx.raw_events(spark, SF_DIR)).write.partitionBy("utcdate", "utchour").parquet(f"{tmp_path}/raw")
    profile = replace(SNAPCHAT, event_order="event_seq")
    events = day_events(read_events(spark, profile, path=f"{tmp_path}/raw"), profile, DATE, OFFSET)
    sessions = ad_sessions(events, profile, DATE, OFFSET, hot_session_events=catalogue.HOT_IN_TESTS)
    plan = final_plan(sessions)
    assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") == 1
    assert "Union" in plan


def test_shipped_profiles_read_the_columns_of_their_facts(spark, tmp_path):
    fx.raw_events(spark, SF_DIR).write.partitionBy("utcdate", "utchour").parquet(f"{tmp_path}/raw")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    try:
        for profile in (SNAPCHAT, PINTEREST):
            events = day_events(read_events(spark, profile, path=f"{tmp_path}/raw"), profile, DATE, OFFSET)
            plan = final_plan(ad_sessions(events, profile, DATE, OFFSET))
            read = plan.split("ReadSchema: ")[1].split(">")[0]
            assert "iasadventityid" not in read and "campaignid" in read
            assert plan.count("Exchange ") == 1
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_copies_collapse_before_the_shuffle(spark):
    profile = replace(SNAPCHAT, event_order="event_seq")
    events = day_events(fx.raw_events(spark, SF_DIR), profile, DATE, OFFSET)
    plan = final_plan(dedupe_events(events, profile.dedupe_keys))
    below_shuffle = plan.split("Exchange ")[1]
    assert "partial_min" in below_shuffle


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_no_query_leaves_the_jvm_or_crosses_rows(spark, name):
    plan = catalogue.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "RDDScan", "ExistingRDD"):
        assert operator not in plan


def test_entry(spark):
    df = entry_point.entry(spark)
    assert len(df.columns) == 92
    assert df.count() == 374
