"""Known totals of the derived inputs and of what the operators make of them (FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from beaconfold import fixtures as fx
from beaconfold.operators.events import dedupe_events
from beaconfold.operators.files import select_latest_files
from beaconfold.operators.names import incoming_names
from beaconfold.operators.sessions import session_facts
from beaconfold.plans import queries as q

SF = {"0.001": 0, "0.01": 1}


@pytest.fixture(params=SF, scope="module")
def case(request):
    return f"/root/testdata/sf{request.param}", SF[request.param]


def test_raw_events(spark, case):
    sf_dir, i = case
    totals = (
        fx.raw_events(spark, sf_dir)
        .agg(
            F.expr("count(*)"),
            F.expr("count(DISTINCT impressionid)"),
            F.expr("sum(timestamp)"),
            F.expr("sum(CAST(inview50 AS INT))"),
            F.expr("sum(CAST(fullscreen AS INT))"),
            F.expr("sum(noncontinuousplaytime)"),
            F.expr("sum(audibleplaytime)"),
            F.expr("count(fraudcategory)"),
            F.expr("sum(iasadventityid)"),
            F.expr("sum(CAST(utchour AS INT))"),
        )
        .first()
    )
    assert tuple(totals) == (
        (7558, 1499, 987794464, 3923, 528, 15225700, 4797400, 706, 56004, 86916),
        (75584, 14971, 9922043216, 39246, 5396, 152413500, 47917800, 7246, 655739, 868470),
    )[i]


def test_dedupe_and_sessions(spark, case):
    sf_dir, i = case
    for profile, want in ((q.BY_IMPRESSION, (2448, 24004)), (q.BY_IMPRESSION_TIME, (2207, 21596))):
        assert dedupe_events(q._events(spark, sf_dir, profile), profile.dedupe_keys).count() == want[i]
    facts = session_facts(q._events(spark, sf_dir), q.BY_IMPRESSION, impressions_only=False)
    assert facts.count() == (516, 5198)[i]
    known = facts.where("saw_impression").agg(
        F.expr("count(*)"),
        F.expr("count_if(plays_muted)"),
        F.expr("count(plays_muted)"),
        F.expr("count_if(impression_full_screen)"),
        F.expr("count(impression_full_screen)"),
        F.expr("sum(CAST(utchour AS INT))"),
    )
    assert tuple(known.first()) == ((451, 394, 439, 32, 425, 5190), (4555, 3986, 4393, 330, 4288, 52430))[i]


def test_mart(spark, case):
    sf_dir, i = case
    totals = q.jas_mart_daily(spark, sf_dir).agg(
        F.count("*"), F.sum("imps"), F.sum("in_view_imps"), F.sum("in_view_1q_imps")
    )
    assert tuple(totals.first()) == ((374, 451, 49, 24), (1171, 4555, 525, 255))[i]


def test_campaign_classes(spark, case):
    sf_dir, i = case
    counts = dict(map(tuple, q.campaign_mapping_classify(spark, sf_dir).groupBy("class").count().collect()))
    assert sum(counts.values()) == (93, 105)[i]
    assert (counts["INVALID_ENTITY"], counts["OVERRIDE_REJECTED"], counts["UNCHANGED"]) == ((8, 24, 32), (10, 24, 36))[i]
    # Known before pairs with more than one target are set apart.
    assert counts.get("AMBIGUOUS", 0) + counts["INSERT"] + counts["UPDATE"] == (15 + 14, 19 + 16)[i]


def test_name_files_without_state(spark, case):
    sf_dir, i = case
    no_state = fx.name_feed_state(spark, sf_dir).limit(0)
    selected = select_latest_files(fx.name_listing(spark, sf_dir), no_state)
    rows = fx.name_rows(spark, sf_dir)
    assert rows.join(selected, "key", "left_semi").count() == (90, 900)[i]
    names = incoming_names(rows.drop("source"), selected)
    target = fx.name_target(spark, sf_dir).select(F.col("ID").alias("id"))
    assert names.count() == (70, 700)[i]
    assert names.where("name LIKE '%-c'").count() == (30, 300)[i]
    assert names.join(target, "id", "left_anti").count() == (65, 653)[i]
