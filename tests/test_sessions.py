from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from beaconfold.operators import events as events_module
from beaconfold.operators.events import dedupe_events, hot_buckets, with_salt
from beaconfold.operators.sessions import FACTS, RULES, ad_sessions, session_facts
from beaconfold.profiles import PINTEREST, SNAPCHAT, PartnerProfile, select_profiles
from beaconfold.schemas import SESSIONS
from beaconfold.sources.events import canonical_events, day_events
from tests.brute import dedupe, fold
from tests.events import canonical, frame, random_events

DATE, OFFSET = "2024-01-15", -18000
PROFILES = [replace(p, event_order="event_seq") for p in (SNAPCHAT, PINTEREST)]


@pytest.fixture(scope="module")
def rows():
    return random_events(4000, 300)


@pytest.mark.parametrize("profile", PROFILES, ids=lambda p: p.name)
@pytest.mark.parametrize("hot_rows", [1_000_000, 1], ids=["ordinary", "hot"])
def test_sessions_equal_brute_force(spark, rows, profile, hot_rows, monkeypatch):
    if hot_rows == 1:
        # Few buckets, so that some of them stand out and the rest does not.
        monkeypatch.setattr(events_module, "HASH_BUCKETS", 64)
        monkeypatch.setattr(events_module, "HOT_FACTOR", 1)
    events = day_events(frame(spark, rows), profile, DATE, OFFSET)
    if hot_rows == 1:
        hot = hot_buckets(events, profile.session_keys, hot_rows)
        salted = with_salt(events, [r[0] for r in hot.collect()], profile.session_keys)
        counts = salted.where("_salt = 0").count(), salted.where("_salt > 0").count()
        assert min(counts) > 0 and sum(counts) == len(rows)
    got = ad_sessions(events, profile, DATE, OFFSET, hot_session_events=hot_rows)
    assert got.columns == SESSIONS.names
    assert [f.dataType for f in got.schema.fields] == [f.dataType for f in SESSIONS.fields]
    assert Counter(map(tuple, got.collect())) == Counter(fold(canonical(rows), profile, DATE, OFFSET))


@pytest.mark.parametrize("profile", PROFILES, ids=lambda p: p.name)
def test_input_order_and_partitioning_do_not_matter(spark, rows, profile):
    results = []
    for partitions, data in ((1, rows), (64, rows[::-1])):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        events = day_events(frame(spark, data, partitions), profile, DATE, OFFSET)
        results.append(Counter(map(tuple, ad_sessions(events, profile, DATE, OFFSET).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert results[0] == results[1]


def test_dedupe_keeps_the_first_of_each_key(spark, rows):
    profile = PROFILES[0]
    events = canonical_events(frame(spark, rows), profile)
    got = dedupe_events(events, profile.dedupe_keys).select("event_seq").collect()
    want = dedupe(canonical(rows), profile.dedupe_keys)
    assert len(want) < len(rows)
    assert sorted(r[0] for r in got) == sorted(e["event_seq"] for e in want)


def test_without_an_order_column_the_result_is_still_deterministic(spark, rows):
    def run(data, partitions):
        events = day_events(frame(spark, data, partitions).drop("event_seq"), SNAPCHAT, DATE, OFFSET)
        return Counter(map(tuple, ad_sessions(events, SNAPCHAT, DATE, OFFSET).collect()))

    assert run(rows, 2) == run(rows[::-1], 16)


def test_events_of_other_days_are_left_out(spark, rows):
    profile = PROFILES[0]
    early = [{**r, "utchour": "04"} for r in rows[:100]]
    events = day_events(frame(spark, rows + early), profile, DATE, OFFSET)
    assert events.count() == len(rows)


def test_hour_of_half_hour_zones_is_rounded_down(spark, rows):
    profile = PROFILES[0]
    hours = {}
    for offset in (-18000, 19800, 0):
        events = canonical_events(frame(spark, rows), profile)
        got = ad_sessions(events, profile, DATE, offset)
        assert Counter(map(tuple, got.collect())) == Counter(fold(canonical(rows), profile, DATE, offset))
        hours[offset] = got.count()
    assert len(set(hours.values())) == 1


def test_rule_groups_name_the_facts_they_use(spark, rows):
    profile = PROFILES[0]
    events = canonical_events(frame(spark, rows[:50]), profile)
    for name, group in RULES.items():
        facts = session_facts(events, profile, group.facts)
        # Resolves only if every column it refers to is among its facts.
        facts.selectExpr(*[f"{rule} AS {c}" for c, rule in group.columns.items()]).schema
        assert set(group.facts) <= set(FACTS), name


def test_one_key_with_a_third_of_all_rows_is_spread(spark):
    """Most rows in one session, many of them copies: found, split, and folded to the same result."""
    rows = random_events(3000, 1000, seed=1)
    big = random_events(6000, 1, seed=2)
    for i, r in enumerate(big):
        r |= {"impressionid": "big", "event_seq": 100_000 + i, "timestamp": i % 500}
    copies = [{**big[0], "event_seq": 900_000 + i} for i in range(3000)]
    profile = PROFILES[0]
    everything = rows + big + copies
    events = day_events(frame(spark, everything), profile, DATE, OFFSET)
    hot = hot_buckets(events, profile.session_keys, 1000)
    oversized = with_salt(events, [r[0] for r in hot.collect()], profile.session_keys).where("_salt > 0")
    assert hot.count() == 1
    big = oversized.where(F.col("impression_id") == "big")
    assert big.count() == 9000
    # Copies of one event are dealt like any other rows.
    assert big.groupBy("_salt").count().agg(F.max("count")).first()[0] < 100
    got = ad_sessions(events, profile, DATE, OFFSET, hot_session_events=1000)
    assert Counter(map(tuple, got.collect())) == Counter(fold(canonical(everything), profile, DATE, OFFSET))


def test_profiles(spark):
    assert [p.name for p in select_profiles()] == ["pinterest", "snapchat"]
    assert [p.name for p in select_profiles(["snapchat"])] == ["snapchat"]
    with pytest.raises(ValueError):
        select_profiles(["nobody"])
    with pytest.raises(ValueError):
        PartnerProfile("x", session_keys=("site",))


def test_event_literals_are_a_profile_setting(spark):
    rows = [
        {**random_events(1, 1)[0], "impressionid": "a", "timestamp": 1, "type": t, "event_seq": i}
        | {"suspicious": False, "givt": False}
        for i, t in enumerate(["impression", "third-quartile"])
    ]
    profile = PROFILES[0]
    respelt = replace(profile, events={**profile.events, "third_quartile": "third-quartile"})
    for p, want in ((profile, False), (respelt, True)):
        got = ad_sessions(canonical_events(frame(spark, rows), p), p, DATE, OFFSET)
        assert got.first()["completed_3q"] is want
