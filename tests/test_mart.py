from collections import defaultdict
from dataclasses import replace

import pytest

from beaconfold.operators.mart import daily_mart
from beaconfold.operators.sessions import ad_sessions
from beaconfold.profiles import SNAPCHAT
from beaconfold.schemas import MART, MART_KEYS, SESSION_DATA, SESSIONS, mart_column
from beaconfold.sources.events import canonical_events
from tests.events import frame, random_events

PROFILE = replace(SNAPCHAT, event_order="event_seq")
FLAGS = [f.name for f in SESSION_DATA.fields if f.dataType.simpleString() == "boolean"]


@pytest.fixture(scope="module")
def sessions(spark):
    events = canonical_events(frame(spark, random_events(4000, 600)), PROFILE)
    return ad_sessions(events, PROFILE, "2024-01-15", -18000).cache()


def expected(sessions, extra=()):
    groups = defaultdict(list)
    for r in sessions.collect():
        groups[tuple(r[k] for k in (*extra, *MART_KEYS[1:]))].append(r)
    return groups


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


@pytest.mark.parametrize("extra", [(), ("site",)])
def test_mart_counts(sessions, extra):
    mart = daily_mart(sessions, extra)
    assert mart.columns == [*extra, *MART.names]
    assert [f.dataType for f in mart.schema.fields][len(extra) :] == [f.dataType for f in MART.fields]
    groups = expected(sessions, extra)
    rows = mart.collect()
    assert len(rows) == len(groups)
    for row in rows:
        members = groups[tuple(row[k] for k in (*extra, *MART_KEYS[1:]))]
        assert row["hit_date"].isoformat() == "2024-01-15"
        assert row["imps"] == len(members)
        for flag in FLAGS:
            count = row[mart_column(flag)]
            assert count == total([m[flag] for m in members]), flag
            assert count is None or count <= row["imps"]


def test_unknown_is_null_and_never_is_zero(sessions):
    for row in daily_mart(sessions).collect():
        assert row["measured_imps"] is None and row["below_the_fold_imps"] is None
        assert row["time_on_page"] is None and row["average_in_view_time"] is None and row["pm_platform"] is None
        assert row["click_through_imps"] == 0 and row["groupm_in_view_5s_imps"] == 0


def test_layout_sizes():
    assert (len(SESSIONS), len(MART), len(FLAGS)) == (93, 92, 77)
    names = MART.names
    assert names[names.index("imps") - 1] == "viewability_measurement_trusted_imps"
    assert names[names.index("pm_platform") - 1] == "full_ad_in_view_imps"
    assert names[-1] == "viewability_measured_or_fraud_ads"
