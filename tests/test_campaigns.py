import random

import pytest
from pyspark.sql import functions as F

from beaconfold.operators import campaigns as cm

SOURCE = 10
TABLE = "MEASUREMENT_SOURCE_ID int, ID bigint, NAME string, CAMPAIGN_ID bigint"


def verdicts(pairs, entities, on_record):
    """Pair by pair, as the lookups and rules are worded."""
    targets = {}
    for campaign, entity in pairs:
        if entities.get(entity) is not None:
            targets.setdefault(campaign, set()).add(entities[entity])
    out = {}
    for campaign, entity in pairs:
        new, existing = entities.get(entity), on_record.get(campaign)
        if campaign is None:
            verdict = "MISSING_CAMPAIGN"
        elif new is None:
            verdict = "INVALID_ENTITY"
        elif existing is not None:
            verdict = "UNCHANGED" if existing == new else "OVERRIDE_REJECTED"
        elif len(targets[campaign]) > 1:
            verdict = "AMBIGUOUS"
        else:
            verdict = "UPDATE" if campaign in on_record else "INSERT"
        out[campaign, entity] = (existing if campaign is not None else None, new, verdict)
    return out


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(3)
    pairs = {(rng.choice([None, *range(60)]), rng.randrange(1, 40)) for _ in range(90)}
    entities = {e: rng.choice([None, 1, 2, 3]) for e in range(1, 30)}
    on_record = {c: rng.choice([None, 1, 2, 3]) for c in range(40)}
    campaigns = [(SOURCE, c, f"n{c}", v) for c, v in on_record.items()] + [(4, 1, "other", 9), (4, 50, "other", 8)]
    frames = (
        spark.createDataFrame(sorted(pairs, key=str), "partner_measured_campaign_id bigint, ias_adv_entity_id bigint"),
        spark.createDataFrame(list(entities.items()), "ID bigint, CAMPAIGN_ID bigint"),
        spark.createDataFrame(campaigns, TABLE),
    )
    return frames, verdicts(pairs, entities, on_record), campaigns


@pytest.mark.parametrize("broadcast", [True, False])
def test_classes(spark, case, broadcast):
    frames, want, _ = case
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit if broadcast else "-1")
    got = {(r[0], r[1]): (r[2], r[3], r[4]) for r in cm.classify_pairs(*frames, SOURCE).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == want
    assert {v[2] for v in want.values()} == {*cm.EXCEPTIONS, "UNCHANGED", "UPDATE", "INSERT"}


def test_apply_changes_only_what_the_classes_say(case):
    frames, want, campaigns = case
    classified = cm.classify_pairs(*frames, SOURCE)
    got = {(r[0], r[1]): (r[2], r[3]) for r in cm.apply_pairs(frames[2], classified, SOURCE).collect()}
    expected = {(s, c): (n, v) for s, c, n, v in campaigns}
    for (campaign, _), (_, new, verdict) in want.items():
        if verdict == "UPDATE":
            expected[SOURCE, campaign] = (f"n{campaign}", new)
        if verdict == "INSERT":
            expected[SOURCE, campaign] = ("DATA NOT RECEIVED", new)
    assert got == expected


def test_applying_twice_changes_nothing_more(case):
    frames, _, _ = case
    first = cm.apply_pairs(frames[2], cm.classify_pairs(*frames, SOURCE), SOURCE)
    second = cm.apply_pairs(first, cm.classify_pairs(frames[0], frames[1], first, SOURCE), SOURCE)
    assert sorted(map(tuple, first.collect()), key=str) == sorted(map(tuple, second.collect()), key=str)


def test_exceptions(case):
    frames, want, _ = case
    rows = cm.mapping_exceptions(cm.classify_pairs(*frames, SOURCE)).collect()
    got = {(r["kind"], r["partner_measured_campaign_id"], r["existing"], r["new"], r["ias_adv_entity_id"]) for r in rows}
    expected = set()
    for (campaign, entity), (existing, new, verdict) in want.items():
        if verdict in ("INVALID_ENTITY", "MISSING_CAMPAIGN"):
            expected.add((verdict, None, None, None, entity))
        elif verdict == "OVERRIDE_REJECTED":
            expected.add((verdict, campaign, existing, new, None))
        elif verdict == "AMBIGUOUS":
            expected.add((verdict, campaign, None, new, None))
    assert got == expected and len(rows) == len(expected)
    line = next(r for r in rows if r["kind"] == "OVERRIDE_REJECTED")
    assert line["report_line"] == "{:<19} | {:<24} | {:<19}".format(
        line["partner_measured_campaign_id"], line["existing"], line["new"]
    )


def test_extract_drops_unmapped_events(spark):
    events = spark.createDataFrame(
        [(1, 5), (1, 5), (1, 0), (2, None), (None, 7)], "partner_measured_campaign_id bigint, ias_adv_entity_id bigint"
    )
    assert {tuple(r) for r in cm.extract_pairs(events).collect()} == {(1, 5), (None, 7)}
    assert cm.extract_pairs(events.where(F.lit(False))).isEmpty()
