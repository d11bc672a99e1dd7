"""Commits that can't block, the state log, and rows handed on with a commit."""

import pytest
from pyspark.sql import functions as F

from beaconfold import fixtures as fx
from beaconfold.operators.campaigns import classify_pairs, mapping_exceptions
from beaconfold.plans import mappings
from beaconfold.plans.mappings import extract_campaigns, notify_new_files, update_campaigns
from beaconfold.profiles import SNAPCHAT
from beaconfold.schemas import NAME_TABLE
from beaconfold.sources import commits, state
from beaconfold.sources.files import read_pairs
from beaconfold.sources.state import SnapshotConflict, read_snapshot, read_state, save_state, snapshot_version, update_snapshot, write_snapshot

SF_DIR = "/root/testdata/sf0.001"
DATE = "2024-01-15"


def records(spark, **values):
    return spark.createDataFrame(list(values.items()), state.STATE)


def held(spark, path, *args):
    found = [tuple(r) for r in read_state(spark, path, *args).collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def segments(path):
    return sorted(p.name for p in path.iterdir() if p.name.startswith("segment"))


def test_a_dead_writer_blocks_nobody(spark, tmp_path):
    """Markers that were created and never filled, for names, campaigns and state alike."""
    one = spark.createDataFrame([(1,)], "x bigint")
    root = str(tmp_path / "table")
    write_snapshot(one, root, 1)
    (tmp_path / "table" / "_commit-2").write_text("")
    assert snapshot_version(spark, root) == 1
    assert update_snapshot(spark, root, lambda base: base.unionByName(one)) == 3
    assert read_snapshot(spark, root).count() == 2
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "_commit-1").write_text("")
    assert save_state(records(spark, a="1"), str(tmp_path / "state")) == 2
    (tmp_path / "state" / "_commit-3").write_text(" ")
    assert save_state(records(spark, b="2"), str(tmp_path / "state")) == 4
    assert held(spark, str(tmp_path / "state")) == {"a": "1", "b": "2"}
    # A writer that died before its commit got a number.
    (tmp_path / "table" / "_pending-x").write_text('{"fold')
    assert update_snapshot(spark, root, lambda base: base) == 4


def test_markers_of_the_first_release_are_read(spark, tmp_path):
    spark.createDataFrame([("a", "1")], state.STATE).write.parquet(f"{tmp_path}/snapshot=1-old")
    (tmp_path / "_commit-1").write_text("snapshot=1-old")
    assert held(spark, str(tmp_path)) == {"a": "1"}
    save_state(records(spark, a="2"), str(tmp_path))
    assert held(spark, str(tmp_path)) == {"a": "2"}


def test_a_number_is_given_once(spark, tmp_path):
    root = str(tmp_path)
    commits.publish(spark, root, 1, {"folders": ["first"]})
    with pytest.raises(SnapshotConflict):
        commits.publish(spark, root, 1, {"folders": ["second"]})
    assert commits.latest(spark, root).content == {"folders": ["first"]}
    assert not [p for p in tmp_path.iterdir() if "pending" in p.name]


def test_a_save_writes_its_own_records_only(spark, tmp_path):
    root = str(tmp_path)
    save_state(spark.range(10_000).selectExpr("concat('k', id) AS stateKey", "'0' AS value"), root)
    base = segments(tmp_path)
    want = {f"k{k}": "0" for k in range(10_000)}
    for n in range(1, 12):
        save_state(records(spark, **{f"k{n}": str(n), f"new{n}": "x"}), root)
        want |= {f"k{n}": str(n), f"new{n}": "x"}
        assert held(spark, root) == want
        # The large segment stays as it is; the newer ones are few, as they are merged among themselves.
        assert base[0] in commits.latest(spark, root).content["folders"]
        assert len(commits.latest(spark, root).content["folders"]) <= 4
    assert held(spark, root, "new1") == {f"new{n}": "x" for n in (1, 10, 11)}
    # The folders of old versions are gone, those of the kept ones are not.
    needed = set().union(*(c.folders() for c in commits.commits(spark, root)))
    assert set(segments(tmp_path)) == needed


def test_segments_merge_geometrically():
    assert state.merge_from([100]) == 0 and state.merge_from([100, 10]) == 1
    assert state.merge_from([100, 10, 3]) == 1 and state.merge_from([200, 30, 2]) == 2 and state.merge_from([100, 30, 2]) == 0 and state.merge_from([39, 10]) == 0
    rows, written = [], 0
    for _ in range(4096):
        rows.append(1)
        first = state.merge_from(rows)
        if first < len(rows) - 1:
            rows = [*rows[:first], sum(rows[first:])]
            written += rows[-1]
        assert all(a >= 4 * sum(rows[k + 1 :]) for k, a in enumerate(rows[:-1]))
    assert sum(rows) == 4096 and len(rows) <= 7 and written < 4096 * 32


def test_saves_at_once_both_count(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    save_state(records(spark, a="1"), root)
    publish, raced = commits.publish, []

    def other_first(*args):
        if not raced:
            raced.append(True)
            save_state(records(spark, b="other"), root)
        return publish(*args)

    monkeypatch.setattr(state, "publish", other_first)
    save_state(records(spark, a="2", c="3"), root)
    assert held(spark, root) == {"a": "2", "b": "other", "c": "3"}
    # With a base, the same is a conflict and leaves nothing.
    raced.clear()
    before = snapshot_version(spark, root)
    with pytest.raises(SnapshotConflict):
        save_state(records(spark, a="9"), root, base=before)
    assert held(spark, root) == {"a": "2", "b": "other", "c": "3"}
    with pytest.raises(SnapshotConflict):
        read_state(spark, root, version=before)


def test_rows_of_a_dead_writer_are_delivered_by_the_next_run(spark, tmp_path, monkeypatch):
    inbound = tmp_path / "in"
    inbound.mkdir()
    (inbound / "counts_1.csv").write_text("a")

    def run(n):
        return notify_new_files(
            spark, files_dir=str(inbound), name_prefix="counts_", files_type="T", state_path=f"{tmp_path}/state", client_id="c", notices_path=f"{tmp_path}/n{n}",
        )

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(state, "deliver", dies)
        with pytest.raises(KeyboardInterrupt):
            run(1)
    assert not (tmp_path / "n1").exists() and read_state(spark, f"{tmp_path}/state").count() == 1
    # Nothing is new, but what was committed is handed on, once.
    assert not run(2)
    assert spark.read.json(f"{tmp_path}/n1").count() == 1 and not (tmp_path / "n2").exists()
    assert commits.deliver(spark, f"{tmp_path}/state") == 0
    # An undelivered outbox outlives later versions.
    (inbound / "counts_2.csv").write_text("b")
    with monkeypatch.context() as m:
        m.setattr(state, "deliver", lambda *args: 0)
        run(3)
        for k in range(8):
            save_state(records(spark, other=str(k)), f"{tmp_path}/state")
    assert not run(4) and spark.read.json(f"{tmp_path}/n3").count() == 1


def test_two_notice_runs_announce_a_change_once(spark, tmp_path, monkeypatch):
    inbound = tmp_path / "in"
    inbound.mkdir()
    (inbound / "counts_1.csv").write_text("a")
    detect, raced = mappings.detect_new_files, []

    def run(n):
        return notify_new_files(
            spark, files_dir=str(inbound), name_prefix="counts_", files_type="T", state_path=f"{tmp_path}/state", client_id="c", notices_path=f"{tmp_path}/n{n}",
        )

    def other_first(*args):
        if not raced:
            raced.append(True)
            assert run(1)
        return detect(*args)

    monkeypatch.setattr(mappings, "detect_new_files", other_first)
    assert not run(2)
    assert spark.read.json(f"{tmp_path}/n1").count() == 1 and not (tmp_path / "n2").exists()


def test_campaign_report_is_that_of_the_committed_table(spark, tmp_path, monkeypatch):
    root, pairs_root = f"{tmp_path}/campaigns", f"{tmp_path}/pairs"
    entities = fx.entities(spark, SF_DIR)
    write_snapshot(fx.campaigns(spark, SF_DIR), root, 1)
    extract_campaigns(fx.raw_events(spark, SF_DIR), SNAPCHAT, DATE, pairs_root)
    classify, raced = mappings.classify_pairs, []

    def writer_in_between(*args):
        made = classify(*args)
        if not raced:
            raced.append(True)
            update_snapshot(spark, root, lambda base: base.withColumn("CAMPAIGN_ID", F.lit(999).cast("bigint")))
        return made

    monkeypatch.setattr(mappings, "classify_pairs", writer_in_between)
    assert update_campaigns(spark, SNAPCHAT, DATE, pairs_root=pairs_root, entities=entities, campaigns_root=root, exceptions_path=f"{tmp_path}/x")
    base = fx.campaigns(spark, SF_DIR).withColumn("CAMPAIGN_ID", F.lit(999).cast("bigint"))
    want = mapping_exceptions(classify_pairs(read_pairs(spark, pairs_root, DATE), entities, base, SNAPCHAT.measurement_source_id))
    lines = sorted(r.report_line or "" for r in spark.read.json(f"{tmp_path}/x").collect())
    assert lines == sorted(r.report_line or "" for r in want.collect()) and sum("999" in line for line in lines) > 10
    assert snapshot_version(spark, root) == 3


def test_reference_tables_start_empty(spark, tmp_path):
    assert read_snapshot(spark, str(tmp_path / "none"), NAME_TABLE).count() == 0
    assert read_state(spark, str(tmp_path / "none")).count() == 0
