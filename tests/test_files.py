import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from beaconfold.operators import files as fl
from beaconfold.operators import names as nm
from beaconfold.plans.mappings import notify_new_files, update_names
from beaconfold.schemas import NAME_TABLE
from beaconfold.sources.files import list_files, read_name_rows
from beaconfold.sources.state import (
    SnapshotConflict,
    read_snapshot,
    read_state,
    save_state,
    snapshot_version,
    update_snapshot,
    write_snapshot,
)

STATE = "stateKey string, value string"
LISTING = "stateKey string, key string, etag string"


def select(spark, files, state):
    listing = spark.createDataFrame(files, LISTING)
    return {
        (r["stateKey"], r["timestamp"], r["key"], r["etag"], r["apply_key"])
        for r in fl.select_latest_files(listing, spark.createDataFrame(state, STATE)).collect()
    }


FILES = [
    ("s", "in/a_20240101.csv", "e1"),
    ("s", "in/a_20240102_p1.csv", "e2"),
    ("s", "in/a_20240102_p2.csv", "e3"),
    ("s", "in/a_20240102_p3.csv", "e2"),
    ("s", "in/readme.csv", "e4"),
    ("s", "in/a_20240103.txt", "e5"),
    ("t", "in/b_20240105.csv", "e2"),
]
P2 = ("s", "20240102", "in/a_20240102_p2.csv", "e3", "in/a_20240102_p2.csv")
# Two files of one etag are one: the last key is read, in the place of the first.
P13 = ("s", "20240102", "in/a_20240102_p3.csv", "e2", "in/a_20240102_p1.csv")
T = ("t", "20240105", "in/b_20240105.csv", "e2", "in/b_20240105.csv")


def json_state(stamp, *etags):
    return json.dumps({"timestamp": stamp, "partitions": [{"filename": f"f{e}", "etag": e} for e in etags]})


@pytest.mark.parametrize(
    "value, want",
    [
        (None, {P2, P13}),
        ("20240102|e2", {P2}),
        ("20240101|e1", {P2, P13}),
        ("20240102|gone", {P2, P13}),
        (json_state("20240102", "e2", "e3"), set()),
        (json_state("20240101", "e2", "e3"), {P2, P13}),
        (json_state("20240103"), set()),
        (json_state("20240102"), {P2, P13}),
    ],
)
def test_latest_files(spark, value, want):
    assert select(spark, FILES, [("s", value)] if value else []) == want | {T}


def test_state_decode_and_advance(spark):
    state = spark.createDataFrame(
        [("s", "20240102|e2"), ("t", json_state("20240101", "x")), ("u", json_state("20240101", "y"))], STATE
    )
    decoded = {tuple(r) for r in fl.feed_state_files(fl.decode_feed_state(state)).collect()}
    assert decoded == {("s", "20240102", "", "e2"), ("t", "20240101", "fx", "x"), ("u", "20240101", "fy", "y")}
    selected = fl.select_latest_files(spark.createDataFrame(FILES, LISTING), state)
    advanced = fl.advance_feed_state(selected, state)
    assert {tuple(r) for r in advanced.collect()} == {
        ("s", "20240102", "a_20240102_p2.csv", "e3"),
        ("s", "20240102", "", "e2"),
        ("t", "20240105", "b_20240105.csv", "e2"),
    }
    encoded = {r[0]: json.loads(r[1]) for r in fl.encode_feed_state(advanced).collect()}
    assert encoded["t"] == {"timestamp": "20240105", "partitions": [{"filename": "b_20240105.csv", "etag": "e2"}]}
    assert {p["etag"] for p in encoded["s"]["partitions"]} == {"e2", "e3"}
    # What was saved is what is read next time: nothing is left to do.
    after = state.where("stateKey = 'u'").unionByName(fl.encode_feed_state(advanced))
    assert fl.select_latest_files(spark.createDataFrame(FILES, LISTING), after).isEmpty()


def test_new_files(spark):
    listing = spark.createDataFrame(
        [("x/new.csv", "1"), ("x/same.csv", "2"), ("x/changed.csv", "3"), ("y/twin.csv", "5"), ("z/twin.csv", "6")],
        "key string, etag string",
    )
    state = [("T.same.csv.processed_etag", "2"), ("T.changed.csv.processed_etag", "0"), ("U.new.csv.processed_etag", "1")]
    new = fl.detect_new_files(listing, spark.createDataFrame(state, STATE), "T")
    assert {r["key"] for r in new.collect()} == {"x/new.csv", "x/changed.csv", "y/twin.csv", "z/twin.csv"}
    saved = {tuple(r) for r in fl.processed_file_state(new).collect()}
    # Files are known by name alone, so the last of two folders stays on record.
    assert saved == {
        ("T.new.csv.processed_etag", "1"),
        ("T.changed.csv.processed_etag", "3"),
        ("T.twin.csv.processed_etag", "6"),
    }


def test_name_rows(spark, tmp_path):
    body = 'id,name,extra\n1,plain,x\n 2 ,"a, ""b"""\n3,\n4,""\n5,back\\slash\n6,Größe\n1,last\n'
    (tmp_path / "n.csv").write_text(body, encoding="utf-8")
    rows = read_name_rows(spark, str(tmp_path)).orderBy("row_no").collect()
    assert [(r["id"], r["name"]) for r in rows] == [
        (1, "plain"),
        (2, 'a, "b"'),
        (3, ""),
        (4, ""),
        (5, "back\\slash"),
        (6, "Größe"),
        (1, "last"),
    ]


def test_name_row_that_is_no_number_is_an_error(spark, tmp_path):
    (tmp_path / "n.csv").write_text("id,name\nx,y\n")
    with pytest.raises(Exception, match="not an id"):
        read_name_rows(spark, str(tmp_path)).collect()


def test_rows_keep_file_order_over_splits(spark, tmp_path):
    """A file read by many tasks still knows which row came last."""
    n = 20_000
    (tmp_path / "n.csv").write_text("id,name\n" + "".join(f"{i % 10},v{i:06d}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 16_000)
    try:
        rows = read_name_rows(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 4
        last = nm.last_names(rows.withColumn("apply_key", F.col("key")), "id")
        assert {tuple(r) for r in last.collect()} == {(i, f"v{n - 10 + i:06d}") for i in range(10)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_merge_names(spark):
    old = datetime(2023, 1, 1)
    target = spark.createDataFrame(
        [(10, 1, "one", 7, old, None, None), (10, 2, "two", 7, old, 7, old), (4, 1, "else", 7, old, None, None)], NAME_TABLE
    )
    now = datetime(2024, 1, 15, 12)
    incoming = spark.createDataFrame([(1, "ONE"), (3, "three")], "id bigint, name string")
    got = {tuple(r) for r in nm.merge_names(target, incoming, 10, now).collect()}
    assert got == {
        (10, 1, "ONE", 7, old, -2, now),
        (10, 2, "two", 7, old, 7, old),
        (10, 3, "three", -2, now, None, None),
        (4, 1, "else", 7, old, None, None),
    }


@pytest.fixture
def feed(spark, tmp_path):
    inbound = tmp_path / "inbound"
    inbound.mkdir()
    (inbound / "advertiser_generic_20240101.csv").write_text("id,name\n1,old\n9,never\n")
    (inbound / "advertiser_generic_20240102_a.csv").write_text("id,name\n1,a1\n1,a1\n2,a2\n1,a3\n")
    (inbound / "advertiser_generic_20240102_b.csv").write_text("id,name\n2,b2\n")
    (inbound / "campaign_generic_20240109.csv").write_text("id,name\n8,campaign\n")
    old = datetime(2023, 1, 1)
    table = spark.createDataFrame([(10, 2, "two", 7, old, None, None)], NAME_TABLE)
    write_snapshot(table, str(tmp_path / "names"), 1)

    def run(version):
        return update_names(
            spark,
            table="PARTNER_MEASURED_ADVERTISER",
            source_id=10,
            files_dir=str(inbound),
            name_prefix="advertiser_generic_",
            names_root=str(tmp_path / "names"),
            state_path=str(tmp_path / "state"),
            now=datetime(2024, 1, version),
        )

    return inbound, tmp_path, run


def test_name_run(spark, feed):
    inbound, root, run = feed
    assert run(2)
    names = {r["ID"]: (r["NAME"], r["CREATED_BY"], r["MODIFIED_BY"]) for r in read_snapshot(spark, f"{root}/names").collect()}
    assert names == {1: ("a3", -2, None), 2: ("b2", 7, -2)}
    # Nothing new: nothing happens.
    assert not run(3)
    # A third file of the same date is processed alone.
    (inbound / "advertiser_generic_20240102_c.csv").write_text("id,name\n5,c5\n")
    assert run(4)
    names = {r["ID"]: (r["NAME"], r["LAST_MODIFIED"]) for r in read_snapshot(spark, f"{root}/names").collect()}
    assert names == {1: ("a3", None), 2: ("b2", datetime(2024, 1, 2)), 5: ("c5", None)}
    state = read_state(spark, f"{root}/state").collect()
    assert len(state) == 1 and state[0]["stateKey"] == "name_mappings.PARTNER_MEASURED_ADVERTISER.10.latest_processed"
    assert len(json.loads(state[0]["value"])["partitions"]) == 3


def test_new_file_run(spark, tmp_path):
    inbound = tmp_path / "in"
    inbound.mkdir()
    (inbound / "discrepency_counts_1.csv").write_text("a")
    (inbound / "other.csv").write_text("a")

    def run(version):
        return notify_new_files(
            spark,
            files_dir=str(inbound),
            name_prefix="discrepency_counts_",
            files_type="discrepancies.snapchat",
            state_path=str(tmp_path / "state"),
            client_id="c",
            notices_path=str(tmp_path / f"notices{version}"),
        )

    def notices(version):
        rows = spark.read.json(str(tmp_path / f"notices{version}")).collect()
        return {(r["client_id"], r["data_url"].rsplit("/", 1)[1]) for r in rows}

    assert run(1) and notices(1) == {("c", "discrepency_counts_1.csv")}
    assert not run(2)
    (inbound / "discrepency_counts_1.csv").write_text("changed")
    (inbound / "discrepency_counts_2.csv").write_text("b")
    assert run(3) and notices(3) == {("c", "discrepency_counts_1.csv"), ("c", "discrepency_counts_2.csv")}
    assert not run(4)


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "f.csv").write_text("x" * 100)
    plan = list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_odd_file_names_match_between_listing_and_rows(spark, tmp_path):
    (tmp_path / "a b+c%20d_20240101.csv").write_text("id,name\n1,x\n")
    listed = list_files(spark, str(tmp_path)).first()["key"]
    assert listed.endswith("/a b+c%20d_20240101.csv")
    assert read_name_rows(spark, str(tmp_path)).first()["key"] == listed


def test_key_prefix_reaches_nested_and_dated_folders(spark, feed):
    inbound, root, run = feed
    nested = inbound / "advertiser_generic_feed_20240103" / "deep"
    nested.mkdir(parents=True)
    (nested / "part_20240103.csv").write_text('id,name\n7,"two\nlines"\n8,\n')
    assert run(5)
    names = {r["ID"]: r["NAME"] for r in read_snapshot(spark, f"{root}/names").collect()}
    assert names == {2: "two", 7: "two\nlines", 8: ""}
    assert not run(6)


def test_row_without_name_field_fails(spark, feed):
    inbound, root, run = feed
    (inbound / "advertiser_generic_20240104.csv").write_text("id,name\n1,x\n2\n")
    with pytest.raises(Exception, match="no name field"):
        run(7)
    assert read_state(spark, f"{root}/state").count() == 0 and snapshot_version(spark, f"{root}/names") == 1


def test_file_replaced_during_the_run_is_met_again(spark, feed, monkeypatch):
    from beaconfold.plans import mappings

    inbound, _, run = feed
    merge = mappings.merge_names

    def replace_then_merge(*args):
        (inbound / "advertiser_generic_20240102_b.csv").write_text("id,name\n2,replaced later\n")
        return merge(*args)

    monkeypatch.setattr(mappings, "merge_names", replace_then_merge)
    assert run(8)
    monkeypatch.setattr(mappings, "merge_names", merge)
    assert run(9) and not run(10)


def test_snapshot_versions(spark, tmp_path):
    root = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root)
    one = spark.createDataFrame([(1,)], "x bigint")
    assert update_snapshot(spark, root, lambda base: base.unionByName(one), "x bigint") == 1
    # Two writers on one base: the second is told, and its repeated change keeps the first one's rows.
    with pytest.raises(SnapshotConflict):
        write_snapshot(one, root, 1)
    raced = []

    def change(base):
        if not raced:
            raced.append(update_snapshot(spark, root, lambda b: b.unionByName(one.select((one.x + 1).alias("x")))))
        return base.unionByName(one.select((one.x + 9).alias("x")))

    assert update_snapshot(spark, root, change) == 3
    assert sorted(r.x for r in read_snapshot(spark, root).collect()) == [1, 2, 10]
    # A half-written version doesn't count.
    (tmp_path / "table" / "snapshot=9-dead").mkdir()
    assert snapshot_version(spark, root) == 3
    for k in range(8):
        update_snapshot(spark, root, lambda base: base)
    assert len([p for p in (tmp_path / "table").iterdir() if p.name.startswith("snapshot=")]) == 6


def test_state_records_override(spark, tmp_path):
    records = [[("a", "1"), ("b", "1")], [("b", "2")]]
    for r in records:
        save_state(spark.createDataFrame(r, "stateKey string, value string"), str(tmp_path / "s"))
    assert {tuple(r) for r in read_state(spark, str(tmp_path / "s")).collect()} == {("a", "1"), ("b", "2")}


def test_large_state_is_written_by_many_tasks(spark, tmp_path):
    keys = spark.range(0, 1000, 1, 4).selectExpr("cast(id AS string) AS stateKey", "'1' AS value")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        save_state(keys, str(tmp_path / "s"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "s").glob("segment-*/part-*.parquet"))) > 1
    save_state(keys.where("stateKey < '5'").withColumn("value", F.lit("2")), str(tmp_path / "s"))
    assert {tuple(r) for r in read_state(spark, str(tmp_path / "s")).collect()} == {(str(k), "2" if str(k) < "5" else "1") for k in range(1000)}
