"""The daily run on files and in the catalog."""

import threading
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from beaconfold import fixtures as fx
from beaconfold.operators.campaigns import extract_pairs
from beaconfold.operators.mart import daily_mart
from beaconfold.operators.partitions import partitions_to_register, table_partitions
from beaconfold.operators.sessions import ad_sessions
from beaconfold.plans.mappings import extract_campaigns, update_campaigns
from beaconfold.plans.viewability import PartnerRunsFailed, SourceIncomplete, Warehouse, for_each_partner, register_day, run_day, run_days
from beaconfold.profiles import SNAPCHAT, select_profiles
from beaconfold.schemas import SESSIONS
from beaconfold.sinks.tables import read_mart, write_mart, write_pairs, write_sessions
from beaconfold.sources.days import day_folder
from beaconfold.sources.events import day_events, read_events, read_session_table, read_sessions
from beaconfold.sources.files import list_partition_hours, read_pairs
from beaconfold.sources.state import read_snapshot, write_snapshot
from tests.events import frame, random_events

SF_DIR = "/root/testdata/sf0.001"
DATE = "2024-01-15"
PROFILE = replace(SNAPCHAT, event_order="event_seq")


@pytest.fixture(scope="module")
def raw(spark):
    return fx.raw_events(spark, SF_DIR)


@pytest.fixture(scope="module")
def raw_root(raw, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    raw.write.partitionBy("utcdate", "utchour").parquet(f"{root}/snapchat")
    return str(root)


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_raw_partitions_stay_text_and_are_pruned(spark, raw_root):
    events = read_events(spark, PROFILE, path=f"{raw_root}/snapchat")
    assert dict(events.dtypes)["utchour"] == "string"
    plan = day_events(events, PROFILE, DATE, -18000)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "utcdate" in filters and "utchour" in filters
    assert " Filter" not in plan


def test_mapping_extraction_reads_two_columns(spark, raw_root):
    events = day_events(read_events(spark, PROFILE, path=f"{raw_root}/snapchat"), PROFILE, DATE, -18000)
    plan = extract_pairs(events)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<campaignid:bigint,iasadventityid:bigint>" in plan
    assert "PushedFilters: [IsNotNull(iasadventityid), Not(EqualTo(iasadventityid,0))]" in plan


def test_source_must_be_named_once(spark):
    with pytest.raises(ValueError):
        read_events(spark, PROFILE)
    with pytest.raises(ValueError):
        read_events(spark, PROFILE, database="d", path="p")


def test_day_run_writes_sessions_mart_and_notice(spark, raw, raw_root, tmp_path):
    warehouse = Warehouse(
        session_root=f"{tmp_path}/sessions", mart_root=f"{tmp_path}/mart", raw_root=raw_root, site_mart=True
    )
    notice = run_day(spark, PROFILE, warehouse, DATE)
    want = ad_sessions(day_events(raw, PROFILE, DATE, -18000), PROFILE, DATE, -18000).cache()
    assert rows(read_sessions(spark, f"{tmp_path}/sessions/snapchat", DATE)) == rows(want)
    assert rows(read_mart(spark, f"{tmp_path}/mart/snapchat", DATE)) == rows(daily_mart(want))
    urls = {r["data_url"] for r in notice.collect()}
    assert urls == {day_folder(spark, f"{tmp_path}/mart/{name}", DATE) + "/" for name in ("snapchat", "snapchat_site")}
    assert all("/date=20240115/" in u for u in urls)
    # What the notice names can be read as it is.
    text = spark.read.text(next(u for u in urls if "_site" not in u)).first()[0]
    fields = text.split("\t")
    assert len(fields) == 92 and fields[0] == "2024-01-15" and fields[4] == "\\N"
    names = [f.name for f in (tmp_path / "mart/snapchat/date=20240115").glob("_versions/*/*")]
    assert any(n.endswith(".csv.gz") for n in names)
    site = read_mart(spark, f"{tmp_path}/mart/snapchat_site", DATE, ("site",))
    assert rows(site) == rows(daily_mart(want, ("site",)))
    # Running the day again gives the same tables.
    run_day(spark, PROFILE, warehouse, DATE)
    assert rows(read_sessions(spark, f"{tmp_path}/sessions/snapchat", DATE)) == rows(want)


def test_rerun_leaves_nothing_behind_and_other_dates_alone(spark, raw, tmp_path):
    sessions = ad_sessions(day_events(raw, PROFILE, DATE, -18000), PROFILE, DATE, -18000).cache()
    root = f"{tmp_path}/sessions"
    before = sessions.withColumn("date", F.lit("20240114"))
    write_sessions(before, root, "2024-01-14")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_sessions(sessions, root, DATE)
        # The second run has no session in this hour; its old file must go.
        write_sessions(sessions.where("hour <> '07'"), root, DATE)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(read_sessions(spark, root, DATE)) == rows(sessions.where("hour <> '07'"))
    assert rows(read_sessions(spark, root, "2024-01-14")) == rows(before)


def test_incomplete_source_stops_the_run(spark, raw, tmp_path):
    part = raw.where("NOT (utcdate = '20240115' AND utchour = '12')")
    part.write.partitionBy("utcdate", "utchour").parquet(f"{tmp_path}/raw/snapchat")
    assert list_partition_hours(spark, f"{tmp_path}/raw/snapchat", ["20240115"]).count() == 23
    warehouse = Warehouse(session_root=f"{tmp_path}/s", mart_root=f"{tmp_path}/m", raw_root=f"{tmp_path}/raw")
    with pytest.raises(SourceIncomplete) as stopped:
        run_days(spark, warehouse, DATE, ["snapchat"])
    assert stopped.value.missing == [("20240115", "12")]
    assert not (tmp_path / "s").exists()


def test_a_rewrite_that_fails_leaves_the_old_day(spark, raw, tmp_path):
    sessions = ad_sessions(day_events(raw, PROFILE, DATE, -18000), PROFILE, DATE, -18000).cache()
    mart = daily_mart(sessions).cache()
    pairs = extract_pairs(day_events(raw, PROFILE, DATE, -18000)).cache()
    roots = {n: f"{tmp_path}/{n}" for n in ("sessions", "mart", "pairs")}
    writes = {"sessions": (write_sessions, sessions), "mart": (write_mart, mart), "pairs": (write_pairs, pairs)}
    reads = {"sessions": read_sessions, "mart": read_mart, "pairs": read_pairs}
    for name, (write, frame_) in writes.items():
        write(frame_, roots[name], DATE)
        # A reader that began before the rewrite ends with its own version.
        began = reads[name](spark, roots[name], DATE)
        first = frame_.columns[0]
        fails = F.when(F.rand() < 2, F.raise_error(F.lit("executor gone"))).otherwise(F.col(first))
        with pytest.raises(Exception, match="executor gone"):
            write(frame_.withColumn(frame_.columns[-1], fails.cast(frame_.dtypes[-1][1])), roots[name], DATE)
        assert rows(reads[name](spark, roots[name], DATE)) == rows(frame_)
        write(frame_.limit(3), roots[name], DATE)
        assert reads[name](spark, roots[name], DATE).count() == 3
        assert rows(began) == rows(frame_)
        write(frame_.where("false"), roots[name], DATE)
        assert reads[name](spark, roots[name], DATE).count() == 0
        # Of the committed versions two are kept.
        assert len(list((tmp_path / name / "date=20240115").glob("_commit-*"))) == 2


def test_days_of_the_first_release_are_read(spark, raw, tmp_path):
    sessions = ad_sessions(day_events(raw, PROFILE, DATE, -18000), PROFILE, DATE, -18000).cache()
    sessions.drop("date").write.partitionBy("hour").parquet(f"{tmp_path}/date=20240115")
    assert rows(read_sessions(spark, str(tmp_path), DATE)) == rows(sessions)
    write_sessions(sessions.limit(5), str(tmp_path), DATE)
    assert read_sessions(spark, str(tmp_path), DATE).count() == 5


def test_site_mart_keeps_texts_apart(spark, raw, tmp_path):
    sites = [None, "", "a\tb", 'q"x"', "back\\", "line\nbreak", "é,", " blank ", '""', "\\"]
    sessions = ad_sessions(day_events(raw, PROFILE, DATE, -18000), PROFILE, DATE, -18000).limit(len(sites) * 3).collect()
    frame_ = spark.createDataFrame([r.asDict() | {"site": sites[k % len(sites)]} for k, r in enumerate(sessions)], SESSIONS)
    mart = daily_mart(frame_, ("site",)).cache()
    write_mart(mart, str(tmp_path), DATE)
    assert {r.site for r in read_mart(spark, str(tmp_path), DATE, ("site",)).collect()} == set(sites)
    assert rows(read_mart(spark, str(tmp_path), DATE, ("site",))) == rows(mart)


def test_partners_run_side_by_side(spark):
    met = threading.Barrier(2, timeout=60)

    def run(profile):
        met.wait()
        if profile.name == "pinterest":
            raise ValueError("no data")
        return profile.name

    with pytest.raises(PartnerRunsFailed) as failed:
        for_each_partner(select_profiles(), run)
    assert failed.value.done == {"snapchat": "snapchat"}
    assert [e.__notes__ for e in failed.value.exceptions] == [["partner pinterest"]]
    assert for_each_partner([], run) == {}


def test_catalog_follows_a_rewrite(spark, raw, tmp_path):
    sessions = ad_sessions(day_events(raw, PROFILE, DATE, -18000), PROFILE, DATE, -18000).cache()
    data = ", ".join(f"{n} {t}" for n, t in sessions.drop("date", "hour").dtypes)
    spark.sql(f"CREATE TABLE followed ({data}, estdate STRING, esthour STRING) USING parquet PARTITIONED BY (estdate, esthour) LOCATION '{tmp_path}'")
    for part, new in ((sessions, 24), (sessions.where("hour <> '07'"), 0)):
        write_sessions(part, str(tmp_path), DATE)
        assert register_day(spark, "followed", str(tmp_path), DATE, by_hour=True) == new
        assert rows(read_session_table(spark, "followed", DATE)) == rows(part)
    spark.sql("DROP TABLE followed")


def test_day_run_through_the_catalog(spark, raw, tmp_path):
    for db in ("raw_db", "session_db", "mart_db"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    raw.write.partitionBy("utcdate", "utchour").saveAsTable("raw_db.snapchat")
    warehouse = Warehouse(
        session_root=f"{tmp_path}/sessions",
        mart_root=f"{tmp_path}/mart",
        raw_database="raw_db",
        session_database="session_db",
        mart_database="mart_db",
    )
    want = ad_sessions(day_events(raw, PROFILE, DATE, -18000), PROFILE, DATE, -18000).cache()
    data = ", ".join(f"{n} {t}" for n, t in want.drop("date", "hour").dtypes)
    spark.sql(
        f"CREATE TABLE session_db.snapchat ({data}, estdate STRING, esthour STRING) USING parquet"
        f" PARTITIONED BY (estdate, esthour) LOCATION '{tmp_path}/sessions/snapchat'"
    )
    mart = ", ".join(f"{n} {t}" for n, t in daily_mart(want).dtypes)
    spark.sql(
        f"CREATE TABLE mart_db.snapchat ({mart}, estdate STRING) USING csv OPTIONS (sep '\t', nullValue '\\\\N')"
        f" PARTITIONED BY (estdate) LOCATION '{tmp_path}/mart/snapchat'"
    )
    for _ in range(2):
        run_day(spark, PROFILE, warehouse, DATE)
        listed = table_partitions(spark, "session_db.snapchat")
        assert rows(listed) == Counter({("20240115", f"{h:02d}"): 1 for h in range(24)})
    assert rows(table_partitions(spark, "mart_db.snapchat")) == Counter({("20240115",): 1})
    got = read_session_table(spark, "session_db.snapchat", DATE).select(*want.columns)
    assert rows(got) == rows(want)
    assert rows(daily_mart(got)) == rows(spark.table("mart_db.snapchat").drop("estdate"))


def test_partition_plan_by_date(spark):
    days = spark.createDataFrame([("20240115",), ("20240116",)], "estdate string")
    existing = days.where("estdate = '20240115'")
    plan = partitions_to_register(days, existing, "s3://m/", False)
    assert [tuple(r) for r in plan.collect()] == [("20240116", "s3://m/date=20240116")]


def test_campaign_run(spark, raw, tmp_path):
    events = raw
    write_snapshot(fx.campaigns(spark, SF_DIR), f"{tmp_path}/campaigns", 1)
    extract_campaigns(events, PROFILE, DATE, f"{tmp_path}/pairs")

    def run(version):
        return update_campaigns(
            spark,
            PROFILE,
            DATE,
            pairs_root=f"{tmp_path}/pairs",
            entities=fx.entities(spark, SF_DIR),
            campaigns_root=f"{tmp_path}/campaigns",
            exceptions_path=f"{tmp_path}/exceptions/{version}",
        )

    assert run(2)
    first = rows(read_snapshot(spark, f"{tmp_path}/campaigns"))
    assert sum(r[2] == "DATA NOT RECEIVED" for r in first) > 0
    assert spark.read.json(f"{tmp_path}/exceptions/2").where("kind = 'OVERRIDE_REJECTED'").count() == 24
    assert run(3)
    assert rows(read_snapshot(spark, f"{tmp_path}/campaigns")) == first
    extract_campaigns(events.where("iasadventityid = 0"), PROFILE, DATE, f"{tmp_path}/pairs")
    assert not run(4)


def test_calendar_mode_reads_the_extra_hour(spark, tmp_path):
    sample = random_events(200, 20)
    hours = [("20241103", f"{h:02d}") for h in range(4, 24)] + [("20241104", f"{h:02d}") for h in range(5)]
    for i, r in enumerate(sample):
        d, h = hours[i % len(hours)]
        r |= {"utcdate": d, "utchour": h, "type": "impression", "impressionid": f"i{i}"}
    frame(spark, sample).write.partitionBy("utcdate", "utchour").parquet(f"{tmp_path}/raw/snapchat")
    counts = {}
    for mode in ("fixed24", "calendar"):
        root = f"{tmp_path}/{mode}"
        warehouse = Warehouse(session_root=f"{root}/s", mart_root=f"{root}/m", raw_root=f"{tmp_path}/raw")
        run_day(spark, PROFILE, warehouse, "2024-11-03", day_mode=mode)
        counts[mode] = read_sessions(spark, f"{root}/s/snapchat", "2024-11-03").count()
    assert counts == {"fixed24": 192, "calendar": 200}


def test_command_line(spark, raw, tmp_path):
    """Every job from its arguments; the profiles in use have no order column of their own."""
    from beaconfold.main import _parser, execute

    raw.drop("event_seq").write.partitionBy("utcdate", "utchour").parquet(f"{tmp_path}/raw/snapchat")
    fx.entities(spark, SF_DIR).createOrReplaceTempView("adv_entity")
    write_snapshot(fx.campaigns(spark, SF_DIR), f"{tmp_path}/campaigns", 1)
    inbound = tmp_path / "in"
    inbound.mkdir()
    (inbound / "advertiser_generic_20240101.csv").write_text("id,name\n1,one\n")
    write_snapshot(fx.name_target(spark, SF_DIR), f"{tmp_path}/names", 1)

    def run(line):
        execute(spark, _parser().parse_args(line.format(t=tmp_path).split()))

    day = "--data-date 2024-01-15 --partners snapchat"
    run(f"day {day} --raw-root {{t}}/raw --session-root {{t}}/s --mart-root {{t}}/m --notices-root {{t}}/n")
    run(f"sessions {day} --raw-root {{t}}/raw --session-root {{t}}/s2")
    run(f"mart {day} --session-root {{t}}/s2 --mart-root {{t}}/m2 --site-mart")
    assert rows(read_mart(spark, f"{tmp_path}/m/snapchat", DATE)) == rows(read_mart(spark, f"{tmp_path}/m2/snapchat", DATE))
    assert spark.read.json(f"{tmp_path}/n/snapchat/date=2024-01-15").count() == 1
    run(f"campaign-pairs {day} --raw-root {{t}}/raw --pairs-root {{t}}/p")
    run(
        f"campaigns {day} --pairs-root {{t}}/p --entity-table adv_entity --campaigns-root {{t}}/campaigns"
        " --exceptions-root {t}/x"
    )
    assert read_snapshot(spark, f"{tmp_path}/campaigns").where("NAME = 'DATA NOT RECEIVED'").count() > 0
    names = "names --table PARTNER_MEASURED_ADVERTISER --source-id 10 --files-dir {t}/in --names-root {t}/names"
    run(names + " --state-path {t}/state")
    assert read_snapshot(spark, f"{tmp_path}/names").where("NAME = 'one'").count() == 1
    run("new-files --files-dir {t}/in --name-prefix adv --files-type T --state-path {t}/state --notices-root {t}/f")
    assert spark.read.json(f"{tmp_path}/f/*").count() == 1


def test_partners_are_isolated_and_refusals(spark, raw, tmp_path):
    from beaconfold.main import _parser, execute

    raw.drop("event_seq").write.partitionBy("utcdate", "utchour").parquet(f"{tmp_path}/raw/snapchat")
    # Pinterest, which comes first, has no data; Snapchat's day is done all the same.
    line = f"day --data-date 2024-01-15 --raw-root {tmp_path}/raw --session-root {tmp_path}/s --mart-root {tmp_path}/m"
    with pytest.raises(ExceptionGroup) as failed:
        execute(spark, _parser().parse_args(line.split()))
    assert len(failed.value.exceptions) == 1 and read_mart(spark, f"{tmp_path}/m/snapchat", DATE).count() > 0
    with pytest.raises(ValueError, match="zone"):
        execute(spark, _parser().parse_args([*line.split(), "--day-mode", "calendar", "--data-date-tz-offset", "0"]))
    refused = "campaigns --data-date 2024-01-15 --partners pinterest --pairs-root p --entity-table e --campaigns-root c --exceptions-root x"
    with pytest.raises(ValueError, match="pinterest"):
        execute(spark, _parser().parse_args(refused.split()))


def test_other_days_are_not_listed(spark, tmp_path):
    from beaconfold.sources.files import list_partition_hours

    for day in ("20240114", "20240115", "20240116"):
        (tmp_path / f"utcdate={day}" / "utchour=03").mkdir(parents=True)
        (tmp_path / f"utcdate={day}" / "utchour=03" / "f").write_text("x")
    assert [tuple(r) for r in list_partition_hours(spark, str(tmp_path), ["20240115"]).collect()] == [("20240115", "03")]
    assert list_partition_hours(spark, str(tmp_path), ["20250101"]).count() == 0


def test_shared_root_is_refused_without_a_setting(spark):
    from types import SimpleNamespace

    from beaconfold.sources.scratch import shared_root

    none = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(
        master="spark://host:7077",
        getConf=lambda: SimpleNamespace(get=lambda name: None),
        _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)),
    )
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=context)
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        shared_root(session)
