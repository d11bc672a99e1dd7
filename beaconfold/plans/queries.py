"""Every operator as a query over the test tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold import fixtures as fx
from beaconfold.functions.calendar import day_windows
from beaconfold.functions.expressions import flag_count, local_hour, nodash
from beaconfold.operators import campaigns as cm
from beaconfold.operators import files as fl
from beaconfold.operators import names as nm
from beaconfold.operators import partitions as pt
from beaconfold.operators.events import dedupe_events
from beaconfold.operators.mart import daily_mart
from beaconfold.operators.sessions import RULES, ad_sessions, rule_columns, session_facts
from beaconfold.plans.mappings import extract_campaigns, notify_new_files, update_campaigns, update_names
from beaconfold.plans.viewability import PartnerRunsFailed, Warehouse, run_day, run_days
from beaconfold.profiles import PINTEREST, SNAPCHAT, PartnerProfile
from beaconfold.schemas import EVENT_TYPES, FRAUD_CATEGORIES, MART, MART_KEYS, MART_MEASURES, RETENTION_DAYS, SESSION_DATA
from beaconfold.sinks.tables import read_mart, write_mart, write_pairs, write_sessions
from beaconfold.sources.events import day_events, read_session_table, read_sessions
from beaconfold.sources.files import read_pairs
from beaconfold.sources.scratch import shared_dir
from beaconfold.sources.state import read_snapshot, write_snapshot

Query = Callable[[SparkSession, str], DataFrame]

DATE, OFFSET = fx.TEST_DATE, fx.TEST_OFFSET
BY_IMPRESSION = replace(SNAPCHAT, event_order="event_seq")
BY_IMPRESSION_TIME = replace(PINTEREST, event_order="event_seq")
CLIENT_ID = "ad-sessions"
RETENTION_AS_OF = "2001-01-01"
MERGED_AT = datetime(2024, 1, 15)
HOT_IN_TESTS = 100

_QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def _events(spark: SparkSession, sf_dir: str, profile: PartnerProfile = BY_IMPRESSION) -> DataFrame:
    timestamp = "s0" if profile is BY_IMPRESSION_TIME else "s1"
    return day_events(fx.raw_events(spark, sf_dir, timestamp), profile, DATE, OFFSET)


def _facts(spark: SparkSession, sf_dir: str, group: str) -> DataFrame:
    return session_facts(_events(spark, sf_dir), BY_IMPRESSION, RULES[group].facts)


# ---- days and sources -------------------------------------------------------------------


@_query
def local_day_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = fx.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("data_date")).distinct()
    return day_windows(dates, tz_offset=OFFSET)


@_query
def local_day_window_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = fx.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("data_date")).distinct()
    modes = [day_windows(dates, zone="America/New_York", day_mode=m).withColumn("day_mode", F.lit(m)) for m in ("fixed24", "calendar")]
    return modes[0].unionByName(modes[1])


@_query
def source_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir)


@_query
def source_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = fx.source_hours(spark, sf_dir)
    dates = (
        fx.local_hours(spark, sf_dir).select(F.to_date("estdate", "yyyyMMdd").alias("data_date")).distinct()
    )
    # One hour of the test day has not arrived.
    present = hours.where(~((F.col("utcdate") == "20240115") & (F.col("utchour") == "12")))
    return pt.missing_source_hours(dates, present, tz_offset=OFFSET)


@_query
def event_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_events(_events(spark, sf_dir), BY_IMPRESSION.dedupe_keys)


# ---- sessions ---------------------------------------------------------------------------


@_query
def session_hour_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = session_facts(_events(spark, sf_dir), BY_IMPRESSION, ["utchour"])
    return facts.select("impression_id", F.expr(local_hour("utchour", OFFSET)).alias("hour"))


@_query
def session_event_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = [f"saw_{event}" for event in EVENT_TYPES]
    return session_facts(_events(spark, sf_dir), BY_IMPRESSION, flags, impressions_only=False)


@_query
def session_measurability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_columns(_facts(spark, sf_dir, "measurability"), "measurability", "impression_id")


@_query
def session_viewability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_columns(_facts(spark, sf_dir, "viewability"), "viewability", "impression_id")


@_query
def session_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_columns(_facts(spark, sf_dir, "quartiles"), "quartiles", "impression_id")


@_query
def session_playback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_columns(_facts(spark, sf_dir, "playback"), "playback", "impression_id")


@_query
def session_traffic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_columns(_facts(spark, sf_dir, "traffic"), "traffic", "impression_id")


@_query
def session_fraud_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = rule_columns(_facts(spark, sf_dir, "fraud"), "fraud", "fraud_category")
    return flags.groupBy("fraud_category").agg(
        *[F.expr(f"{flag_count(c)} AS {c}") for c in FRAUD_CATEGORIES.values()]
    )


@_query
def jas_sessions_by_impression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_sessions(_events(spark, sf_dir), BY_IMPRESSION, DATE, OFFSET)


@_query
def jas_sessions_by_impression_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_sessions(_events(spark, sf_dir, BY_IMPRESSION_TIME), BY_IMPRESSION_TIME, DATE, OFFSET)


# ---- mart -------------------------------------------------------------------------------


@_query
def jas_mart_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_mart(jas_sessions_by_impression(spark, sf_dir))


@_query
def jas_mart_site_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_mart(jas_sessions_by_impression(spark, sf_dir), ("site",))


# ---- campaign mappings --------------------------------------------------------------------


@_query
def campaign_mapping_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.extract_pairs(_events(spark, sf_dir))


@_query
def campaign_mapping_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.classify_pairs(
        campaign_mapping_extract(spark, sf_dir),
        fx.entities(spark, sf_dir),
        fx.campaigns(spark, sf_dir),
        fx.CAMPAIGN_SOURCE,
    )


@_query
def campaign_mapping_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.apply_pairs(
        fx.campaigns(spark, sf_dir), campaign_mapping_classify(spark, sf_dir), fx.CAMPAIGN_SOURCE
    )


@_query
def campaign_mapping_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cm.mapping_exceptions(campaign_mapping_classify(spark, sf_dir))


# ---- name mappings and files --------------------------------------------------------------


@_query
def name_mapping_latest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.select_latest_files(fx.name_listing(spark, sf_dir), fx.name_feed_state(spark, sf_dir))


@_query
def name_mapping_equal_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of equal etags are one: read under the last key, applied at the place of the first."""
    return fl.select_latest_files(fx.name_listing_with_copies(spark, sf_dir), fx.name_feed_state(spark, sf_dir))


@_query
def name_mapping_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.split_part("stateKey", F.lit("."), F.lit(3)).cast("int")
    selected = name_mapping_latest_files(spark, sf_dir).withColumn("source", source)
    return nm.incoming_names(fx.name_rows(spark, sf_dir).drop("source"), selected, "source")


@_query
def name_mapping_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = name_mapping_incoming(spark, sf_dir)
    return nm.merge_names(fx.name_target(spark, sf_dir), incoming, F.col("source"), MERGED_AT).select(
        "MEASUREMENT_SOURCE_ID",
        "ID",
        "NAME",
        "CREATED_BY",
        F.date_format("CREATED_ON", "yyyy-MM-dd").alias("CREATED_ON"),
        "MODIFIED_BY",
        F.date_format("LAST_MODIFIED", "yyyy-MM-dd").alias("LAST_MODIFIED"),
    )


@_query
def file_state_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.feed_state_files(fl.decode_feed_state(fx.name_feed_state(spark, sf_dir)))


@_query
def file_state_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.advance_feed_state(name_mapping_latest_files(spark, sf_dir), fx.name_feed_state(spark, sf_dir))


@_query
def file_state_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.encode_feed_state(file_state_advance(spark, sf_dir))


@_query
def new_file_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fx.count_files(spark, sf_dir).select("key", "etag")
    return fl.detect_new_files(files, fx.count_file_state(spark, sf_dir), fx.FILES_TYPE).select("key", "etag")


@_query
def load_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = new_file_detect(spark, sf_dir)
    days = fx.local_hours(spark, sf_dir).select("estdate").distinct()
    return fl.load_manifest(files, CLIENT_ID, F.concat(F.lit("s3://inbound-files/"), "key")).unionByName(
        fl.load_manifest(
            days, CLIENT_ID, F.concat(F.lit("s3://mart/snapchat/date="), "estdate", F.lit("/"))
        )
    )


# ---- partitions -------------------------------------------------------------------------


@_query
def partition_register_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = fx.local_hours(spark, sf_dir)
    return pt.partitions_to_register(existing.select("estdate").distinct(), existing, "s3://sessions/snapchat/", True)


@_query
def partition_retention_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = fx.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    return pt.expired_partitions(dates, F.lit(RETENTION_AS_OF).cast("date"), RETENTION_DAYS)


# ---- sinks and runs: written to the shared folder and read back ---------------------------


@_query
def jas_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "sessions")
    write_sessions(jas_sessions_by_impression(spark, sf_dir), root, DATE)
    return read_sessions(spark, root, DATE)


@_query
def mart_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "mart")
    write_mart(jas_mart_daily(spark, sf_dir), root, DATE)
    return read_mart(spark, root, DATE)


@_query
def campaign_mapping_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "campaigns")
    write_pairs(campaign_mapping_extract(spark, sf_dir), root, DATE)
    return read_pairs(spark, root, DATE)


@_query
def viewability_day_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "viewability")
    raw = fx.raw_events(spark, sf_dir)
    raw.hint("rebalance", "utcdate", "utchour").write.partitionBy("utcdate", "utchour").parquet(f"{root}/raw/snapchat")
    warehouse = Warehouse(session_root=f"{root}/sessions", mart_root=f"{root}/mart", raw_root=f"{root}/raw")
    run_day(spark, BY_IMPRESSION, warehouse, DATE)
    return read_mart(spark, f"{root}/mart/snapchat", DATE).select(*MART_KEYS, *MART_MEASURES.names)


@_query
def name_mapping_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over CSV files of customers: an older date, then a nested folder of the newest date that grows."""
    root = shared_dir(spark, "names")
    customers = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    broken = customers.withColumn("name", F.concat("name", F.lit('\n"'), F.col("id").cast("string"), F.lit('"')))
    feed = f"{root}/in/advertiser_generic_feed"

    def write(rows: DataFrame, folder: str) -> None:
        rows.write.option("header", True).option("escape", '"').csv(f"{feed}/{folder}")

    def run(day: int) -> bool:
        return update_names(
            spark, table="PARTNER_MEASURED_ADVERTISER", source_id=10, files_dir=f"{root}/in", name_prefix="advertiser_generic_",
            names_root=f"{root}/names", state_path=f"{root}/state", now=datetime(2024, 1, day), pattern=r".*_(\d{8})[/.].*",
        )

    write(customers.where("id % 3 = 0"), "a_20240101.csv")
    write(broken, "deep/b_20240102.csv")
    first = run(15)
    write(customers.where("id % 5 = 0"), "deep/c_20240102.csv")
    second, third = run(16), run(17)
    names = read_snapshot(spark, f"{root}/names").select("ID", "NAME", "CREATED_ON", "LAST_MODIFIED")
    return names.withColumn("runs", F.lit(f"{first} {second} {third}"))


@_query
def mart_site_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "mart-site")
    write_mart(jas_mart_site_daily(spark, sf_dir), root, DATE)
    return read_mart(spark, root, DATE, ("site",))


@_query
def jas_sessions_shipped_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both partners' profiles as they are, without an order column of the test data."""

    def sessions(profile: PartnerProfile, timestamp: str) -> DataFrame:
        events = day_events(fx.raw_events(spark, sf_dir, timestamp).drop("event_seq"), profile, DATE, OFFSET)
        return ad_sessions(events, profile, DATE, OFFSET).select(F.lit(profile.name).alias("partner"), "*")

    return sessions(SNAPCHAT, "s1").unionByName(sessions(PINTEREST, "s0"))


@_query
def jas_sessions_hot_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of which one has a third of all events, so that both routes have rows."""
    events = day_events(fx.one_large_session(fx.raw_events(spark, sf_dir)), BY_IMPRESSION, DATE, OFFSET)
    return ad_sessions(events, BY_IMPRESSION, DATE, OFFSET, hot_session_events=HOT_IN_TESTS)


@_query
def campaign_mapping_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's pairs extracted, applied to the committed table, and reported: the new version and the delivered report."""
    root = shared_dir(spark, "campaign-run")
    profile = replace(BY_IMPRESSION, measurement_source_id=fx.CAMPAIGN_SOURCE)
    write_snapshot(fx.campaigns(spark, sf_dir), f"{root}/campaigns", 1)
    extract_campaigns(fx.raw_events(spark, sf_dir), profile, DATE, f"{root}/pairs", OFFSET)
    update_campaigns(
        spark, profile, DATE, pairs_root=f"{root}/pairs", entities=fx.entities(spark, sf_dir),
        campaigns_root=f"{root}/campaigns", exceptions_path=f"{root}/exceptions",
    )
    table = read_snapshot(spark, f"{root}/campaigns").select(
        F.lit("TABLE").alias("kind"), F.col("ID").alias("id"), F.col("CAMPAIGN_ID").alias("campaign"), F.col("NAME").alias("text")
    )
    schema = "kind string, partner_measured_campaign_id bigint, existing bigint, new bigint, ias_adv_entity_id bigint, report_line string"
    report = spark.read.schema(schema).json(f"{root}/exceptions").select(
        "kind", F.coalesce("partner_measured_campaign_id", "ias_adv_entity_id").alias("id"), F.col("new").alias("campaign"), F.col("report_line").alias("text")
    )
    return table.unionByName(report)


@_query
def new_file_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over files of orders per year: most years, then the rest and changes to even years, then nothing new."""
    root = shared_dir(spark, "new-files")
    years = [(r["year"], r["orders"]) for r in fx.yearly_counts(spark, sf_dir).collect()]
    jvm = spark.sparkContext._jvm
    inbound = jvm.org.apache.hadoop.fs.Path(f"{root}/in")
    files = inbound.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def put(year: int, text: str) -> None:
        stream = files.create(jvm.org.apache.hadoop.fs.Path(inbound, f"discrepency_counts_{year}.csv"), True)
        stream.write(text.encode())
        stream.close()

    def run(n: int) -> DataFrame | None:
        path = f"{root}/notices/{n}"
        found = notify_new_files(
            spark, files_dir=f"{root}/in", name_prefix="discrepency_counts_", files_type=fx.FILES_TYPE, state_path=f"{root}/state", client_id=CLIENT_ID, notices_path=path
        )
        if not found:
            return None
        return spark.read.schema("client_id string, data_url string").json(path).select(
            "client_id", F.regexp_extract("data_url", "[^/]*$", 0).alias("file"), F.lit(n).alias("run")
        )

    for year, orders in years:
        if year % 3 != 0:
            put(year, f"{year},{orders}\n")
    first = run(1)
    for year, orders in years:
        if year % 3 == 0 or year % 2 == 0:
            put(year, f"{year},{orders},seen again\n")
    return reduce(DataFrame.unionByName, [made for made in (first, run(2), run(3)) if made is not None])


def _stored_events(spark: SparkSession, raw: DataFrame, path: str) -> None:
    raw.hint("rebalance", "utcdate", "utchour").write.partitionBy("utcdate", "utchour").parquet(path)


@_query
def catalog_day_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day run between catalog tables, twice: the stored mart, and one made of the stored sessions, both read by the catalog."""
    root = shared_dir(spark, "catalog")
    names = {kind: f"{kind}_{uuid.uuid4().hex}" for kind in ("raw", "sessions", "mart")}
    for kind, database in names.items():
        spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/{kind}'")
    raw = fx.raw_events(spark, sf_dir).drop("event_seq")
    _stored_events(spark, raw, f"{root}/raw/snapchat")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in raw.schema.fields)
    spark.sql(f"CREATE TABLE {names['raw']}.snapchat ({columns}) USING parquet PARTITIONED BY (utcdate, utchour) LOCATION '{root}/raw/snapchat'")
    spark.sql(f"ALTER TABLE {names['raw']}.snapchat RECOVER PARTITIONS")
    data = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SESSION_DATA.fields)
    spark.sql(
        f"CREATE TABLE {names['sessions']}.snapchat ({data}, estdate STRING, esthour STRING) USING parquet"
        f" PARTITIONED BY (estdate, esthour) LOCATION '{root}/sessions/snapchat'"
    )
    data = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MART.fields)
    spark.sql(
        f"CREATE TABLE {names['mart']}.snapchat ({data}, estdate STRING) USING csv OPTIONS (sep '\t', nullValue '\\\\N')"
        f" PARTITIONED BY (estdate) LOCATION '{root}/mart/snapchat'"
    )
    warehouse = Warehouse(
        session_root=f"{root}/sessions", mart_root=f"{root}/mart", raw_database=names["raw"], session_database=names["sessions"], mart_database=names["mart"]
    )
    # The second run rewrites the day, and the catalog follows to the new version.
    for _ in range(2):
        run_day(spark, SNAPCHAT, warehouse, DATE)
    stored = spark.table(f"{names['mart']}.snapchat").where(F.col("estdate") == nodash(DATE)).drop("estdate")
    again = daily_mart(read_session_table(spark, f"{names['sessions']}.snapchat", DATE))
    return stored.withColumn("store", F.lit("mart")).unionByName(again.withColumn("store", F.lit("sessions")))


@_query
def viewability_partners_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two partners' days side by side, of which one lacks an hour: the other's mart, and what failed."""
    root = shared_dir(spark, "partners")
    raw = fx.raw_events(spark, sf_dir).drop("event_seq")
    _stored_events(spark, raw, f"{root}/raw/snapchat")
    _stored_events(spark, raw.where("NOT (utcdate = '20240115' AND utchour = '12')"), f"{root}/raw/pinterest")
    warehouse = Warehouse(session_root=f"{root}/sessions", mart_root=f"{root}/mart", raw_root=f"{root}/raw")
    try:
        run_days(spark, warehouse, DATE)
        failed = ""
    except PartnerRunsFailed as e:
        failed = "; ".join(map(str, e.exceptions))
    return read_mart(spark, f"{root}/mart/snapchat", DATE).withColumn("failed", F.lit(failed))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
