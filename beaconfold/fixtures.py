"""Ad-tracking inputs derived from the star-schema test tables.

Orders become impressions and line items become follow-up events; customers and parts become
the reference tables and name files. Rules and constants follow FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold.functions.expressions import literal
from beaconfold.operators.files import file_state_key, name_state_key
from beaconfold.schemas import EVENT_TYPES, FRAUD_CATEGORIES

TEST_DATE = "2024-01-15"
TEST_OFFSET = -18000

# Event type by l_partkey % 12.
FOLLOW_UPS = (
    "started",
    "first_quartile",
    "second_quartile",
    "third_quartile",
    "completed",
    "unload",
    "in_view",
    "in_view_50",
    "in_view_5s",
    "in_view_15s",
    "full_in_view",
    "full_in_view_2s",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: str, values: list[str]) -> str:
    """``values[index]``, NULL beyond the end."""
    return f"get(array({', '.join(map(literal, values))}), CAST({index} AS INT))"


def raw_events(spark: SparkSession, sf_dir: str, timestamp: str = "s1") -> DataFrame:
    """Raw events; ``timestamp`` is ``s0`` (session time) or ``s1`` (event time)."""
    impressions = (
        table(spark, sf_dir, "orders")
        .where("o_orderkey % 11 <> 0")
        # Every seventh impression is delivered twice.
        .selectExpr(
            "o_orderkey AS k",
            "o_custkey AS c",
            "explode(CASE WHEN o_orderkey % 7 = 0 THEN array(1, 2) ELSE array(1) END) AS copy",
        )
        .selectExpr(
            "k",
            "c",
            "0L AS event_seq",
            "0 AS ln",
            f"{literal(EVENT_TYPES['impression'])} AS type",
            "k % 5 < 3 AS inview50",
            "k % 5 = 0 AS inview100",
            "CAST(NULL AS BIGINT) AS noncontinuousplaytime",
            "CAST(NULL AS BIGINT) AS audibleplaytime",
        )
    )
    follow_ups = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS k",
        "CAST(NULL AS BIGINT) AS c",
        "l_linenumber * 1000000000L + l_partkey * 10000 + l_suppkey AS event_seq",
        "l_linenumber AS ln",
        f"{_pick('l_partkey % 12', [EVENT_TYPES[e] for e in FOLLOW_UPS])} AS type",
        "l_quantity > 25 AS inview50",
        "l_discount > 0.05D AS inview100",
        "CAST(round(l_quantity * 100) AS BIGINT) AS noncontinuousplaytime",
        "CAST(round(l_tax * 20000) AS BIGINT) AS audibleplaytime",
    )
    events = (
        impressions.unionByName(follow_ups)
        .selectExpr("*", "k * 1741 % 259200 AS s0")
        .selectExpr("*", "s0 + ln * 600 AS s1")
        .selectExpr("*", "s1 DIV 86400 AS day", "s1 % 86400 DIV 3600 AS hour")
    )
    entity = "CASE WHEN c % 6 = 0 THEN 0 ELSE c % 100 + 1 + CASE WHEN c % 20 = 7 AND k % 2 = 0 THEN 1 ELSE 0 END END"
    return events.selectExpr(
        "CAST(k AS STRING) AS impressionid",
        "type",
        f"{timestamp} AS timestamp",
        "event_seq",
        f"{_pick('day', ['20240114', '20240115', '20240116', '20240117'])} AS utcdate",
        f"{_pick('hour', [f'{h:02d}' for h in range(24)])} AS utchour",
        "concat('site-', k % 20) AS site",
        "CAST(k % 3 AS INT) AS sourceid",
        "c % 25 AS advertiserid",
        "c % 100 AS campaignid",
        "c % 10 AS placementid",
        "k % 4 AS creativeid",
        "CAST(k % 2 AS INT) AS mediatypeid",
        "CASE WHEN k % 3 = 0 THEN 'display' ELSE 'video' END AS endpoint",
        "CAST(k % 4 AS INT) AS measurable",
        "inview50",
        "inview100",
        "noncontinuousplaytime",
        "audibleplaytime",
        "CASE WHEN k % 17 <> 0 THEN k % 13 = 0 END AS fullscreen",
        "k % 9 = 0 AS suspicious",
        "k % 19 = 0 AS givt",
        f"CASE WHEN k % 9 = 0 THEN {_pick('k % 8', list(FRAUD_CATEGORIES))} END AS fraudcategory",
        f"CAST({entity} AS BIGINT) AS iasadventityid",
    )


def one_large_session(raw: DataFrame) -> DataFrame:
    """The events with a third of all orders in one session, which is then ordered by event and order."""
    k = F.col("impressionid").cast("bigint")
    return raw.withColumns(
        {
            "impressionid": F.when(k % 3 == 0, "0").otherwise(F.col("impressionid")),
            "event_seq": F.col("event_seq") * 10_000_000 + k,
        }
    )


# ---- reference tables -------------------------------------------------------------------

CAMPAIGN_SOURCE = 10


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity -> internal campaign; every id ending in 3 is unknown."""
    customer = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 3")
    return customer.select(F.col("c_custkey").alias("ID"), F.col("c_nationkey").cast("bigint").alias("CAMPAIGN_ID"))


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign table: NULL, different and equal mappings; campaigns 80 to 99 are not on record yet."""
    nation = F.col("c_nationkey")
    mapped = F.when(F.col("p_partkey") % 4 == 1, nation + 1).when(F.col("p_partkey") % 4 != 0, nation)
    return (
        table(spark, sf_dir, "part")
        .where(~F.col("p_partkey").between(80, 99))
        .join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("p_partkey") + 1)
        .select(
            F.lit(CAMPAIGN_SOURCE).alias("MEASUREMENT_SOURCE_ID"),
            F.col("p_partkey").alias("ID"),
            F.col("p_name").alias("NAME"),
            mapped.cast("bigint").alias("CAMPAIGN_ID"),
        )
    )


# ---- name files -------------------------------------------------------------------------

NAME_TABLE = "PARTNER_MEASURED_ADVERTISER"


def _source_of(identifier: str):
    """Measurement source of an id: a hundred ids each."""
    return (F.floor(F.col(identifier) / 100) + 10).cast("int")


def name_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every source's three name files: (source, key, row_no, id, name)."""
    c = F.col("c_custkey")
    files = F.array(
        F.when(c % 2 == 0, F.struct(F.lit("20240101").alias("part"), F.lit("").alias("mark"))),
        F.when(c % 3 == 0, F.struct(F.lit("20240102_p1").alias("part"), F.lit("-b").alias("mark"))),
        # Some rows of this file are repeated.
        F.when(c % 15 == 0, F.struct(F.lit("20240102_p1").alias("part"), F.lit("-b").alias("mark"))),
        F.when(c % 5 == 0, F.struct(F.lit("20240102_p2").alias("part"), F.lit("-c").alias("mark"))),
    )
    rows = table(spark, sf_dir, "customer").select(
        _source_of("c_custkey").alias("source"), "c_custkey", "c_name", F.inline(F.array_compact(files))
    )
    folder = F.concat(F.lit("inbound/source-"), F.col("source").cast("string"))
    return rows.select(
        "source",
        F.concat(folder, F.lit("/advertiser_generic_"), "part", F.lit(".csv")).alias("key"),
        F.col("c_custkey").alias("row_no"),
        F.col("c_custkey").alias("id"),
        F.concat("c_name", "mark").alias("name"),
    )


def name_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name files as a listing: (stateKey, source, key, etag)."""
    files = name_rows(spark, sf_dir).select("source", "key").distinct()
    return files.select(
        name_state_key(NAME_TABLE, F.col("source")).alias("stateKey"), "source", "key", F.md5("key").alias("etag")
    )


def name_listing_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing, and in a folder of each source copies of its newest files under the same etags."""
    listing = name_listing(spark, sf_dir)
    copies = listing.where(F.contains("key", F.lit("20240102"))).withColumn("key", F.replace(F.col("key"), F.lit("/advertiser"), F.lit("/copy/advertiser")))
    return listing.unionByName(copies)


def name_feed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of each source's feed, one of five cases by source."""
    source = F.col("source")
    sources = table(spark, sf_dir, "customer").select(_source_of("c_custkey").alias("source")).distinct()

    def path(part: str):
        return F.concat(
            F.lit("inbound/source-"), source.cast("string"), F.lit(f"/advertiser_generic_{part}.csv")
        )

    def entry(part: str):
        return F.struct(F.lit(f"advertiser_generic_{part}.csv").alias("filename"), F.md5(path(part)).alias("etag"))

    def as_json(stamp: str, *parts: str):
        return F.to_json(
            F.struct(F.lit(stamp).alias("timestamp"), F.array(*[entry(p) for p in parts]).alias("partitions"))
        )

    value = (
        F.when(source % 5 == 1, F.concat(F.lit("20240102|"), F.md5(path("20240102_p1"))))
        .when(source % 5 == 2, as_json("20240102", "20240102_p1", "20240102_p2"))
        .when(source % 5 == 3, as_json("20240103", "20240103"))
        .when(source % 5 == 4, F.concat(F.lit("20240101|"), F.md5(path("20240101"))))
    )
    return sources.where(source % 5 != 0).select(name_state_key(NAME_TABLE, source).alias("stateKey"), value.alias("value"))


def name_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name table to merge into."""
    return table(spark, sf_dir, "supplier").select(
        _source_of("s_suppkey").alias("MEASUREMENT_SOURCE_ID"),
        F.col("s_suppkey").alias("ID"),
        F.col("s_name").alias("NAME"),
        F.lit(1).alias("CREATED_BY"),
        F.lit("2023-01-01").cast("timestamp").alias("CREATED_ON"),
        F.lit(None).cast("int").alias("MODIFIED_BY"),
        F.lit(None).cast("timestamp").alias("LAST_MODIFIED"),
    )


# ---- files remembered one by one ----------------------------------------------------------

FILES_TYPE = "discrepancies.snapchat"


def count_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One count file per order date; its etag follows the orders of that date."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(day.alias("day"))
        .agg(F.concat_ws("-", F.count("*"), F.sum("o_custkey")).alias("content"))
        .select(
            F.concat(F.lit("inbound/discrepency_counts_"), "day", F.lit(".csv")).alias("key"),
            F.md5("content").alias("etag"),
            "day",
        )
    )


def count_file_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the days is processed, a third was processed with other content."""
    day = F.col("day").cast("int")
    return (
        count_files(spark, sf_dir)
        .where(day % 3 < 2)
        .select(
            file_state_key(FILES_TYPE, F.col("key")).alias("stateKey"),
            F.when(day % 3 == 0, F.col("etag")).otherwise(F.md5("key")).alias("value"),
        )
    )


def yearly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per year: (year, orders)."""
    return table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("orders"))


# ---- hours ------------------------------------------------------------------------------


def source_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTC hours with raw events."""
    return raw_events(spark, sf_dir).select("utcdate", "utchour").distinct()


def local_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local dates and hours with raw events: (estdate, esthour)."""
    utc = F.to_timestamp_ntz(F.concat("utcdate", "utchour"), F.lit("yyyyMMddHH"))
    return (
        source_hours(spark, sf_dir)
        .select((utc + F.make_dt_interval(secs=F.lit(TEST_OFFSET))).alias("local"))
        .select(F.date_format("local", "yyyyMMdd").alias("estdate"), F.date_format("local", "HH").alias("esthour"))
    )
