"""Table layouts and wire literals.

Everything under a "Fixed values" comment is part of a data contract shared with
upstream producers or downstream readers, so it is spelled out as it travels.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw event columns as delivered by partners.
RAW_EVENT_DDL = """
impressionid string, type string, timestamp bigint, site string,
sourceid int, advertiserid bigint, campaignid bigint, placementid bigint, creativeid bigint, mediatypeid int,
endpoint string, measurable int, inview50 boolean, inview100 boolean,
noncontinuousplaytime bigint, audibleplaytime bigint, fullscreen boolean,
suspicious boolean, givt boolean, fraudcategory string, iasadventityid bigint,
utcdate string, utchour string
"""

# Wire name -> canonical name.
WIRE_NAMES = {
    "impressionid": "impression_id",
    "sourceid": "measurement_source_id",
    "advertiserid": "partner_measured_advertiser_id",
    "campaignid": "partner_measured_campaign_id",
    "placementid": "partner_measured_placement_id",
    "creativeid": "partner_measured_creative_id",
    "mediatypeid": "media_type_id",
    "inview50": "in_view_50",
    "inview100": "in_view_100",
    "noncontinuousplaytime": "non_continuous_play_time",
    "audibleplaytime": "audible_play_time",
    "fullscreen": "full_screen",
    "fraudcategory": "fraud_category",
    "givt": "general_invalid",
    "iasadventityid": "ias_adv_entity_id",
}

# Event types, by the name used for them here ("thrid" is how the wire spells it).
EVENT_TYPES = {
    "impression": "impression",
    "started": "started",
    "first_quartile": "first-quartile",
    "second_quartile": "second-quartile",
    "third_quartile": "thrid-quartile",
    "completed": "completed",
    "unload": "unload",
    "in_view": "in-view",
    "in_view_50": "in-view-50",
    "in_view_5s": "in-view-5s",
    "in_view_15s": "in-view-15s",
    "full_in_view": "100-percent-in-view",
    "full_in_view_2s": "100-percent-in-view-2-seconds",
}

# Fraud category -> session column.
FRAUD_CATEGORIES = {
    "Sitting Duck": "sitting_duck_bot",
    "Standard": "standard_bot",
    "Volunteer": "volunteer_bot",
    "Profile": "profile_bot",
    "Masked": "masked_bot",
    "Nomadic": "nomadic_bot",
    "Other": "other_bot",
}

# Session table, in column order. Partition columns `date`, `hour` come first in frames.
SESSION_DDL = """
impression_id string, site string, measurement_source_id int,
partner_measured_advertiser_id bigint, partner_measured_campaign_id bigint, partner_measured_channel_id bigint,
partner_measured_placement_id bigint, partner_measured_creative_id bigint, media_type_id int,
below_the_fold boolean, on_the_fold boolean, above_the_fold boolean, time_on_page int, in_view_time int,
in_view boolean, in_view_5s boolean, in_view_15s boolean, not_in_view boolean, never_in_view boolean,
in_view_load boolean, in_view_unload boolean,
completed_1q boolean, in_view_1q boolean, completed_2q boolean, in_view_2q boolean,
completed_3q boolean, in_view_3q boolean, completed_4q boolean, in_view_4q boolean,
never_started boolean, muted boolean, full_screen boolean, click_through boolean,
sivt_in_view boolean, sivt_not_in_view boolean,
groupm_time_on_page int, groupm_in_view_time int,
groupm_in_view boolean, groupm_in_view_5s boolean, groupm_in_view_15s boolean, groupm_not_in_view boolean,
groupm_never_in_view boolean, groupm_in_view_load boolean, groupm_in_view_unload boolean,
groupm_completed_1q boolean, groupm_in_view_1q boolean, groupm_completed_2q boolean, groupm_in_view_2q boolean,
groupm_completed_3q boolean, groupm_in_view_3q boolean, groupm_completed_4q boolean, groupm_in_view_4q boolean,
groupm_never_started boolean, groupm_muted boolean, groupm_full_screen boolean, groupm_click_through boolean,
groupm_sivt_in_view boolean, groupm_sivt_not_in_view boolean,
suspicious boolean, measured boolean, groupm_measured boolean, general_invalid boolean,
viewability_measurement_trusted boolean,
sitting_duck_bot boolean, standard_bot boolean, volunteer_bot boolean, profile_bot boolean,
masked_bot boolean, nomadic_bot boolean, other_bot boolean,
true_view_viewable boolean, true_view_measurable boolean, yahoo_gemini_billable boolean,
full_ad_in_view boolean, publicis_in_view boolean, yahoo_gemini_billable_suspicious boolean,
average_in_view_time double,
in_view_lt_1s boolean, in_view_1s_2s boolean, in_view_2s_5s boolean, in_view_5s_10s boolean,
in_view_10s_15s boolean, in_view_15s_20s boolean, in_view_20s_25s boolean, in_view_25s_30s boolean,
in_view_30s_35s boolean, in_view_35s_40s boolean, in_view_40s_45s boolean, in_view_45s_50s boolean,
in_view_ge_50s boolean, viewability_measured_or_fraud boolean
"""

# The dimension tuple of the daily mart.
MART_KEYS = (
    "hit_date",
    "measurement_source_id",
    "partner_measured_advertiser_id",
    "partner_measured_campaign_id",
    "partner_measured_channel_id",
    "partner_measured_placement_id",
    "partner_measured_creative_id",
    "media_type_id",
)

# Rows created or changed by this process carry this user id, and a campaign
# first met in event data carries this name until a name file brings the real one.
SYSTEM_USER_ID = -2
UNNAMED_CAMPAIGN = "DATA NOT RECEIVED"

# File date inside a dated inbound file name.
DATED_FILE_PATTERN = r"_(\d{8})(.*).csv$"

# How long catalog partitions and intermediate files are kept, in days.
RETENTION_DAYS = {"sessions": 90, "mart": 365, "intermediate": 14}

# The data day is a New York calendar day.
DATA_DATE_ZONE = "America/New_York"


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _struct(ddl: str) -> T.StructType:
    """Flat DDL text to a schema; unlike ``StructType.fromDDL`` it needs no running session."""
    columns = (column.split() for column in ddl.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


RAW_EVENTS = _struct(RAW_EVENT_DDL)
SESSION_DATA = _struct(SESSION_DDL)
SESSIONS = _struct("date string, hour string, " + SESSION_DDL)

CAMPAIGN_PAIRS = _struct("partner_measured_campaign_id bigint, ias_adv_entity_id bigint")
ENTITIES = _struct("ID bigint, CAMPAIGN_ID bigint")
NAME_TABLE = _struct(
    "MEASUREMENT_SOURCE_ID int, ID bigint, NAME string,"
    " CREATED_BY int, CREATED_ON timestamp, MODIFIED_BY int, LAST_MODIFIED timestamp"
)
CAMPAIGN_TABLE = _struct(
    "MEASUREMENT_SOURCE_ID int, ID bigint, NAME string, CAMPAIGN_ID bigint,"
    " CREATED_BY int, CREATED_ON timestamp, MODIFIED_BY int, LAST_MODIFIED timestamp"
)
FILE_LISTING = _struct("key string, etag string")
STATE = _struct("stateKey string, value string")
FILE_STATE_JSON = "timestamp string, partitions array<struct<filename: string, etag: string>>"


def mart_column(session_column: str) -> str:
    """Name of the mart measure that counts a boolean session column."""
    return f"{session_column}_ads" if session_column == "viewability_measured_or_fraud" else f"{session_column}_imps"


def _mart_measures() -> T.StructType:
    """Mart measures follow the session columns in order, with two columns of their own."""
    fields = []
    for f in SESSION_DATA.fields:
        if isinstance(f.dataType, T.BooleanType):
            fields.append(T.StructField(mart_column(f.name), T.LongType()))
        elif f.name.endswith(("time_on_page", "in_view_time")):
            fields.append(T.StructField(f.name, T.LongType() if f.dataType == T.IntegerType() else f.dataType))
        if f.name == "viewability_measurement_trusted":
            fields.append(T.StructField("imps", T.LongType()))
        if f.name == "full_ad_in_view":
            fields.append(T.StructField("pm_platform", T.StringType()))
    return T.StructType(fields)


MART_MEASURES = _mart_measures()
MART = T.StructType(
    [T.StructField("hit_date", T.DateType())]
    + [T.StructField(k, SESSION_DATA[k].dataType) for k in MART_KEYS[1:]]
    + MART_MEASURES.fields
)
