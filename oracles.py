"""DuckDB SQL that says what each query must return. Written from the rules, not from the Spark code."""

from __future__ import annotations

TYPE = """CASE l_partkey % 12
  WHEN 0 THEN 'started'
  WHEN 1 THEN 'first-quartile'
  WHEN 2 THEN 'second-quartile'
  WHEN 3 THEN 'thrid-quartile'
  WHEN 4 THEN 'completed'
  WHEN 5 THEN 'unload'
  WHEN 6 THEN 'in-view'
  WHEN 7 THEN 'in-view-50'
  WHEN 8 THEN 'in-view-5s'
  WHEN 9 THEN 'in-view-15s'
  WHEN 10 THEN '100-percent-in-view'
  ELSE '100-percent-in-view-2-seconds' END"""

RAW = f"""
imp AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(0 AS BIGINT) AS event_seq, CAST(0 AS INT) AS ln
        FROM orders WHERE o_orderkey % 11 <> 0),
imp2 AS (SELECT * FROM imp UNION ALL SELECT k, c, event_seq, ln FROM imp WHERE k % 7 = 0),
ev AS (
 SELECT k, c, event_seq, ln, 'impression' AS type, (k % 5 < 3) AS iv50, (k % 5 = 0) AS iv100,
   CAST(NULL AS BIGINT) AS ncp, CAST(NULL AS BIGINT) AS ap FROM imp2
 UNION ALL
 SELECT l_orderkey, CAST(NULL AS BIGINT), CAST(l_linenumber AS BIGINT)*1000000000 + l_partkey*10000 + l_suppkey,
   l_linenumber, {TYPE}, (l_quantity > 25), (l_discount > 0.05),
   CAST(ROUND(l_quantity*100) AS BIGINT), CAST(ROUND(l_tax*20000) AS BIGINT) FROM lineitem),
t AS (SELECT *, (k*1741) % 259200 AS s0, (k*1741) % 259200 + ln*600 AS s1 FROM ev),
raw AS (SELECT CAST(k AS VARCHAR) AS impressionid, type, s0, s1, event_seq,
 CASE CAST(FLOOR(s1/86400) AS INT) WHEN 0 THEN '20240114' WHEN 1 THEN '20240115' WHEN 2 THEN '20240116'
   ELSE '20240117' END AS utcdate,
 LPAD(CAST(CAST(FLOOR((s1 % 86400)/3600) AS INT) AS VARCHAR), 2, '0') AS utchour,
 CONCAT('site-', CAST(k % 20 AS VARCHAR)) AS site, CAST(k % 3 AS INT) AS sourceid, c % 25 AS advertiserid,
 c % 100 AS campaignid, c % 10 AS placementid, k % 4 AS creativeid, CAST(k % 2 AS INT) AS mediatypeid,
 CASE WHEN k % 3 = 0 THEN 'display' ELSE 'video' END AS endpoint, CAST(k % 4 AS INT) AS measurable,
 iv50 AS inview50, iv100 AS inview100, ncp AS noncontinuousplaytime, ap AS audibleplaytime,
 CASE WHEN k % 17 = 0 THEN NULL ELSE k % 13 = 0 END AS fullscreen, (k % 9 = 0) AS suspicious, (k % 19 = 0) AS givt,
 CASE WHEN k % 9 <> 0 THEN NULL ELSE CASE k % 8 WHEN 0 THEN 'Sitting Duck' WHEN 1 THEN 'Standard'
   WHEN 2 THEN 'Volunteer' WHEN 3 THEN 'Profile' WHEN 4 THEN 'Masked' WHEN 5 THEN 'Nomadic' WHEN 6 THEN 'Other'
   ELSE NULL END END AS fraudcategory,
 CAST(CASE WHEN c % 6 = 0 THEN 0
   ELSE c % 100 + 1 + CASE WHEN c % 20 = 7 AND k % 2 = 0 THEN 1 ELSE 0 END END AS BIGINT) AS iasadventityid
FROM t)"""


def day(ts: str) -> str:
    return f"""{RAW},
e AS (SELECT impressionid AS impression_id, type, {ts} AS "timestamp", event_seq, utcdate, utchour, site,
  sourceid AS measurement_source_id, advertiserid AS partner_measured_advertiser_id,
  campaignid AS partner_measured_campaign_id, placementid AS partner_measured_placement_id,
  creativeid AS partner_measured_creative_id, mediatypeid AS media_type_id, endpoint, measurable,
  inview50 AS in_view_50, inview100 AS in_view_100, noncontinuousplaytime AS non_continuous_play_time,
  audibleplaytime AS audible_play_time, fullscreen AS full_screen, suspicious, givt AS general_invalid,
  fraudcategory AS fraud_category, iasadventityid AS ias_adv_entity_id,
  CAST(NULL AS BIGINT) AS partner_measured_channel_id
 FROM raw
 WHERE (utcdate = '20240115' AND utchour BETWEEN '05' AND '23')
    OR (utcdate = '20240116' AND utchour BETWEEN '00' AND '04'))"""


def deduped(ts: str) -> str:
    return f"""{day(ts)},
d AS (SELECT * FROM e
  QUALIFY row_number() OVER (PARTITION BY impression_id, type, "timestamp" ORDER BY event_seq) = 1)"""


# Columns by which events of equal keys are told apart where a profile has no order of its own.
TIES = """audible_play_time, endpoint, fraud_category, full_screen, general_invalid, in_view_100, in_view_50, measurable,
  measurement_source_id, media_type_id, non_continuous_play_time, partner_measured_advertiser_id, partner_measured_campaign_id,
  partner_measured_creative_id, partner_measured_placement_id, site, suspicious, utchour"""


def deduped_as_shipped(ts: str, keys: str) -> str:
    ties = ", ".join(f"{c.strip()} NULLS FIRST" for c in TIES.split(","))
    return f"""{day(ts)},
one AS (SELECT * EXCLUDE (event_seq) FROM e
  QUALIFY row_number() OVER (PARTITION BY impression_id, type, "timestamp" ORDER BY {ties}) = 1),
d AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY "timestamp", type) AS event_seq FROM one)"""


def one_large_session(sql: str) -> str:
    """The same with a third of all orders in one session."""
    return sql.replace(
        "CAST(k AS VARCHAR) AS impressionid, type, s0, s1, event_seq,",
        "CASE WHEN k % 3 = 0 THEN '0' ELSE CAST(k AS VARCHAR) END AS impressionid, type, s0, s1, event_seq * 10000000 + k AS event_seq,",
    )


def prop(event: str, value: str) -> str:
    return f"arg_min({value}, event_seq) FILTER (WHERE type = '{event}' AND ({value}) IS NOT NULL)"


def has(event: str) -> str:
    return f"bool_or(type = '{event}')"


# name -> aggregate over a session's events
SESSION_PARTS = {
    "hr": "arg_min(utchour, event_seq)",
    "site": prop("impression", "site"),
    "measurement_source_id": prop("impression", "measurement_source_id"),
    "adv": prop("impression", "partner_measured_advertiser_id"),
    "camp": prop("impression", "partner_measured_campaign_id"),
    "plac": prop("impression", "partner_measured_placement_id"),
    "crea": prop("impression", "partner_measured_creative_id"),
    "media": prop("impression", "media_type_id"),
    "ep": prop("impression", "endpoint"),
    "s": prop("impression", "suspicious"),
    "gi": prop("impression", "general_invalid"),
    "fc": prop("impression", "fraud_category"),
    "fs": prop("impression", "full_screen"),
    "m": prop("impression", "measurable = 1 OR measurable = 3"),
    "g": prop("impression", "measurable = 2 OR measurable = 3"),
    "load50": """arg_min(in_view_50, event_seq) FILTER (WHERE in_view_50 IS NOT NULL AND
        ((endpoint = 'display' AND type = 'impression') OR (endpoint = 'video' AND type = 'started')))""",
    "unl50": prop("unload", "in_view_50"),
    "q1_50": prop("first-quartile", "in_view_50"),
    "q2_50": prop("second-quartile", "in_view_50"),
    "q3_50": prop("thrid-quartile", "in_view_50"),
    "q4_50": prop("completed", "in_view_50"),
    "load100": prop("started", "in_view_100"),
    "unl100": prop("unload", "in_view_100"),
    "q1_100": prop("first-quartile", "in_view_100"),
    "q2_100": prop("second-quartile", "in_view_100"),
    "q3_100": prop("thrid-quartile", "in_view_100"),
    "q4_100": prop("completed", "in_view_100"),
    "mute": "max(non_continuous_play_time) - max(audible_play_time) > 1000",
    "e_start": has("started"),
    "e_q1": has("first-quartile"),
    "e_q2": has("second-quartile"),
    "e_q3": has("thrid-quartile"),
    "e_q4": has("completed"),
    "e_iv": has("in-view"),
    "e_iv50": has("in-view-50"),
    "e_iv5": has("in-view-5s"),
    "e_iv15": has("in-view-15s"),
    "e_full": has("100-percent-in-view"),
    "e_full2": has("100-percent-in-view-2-seconds"),
}


def sessions(ts: str = "s1", keys: str = "impression_id", base: str | None = None) -> str:
    parts = ",\n  ".join(f"{sql} AS {name}" for name, sql in SESSION_PARTS.items())
    return f"""{base or deduped(ts)},
f AS (SELECT {keys}, {parts}
 FROM d GROUP BY {keys} HAVING bool_or(type = 'impression')),
s AS (SELECT *, (NOT s AND NOT gi) AS c,
  (m AND ((ep = 'display' AND e_iv) OR (ep = 'video' AND e_iv50))) AS mv, (g AND e_full) AS gv FROM f)"""


HOUR = "lpad(CAST((CAST(hr AS INT) + 19) % 24 AS VARCHAR), 2, '0')"

# column, type, rule; in the order of the session table
SESSION_COLUMNS = [
    tuple(part.strip() for part in line.split("|"))
    for line in f"""
date | VARCHAR | '20240115'
hour | VARCHAR | {HOUR}
impression_id | VARCHAR | impression_id
site | VARCHAR | site
measurement_source_id | INT | measurement_source_id
partner_measured_advertiser_id | BIGINT | adv
partner_measured_campaign_id | BIGINT | camp
partner_measured_channel_id | BIGINT | NULL
partner_measured_placement_id | BIGINT | plac
partner_measured_creative_id | BIGINT | crea
media_type_id | INT | media
below_the_fold | BOOLEAN | NULL
on_the_fold | BOOLEAN | NULL
above_the_fold | BOOLEAN | NULL
time_on_page | INT | NULL
in_view_time | INT | NULL
in_view | BOOLEAN | c AND mv
in_view_5s | BOOLEAN | c AND e_iv5
in_view_15s | BOOLEAN | c AND e_iv15
not_in_view | BOOLEAN | c AND ((ep = 'display' AND NOT e_iv) OR (ep = 'video' AND NOT e_iv50))
never_in_view | BOOLEAN | NULL
in_view_load | BOOLEAN | c AND m AND load50
in_view_unload | BOOLEAN | c AND m AND unl50
completed_1q | BOOLEAN | c AND e_q1
in_view_1q | BOOLEAN | c AND m AND q1_50
completed_2q | BOOLEAN | c AND e_q2
in_view_2q | BOOLEAN | c AND m AND q2_50
completed_3q | BOOLEAN | c AND e_q3
in_view_3q | BOOLEAN | c AND m AND q3_50
completed_4q | BOOLEAN | c AND e_q4
in_view_4q | BOOLEAN | c AND m AND q4_50
never_started | BOOLEAN | c AND NOT e_start
muted | BOOLEAN | c AND mute
full_screen | BOOLEAN | c AND fs
click_through | BOOLEAN | FALSE
sivt_in_view | BOOLEAN | NOT c AND mv
sivt_not_in_view | BOOLEAN | NOT c AND NOT mv
groupm_time_on_page | INT | NULL
groupm_in_view_time | INT | NULL
groupm_in_view | BOOLEAN | c AND gv
groupm_in_view_5s | BOOLEAN | FALSE
groupm_in_view_15s | BOOLEAN | FALSE
groupm_not_in_view | BOOLEAN | c AND NOT gv
groupm_never_in_view | BOOLEAN | FALSE
groupm_in_view_load | BOOLEAN | c AND g AND load100
groupm_in_view_unload | BOOLEAN | c AND g AND unl100
groupm_completed_1q | BOOLEAN | c AND e_q1
groupm_in_view_1q | BOOLEAN | c AND g AND q1_100
groupm_completed_2q | BOOLEAN | c AND e_q2
groupm_in_view_2q | BOOLEAN | c AND g AND q2_100
groupm_completed_3q | BOOLEAN | c AND e_q3
groupm_in_view_3q | BOOLEAN | c AND g AND q3_100
groupm_completed_4q | BOOLEAN | c AND e_q4
groupm_in_view_4q | BOOLEAN | c AND g AND q4_100
groupm_never_started | BOOLEAN | c AND NOT e_start
groupm_muted | BOOLEAN | c AND mute
groupm_full_screen | BOOLEAN | c AND fs
groupm_click_through | BOOLEAN | FALSE
groupm_sivt_in_view | BOOLEAN | NOT c AND gv
groupm_sivt_not_in_view | BOOLEAN | NOT c AND NOT gv
suspicious | BOOLEAN | s
measured | BOOLEAN | NULL
groupm_measured | BOOLEAN | NULL
general_invalid | BOOLEAN | gi
viewability_measurement_trusted | BOOLEAN | m
sitting_duck_bot | BOOLEAN | s AND fc = 'Sitting Duck'
standard_bot | BOOLEAN | s AND fc = 'Standard'
volunteer_bot | BOOLEAN | s AND fc = 'Volunteer'
profile_bot | BOOLEAN | s AND fc = 'Profile'
masked_bot | BOOLEAN | s AND fc = 'Masked'
nomadic_bot | BOOLEAN | s AND fc = 'Nomadic'
other_bot | BOOLEAN | s AND fc = 'Other'
true_view_viewable | BOOLEAN | NULL
true_view_measurable | BOOLEAN | NULL
yahoo_gemini_billable | BOOLEAN | NULL
full_ad_in_view | BOOLEAN | c AND g AND e_full2
publicis_in_view | BOOLEAN | c AND g AND e_full2
yahoo_gemini_billable_suspicious | BOOLEAN | NULL
average_in_view_time | DOUBLE | NULL
in_view_lt_1s | BOOLEAN | NULL
in_view_1s_2s | BOOLEAN | NULL
in_view_2s_5s | BOOLEAN | NULL
in_view_5s_10s | BOOLEAN | NULL
in_view_10s_15s | BOOLEAN | NULL
in_view_15s_20s | BOOLEAN | NULL
in_view_20s_25s | BOOLEAN | NULL
in_view_25s_30s | BOOLEAN | NULL
in_view_30s_35s | BOOLEAN | NULL
in_view_35s_40s | BOOLEAN | NULL
in_view_40s_45s | BOOLEAN | NULL
in_view_45s_50s | BOOLEAN | NULL
in_view_ge_50s | BOOLEAN | NULL
viewability_measured_or_fraud | BOOLEAN | m OR g OR NOT c
""".strip().splitlines()
]
_RULE = {name: rule for name, _, rule in SESSION_COLUMNS}


def session_select(ts: str = "s1", keys: str = "impression_id", base: str | None = None) -> str:
    columns = ", ".join(f"CAST({rule} AS {kind}) AS {name}" for name, kind, rule in SESSION_COLUMNS)
    return f"{sessions(ts, keys, base)}, jas AS (SELECT {columns} FROM s)"


def pick(*names: str) -> str:
    """Some session columns by impression."""
    columns = ", ".join(f"({_RULE[n]}) AS {n}" for n in names)
    return f"WITH {sessions()} SELECT impression_id, {columns} FROM s"


def mart(*extra: str, base: str | None = None) -> str:
    keys = """strptime("date", '%Y%m%d')::DATE AS hit_date, measurement_source_id, partner_measured_advertiser_id,
      partner_measured_campaign_id, partner_measured_channel_id, partner_measured_placement_id,
      partner_measured_creative_id, media_type_id"""
    measures = []
    for name, kind, _ in SESSION_COLUMNS[11:]:
        if kind == "BOOLEAN":
            out = f"{name}_ads" if name == "viewability_measured_or_fraud" else f"{name}_imps"
            measures.append(f"CAST(sum(CAST({name} AS INT)) AS BIGINT) AS {out}")
        else:
            measures.append(f"CAST(NULL AS {'DOUBLE' if kind == 'DOUBLE' else 'BIGINT'}) AS {name}")
    measures += ["count(*) AS imps", "CAST(NULL AS VARCHAR) AS pm_platform"]
    first = "".join(f"{e}, " for e in extra)
    return f"WITH {session_select(base=base)} SELECT {first}{keys}, {', '.join(measures)} FROM jas GROUP BY ALL"


PAIRS = """pairs AS (SELECT DISTINCT partner_measured_campaign_id, ias_adv_entity_id FROM e WHERE ias_adv_entity_id <> 0)"""

CAMPAIGNS = """adv_entity AS (SELECT c_custkey AS ID, CAST(c_nationkey AS BIGINT) AS CAMPAIGN_ID
  FROM customer WHERE c_custkey % 10 <> 3),
pmc AS (SELECT 10 AS MEASUREMENT_SOURCE_ID, p_partkey AS ID, p_name AS NAME,
    CAST(CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 4 = 1 THEN c_nationkey + 1 ELSE c_nationkey END
      AS BIGINT) AS CAMPAIGN_ID
  FROM part JOIN customer ON c_custkey = p_partkey + 1 WHERE p_partkey < 80 OR p_partkey > 99)"""

CLASSIFIED = f"""{day("s1")}, {PAIRS}, {CAMPAIGNS},
r AS (SELECT p.*, a.CAMPAIGN_ID AS "new", x.CAMPAIGN_ID AS existing, x.ID IS NOT NULL AS on_record,
    (SELECT count(DISTINCT a2.CAMPAIGN_ID) FROM pairs p2 JOIN adv_entity a2 ON a2.ID = p2.ias_adv_entity_id
      WHERE p2.partner_measured_campaign_id = p.partner_measured_campaign_id) AS targets
  FROM pairs p LEFT JOIN adv_entity a ON a.ID = p.ias_adv_entity_id
    LEFT JOIN pmc x ON x.ID = p.partner_measured_campaign_id),
cl AS (SELECT partner_measured_campaign_id, ias_adv_entity_id, existing, "new",
  CASE WHEN partner_measured_campaign_id IS NULL THEN 'MISSING_CAMPAIGN' WHEN "new" IS NULL THEN 'INVALID_ENTITY'
    WHEN existing IS NOT NULL AND existing <> "new" THEN 'OVERRIDE_REJECTED' WHEN existing = "new" THEN 'UNCHANGED'
    WHEN targets > 1 THEN 'AMBIGUOUS' WHEN on_record THEN 'UPDATE' ELSE 'INSERT' END AS class FROM r)"""

NAMES = """nr0 AS (
  SELECT c_custkey AS id, CAST(FLOOR(c_custkey/100) + 10 AS INT) AS source, c_name AS name, '20240101' AS part
    FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT c_custkey, CAST(FLOOR(c_custkey/100) + 10 AS INT), c_name || '-b', '20240102_p1'
    FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT c_custkey, CAST(FLOOR(c_custkey/100) + 10 AS INT), c_name || '-b', '20240102_p1'
    FROM customer WHERE c_custkey % 15 = 0
  UNION ALL SELECT c_custkey, CAST(FLOOR(c_custkey/100) + 10 AS INT), c_name || '-c', '20240102_p2'
    FROM customer WHERE c_custkey % 5 = 0),
nr AS (SELECT id, source, name, 'inbound/source-' || source || '/advertiser_generic_' || part || '.csv' AS key FROM nr0),
nl AS (SELECT DISTINCT 'name_mappings.PARTNER_MEASURED_ADVERTISER.' || source || '.latest_processed' AS stateKey,
    source, key, md5(key) AS etag FROM nr),
src AS (SELECT DISTINCT CAST(FLOOR(c_custkey/100) + 10 AS INT) AS source FROM customer),
remembered AS (
  SELECT source, '20240102' AS "timestamp", '' AS filename, '20240102_p1' AS part FROM src WHERE source % 5 = 1
  UNION ALL SELECT source, '20240102', 'advertiser_generic_20240102_p1.csv', '20240102_p1' FROM src WHERE source % 5 = 2
  UNION ALL SELECT source, '20240102', 'advertiser_generic_20240102_p2.csv', '20240102_p2' FROM src WHERE source % 5 = 2
  UNION ALL SELECT source, '20240103', 'advertiser_generic_20240103.csv', '20240103' FROM src WHERE source % 5 = 3
  UNION ALL SELECT source, '20240101', '', '20240101' FROM src WHERE source % 5 = 4),
st AS (SELECT 'name_mappings.PARTNER_MEASURED_ADVERTISER.' || source || '.latest_processed' AS stateKey, "timestamp",
    filename, md5('inbound/source-' || source || '/advertiser_generic_' || part || '.csv') AS etag FROM remembered),
dated AS (SELECT *, regexp_extract(key, '_(\\d{8})(.*).csv$', 1) AS "timestamp" FROM nl),
sel AS (SELECT stateKey, source, "timestamp", key, etag, key AS apply_key FROM dated
  WHERE "timestamp" = (SELECT max(x."timestamp") FROM dated x WHERE x.stateKey = dated.stateKey)
    AND "timestamp" >= COALESCE((SELECT max(y."timestamp") FROM st y WHERE y.stateKey = dated.stateKey), '0')
    AND NOT EXISTS (SELECT 1 FROM st z WHERE z.stateKey = dated.stateKey AND z."timestamp" = dated."timestamp"
      AND z.etag = dated.etag)),
inc AS (SELECT nr.source, nr.id, nr.name FROM nr JOIN sel USING (key)
  QUALIFY row_number() OVER (PARTITION BY nr.source, nr.id ORDER BY key DESC) = 1)"""

ADVANCED = """adv AS (SELECT stateKey, "timestamp", regexp_extract(key, '[^/]*$') AS filename, etag FROM sel
  UNION ALL SELECT stateKey, "timestamp", filename, etag FROM st
    WHERE EXISTS (SELECT 1 FROM sel WHERE sel.stateKey = st.stateKey AND sel."timestamp" = st."timestamp"))"""

FILES = """days AS (SELECT strftime(o_orderdate, '%Y%m%d') AS d, count(*) || '-' || CAST(sum(o_custkey) AS BIGINT) AS content
  FROM orders GROUP BY 1),
counted AS (SELECT 'inbound/discrepency_counts_' || d || '.csv' AS key, md5(content) AS etag, CAST(d AS INT) % 3 AS r
  FROM days),
newf AS (SELECT key, etag FROM counted WHERE r <> 0)"""

LOCAL = """lh AS (SELECT DISTINCT strftime(strptime(utcdate || utchour, '%Y%m%d%H') - INTERVAL 5 HOUR, '%Y%m%d') AS estdate,
  strftime(strptime(utcdate || utchour, '%Y%m%d%H') - INTERVAL 5 HOUR, '%H') AS esthour FROM raw)"""

VIEWABILITY = (
    "in_view",
    "not_in_view",
    "in_view_5s",
    "in_view_15s",
    "groupm_in_view",
    "groupm_not_in_view",
    "full_ad_in_view",
    "publicis_in_view",
)
QUARTILES = tuple(
    f"{standard}{name}"
    for standard in ("", "groupm_")
    for name in (
        *("in_view_load", "in_view_unload", "in_view_1q", "in_view_2q", "in_view_3q", "in_view_4q"),
        *("completed_1q", "completed_2q", "completed_3q", "completed_4q"),
    )
)
PLAYBACK = tuple(f"{standard}{n}" for standard in ("", "groupm_") for n in ("never_started", "muted", "full_screen"))
TRAFFIC = (
    "suspicious",
    "general_invalid",
    "sivt_in_view",
    "sivt_not_in_view",
    "groupm_sivt_in_view",
    "groupm_sivt_not_in_view",
    "viewability_measured_or_fraud",
)
BOTS = (
    "sitting_duck_bot",
    "standard_bot",
    "volunteer_bot",
    "profile_bot",
    "masked_bot",
    "nomadic_bot",
    "other_bot",
)
EVENT_FLAGS = {
    "saw_impression": "impression",
    "saw_started": "started",
    "saw_first_quartile": "first-quartile",
    "saw_second_quartile": "second-quartile",
    "saw_third_quartile": "thrid-quartile",
    "saw_completed": "completed",
    "saw_unload": "unload",
    "saw_in_view": "in-view",
    "saw_in_view_50": "in-view-50",
    "saw_in_view_5s": "in-view-5s",
    "saw_in_view_15s": "in-view-15s",
    "saw_full_in_view": "100-percent-in-view",
    "saw_full_in_view_2s": "100-percent-in-view-2-seconds",
}


def oracle_sql() -> dict[str, str]:
    flags = ", ".join(f"{has(event)} AS {name}" for name, event in EVENT_FLAGS.items())
    bots = ", ".join(f"CAST(sum(CAST(({_RULE[b]}) AS INT)) AS BIGINT) AS {b}" for b in BOTS)
    jas = f"WITH {session_select()} SELECT * FROM jas"
    pairs = f"WITH {day('s1')}, {PAIRS} SELECT * FROM pairs"
    shipped = {
        partner: f"WITH {session_select(ts, keys, deduped_as_shipped(ts, keys))} SELECT '{partner}' AS partner, * FROM jas"
        for partner, ts, keys in (("snapchat", "s1", "impression_id"), ("pinterest", "s0", 'impression_id, "timestamp"'))
    }
    as_shipped = deduped_as_shipped("s1", "impression_id")
    oracles = {
        "local_day_window": """WITH h AS (SELECT d AS data_date, CAST(d AS TIMESTAMP) + INTERVAL 5 HOUR + n * INTERVAL 1 HOUR AS u
            FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), generate_series(0, 23) g(n))
          SELECT data_date, strftime(u, '%Y%m%d') AS utcdate, min(strftime(u, '%H')) AS first_hour,
            max(strftime(u, '%H')) AS last_hour FROM h GROUP BY 1, 2""",
        "local_day_window_zone": """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, m.day_mode FROM orders,
              (VALUES ('fixed24'), ('calendar')) m(day_mode)),
            s AS (SELECT d, day_mode, timezone('UTC', timezone('America/New_York', CAST(d AS TIMESTAMP))) AS a,
              timezone('UTC', timezone('America/New_York', CAST(d + 1 AS TIMESTAMP))) AS b FROM d),
            h AS (SELECT d AS data_date, day_mode, a + n * INTERVAL 1 HOUR AS u FROM s, generate_series(0, 24) g(n)
              WHERE a + n * INTERVAL 1 HOUR < CASE day_mode WHEN 'calendar' THEN b ELSE a + INTERVAL 24 HOUR END)
          SELECT data_date, strftime(u, '%Y%m%d') AS utcdate, min(strftime(u, '%H')) AS first_hour,
            max(strftime(u, '%H')) AS last_hour, day_mode FROM h GROUP BY ALL""",
        "name_mapping_run": """SELECT c_custkey AS "ID",
            CASE WHEN c_custkey % 5 = 0 THEN c_name ELSE c_name || chr(10) || '"' || c_custkey || '"' END AS "NAME",
            TIMESTAMP '2024-01-15' AS "CREATED_ON",
            CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2024-01-16' END AS "LAST_MODIFIED", 'True True False' AS runs FROM customer""",
        "source_day_scan": f"WITH {day('s1')} SELECT * FROM e",
        "source_completeness": f"""WITH {RAW}, {LOCAL},
          w AS (SELECT CAST(strptime(estdate, '%Y%m%d') AS DATE) AS data_date,
              strptime(estdate, '%Y%m%d') + INTERVAL 5 HOUR + n * INTERVAL 1 HOUR AS u
            FROM (SELECT DISTINCT estdate FROM lh), generate_series(0, 23) g(n)),
          x AS (SELECT data_date, strftime(u, '%Y%m%d') AS utcdate, strftime(u, '%H') AS utchour FROM w)
          SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM raw WHERE raw.utcdate = x.utcdate AND raw.utchour = x.utchour
            AND NOT (raw.utcdate = '20240115' AND raw.utchour = '12'))""",
        "event_dedupe": f"WITH {deduped('s1')} SELECT * FROM d",
        "session_hour_bucket": f"WITH {sessions()} SELECT impression_id, {HOUR} AS hour FROM s",
        "session_event_set": f"WITH {deduped('s1')} SELECT impression_id, {flags} FROM d GROUP BY 1",
        "session_measurability": f"""WITH {sessions()}
          SELECT impression_id, m AS mrc_measurable, g AS groupm_measurable FROM s""",
        "session_viewability": pick(*VIEWABILITY),
        "session_quartiles": pick(*QUARTILES),
        "session_playback": pick(*PLAYBACK),
        "session_traffic_quality": pick(*TRAFFIC),
        "session_fraud_breakdown": f"WITH {sessions()} SELECT fc AS fraud_category, {bots} FROM s GROUP BY 1",
        "jas_sessions_by_impression": jas,
        "jas_sessions_by_impression_time": f"""WITH {session_select('s0', 'impression_id, "timestamp"')}
          SELECT * FROM jas""",
        "jas_mart_daily": mart(),
        "jas_mart_site_daily": mart("site"),
        "campaign_mapping_extract": pairs,
        "campaign_mapping_classify": f"WITH {CLASSIFIED} SELECT * FROM cl",
        "campaign_mapping_apply": f"""WITH {CLASSIFIED},
          w AS (SELECT DISTINCT partner_measured_campaign_id AS ID, "new" FROM cl WHERE class IN ('UPDATE', 'INSERT'))
          SELECT 10 AS MEASUREMENT_SOURCE_ID, COALESCE(pmc.ID, w.ID) AS ID,
            CASE WHEN pmc.ID IS NULL THEN 'DATA NOT RECEIVED' ELSE NAME END AS NAME,
            COALESCE(w."new", pmc.CAMPAIGN_ID) AS CAMPAIGN_ID FROM pmc FULL OUTER JOIN w ON w.ID = pmc.ID""",
        "campaign_mapping_exceptions": f"""WITH {CLASSIFIED},
          x AS (SELECT DISTINCT class AS kind, CAST(NULL AS BIGINT) AS partner_measured_campaign_id,
              CAST(NULL AS BIGINT) AS existing, CAST(NULL AS BIGINT) AS "new", ias_adv_entity_id
            FROM cl WHERE class IN ('INVALID_ENTITY', 'MISSING_CAMPAIGN')
            UNION ALL SELECT DISTINCT class, partner_measured_campaign_id, existing, "new", CAST(NULL AS BIGINT)
            FROM cl WHERE class = 'OVERRIDE_REJECTED'
            UNION ALL SELECT DISTINCT class, partner_measured_campaign_id, CAST(NULL AS BIGINT), "new", CAST(NULL AS BIGINT)
            FROM cl WHERE class = 'AMBIGUOUS')
          SELECT *, CASE WHEN kind IN ('OVERRIDE_REJECTED', 'AMBIGUOUS')
              THEN rpad(CAST(partner_measured_campaign_id AS VARCHAR), 19, ' ') || ' | ' ||
                rpad(COALESCE(CAST(existing AS VARCHAR), 'none'), 24, ' ') || ' | ' || rpad(CAST("new" AS VARCHAR), 19, ' ')
              ELSE CAST(ias_adv_entity_id AS VARCHAR) END AS report_line FROM x""",
        "name_mapping_latest_files": f'WITH {NAMES} SELECT stateKey, "timestamp", key, etag, apply_key FROM sel',
        "name_mapping_equal_files": f"""WITH {NAMES} SELECT stateKey, "timestamp",
            replace(key, '/advertiser', '/copy/advertiser') AS key, etag, key AS apply_key FROM sel""",
        "name_mapping_incoming": f"WITH {NAMES} SELECT * FROM inc",
        "name_mapping_merge": f"""WITH {NAMES},
          tgt AS (SELECT CAST(FLOOR(s_suppkey/100) + 10 AS INT) AS source, s_suppkey AS id, s_name AS name FROM supplier)
          SELECT COALESCE(tgt.source, inc.source) AS MEASUREMENT_SOURCE_ID, COALESCE(tgt.id, inc.id) AS ID,
            COALESCE(inc.name, tgt.name) AS NAME, CASE WHEN tgt.id IS NULL THEN -2 ELSE 1 END AS CREATED_BY,
            CASE WHEN tgt.id IS NULL THEN '2024-01-15' ELSE '2023-01-01' END AS CREATED_ON,
            CASE WHEN tgt.id IS NOT NULL AND inc.id IS NOT NULL THEN -2 END AS MODIFIED_BY,
            CASE WHEN tgt.id IS NOT NULL AND inc.id IS NOT NULL THEN '2024-01-15' END AS LAST_MODIFIED
          FROM tgt FULL OUTER JOIN inc ON inc.source = tgt.source AND inc.id = tgt.id""",
        "file_state_decode": f"WITH {NAMES} SELECT * FROM st",
        "file_state_advance": f"WITH {NAMES}, {ADVANCED} SELECT * FROM adv",
        "file_state_encode": f"""WITH {NAMES}, {ADVANCED}
          SELECT stateKey, '{{"timestamp":"' || "timestamp" || '","partitions":[' || string_agg(
            '{{"filename":"' || filename || '","etag":"' || etag || '"}}', ',' ORDER BY filename, etag) || ']}}' AS value
          FROM adv GROUP BY stateKey, "timestamp" """,
        "new_file_detect": f"WITH {FILES} SELECT * FROM newf",
        "load_manifest": f"""WITH {RAW}, {LOCAL}, {FILES}
          SELECT 'ad-sessions' AS client_id, 's3://inbound-files/' || key AS data_url FROM newf
          UNION ALL SELECT DISTINCT 'ad-sessions', 's3://mart/snapchat/date=' || estdate || '/' FROM lh""",
        "partition_register_plan": f"""WITH {RAW}, {LOCAL},
          want AS (SELECT estdate, lpad(CAST(n AS VARCHAR), 2, '0') AS esthour
            FROM (SELECT DISTINCT estdate FROM lh), generate_series(0, 23) g(n))
          SELECT estdate, esthour, 's3://sessions/snapchat/date=' || estdate || '/hour=' || esthour AS location
          FROM want WHERE NOT EXISTS (SELECT 1 FROM lh WHERE lh.estdate = want.estdate AND lh.esthour = want.esthour)""",
        "partition_retention_plan": """SELECT DISTINCT kind, keep_days, CAST(o_orderdate AS DATE) AS date
          FROM orders, (VALUES ('sessions', 90), ('mart', 365), ('intermediate', 14)) k(kind, keep_days)
          WHERE CAST(o_orderdate AS DATE) < DATE '2001-01-01' - keep_days""",
        "jas_sink_roundtrip": jas,
        "mart_sink_roundtrip": mart(),
        "campaign_mapping_roundtrip": pairs,
        "viewability_day_run": mart(),
        "mart_site_sink_roundtrip": mart("site"),
        "jas_sessions_shipped_profile": f"SELECT * FROM ({shipped['snapchat']}) UNION ALL SELECT * FROM ({shipped['pinterest']})",
        "jas_sessions_hot_route": one_large_session(jas),
        "catalog_day_run": f"SELECT * FROM ({mart(base=as_shipped)}), (VALUES ('mart'), ('sessions')) s(store)",
        "viewability_partners_run": f"""SELECT *, 'pinterest: no source data for 20240115 12' AS failed FROM ({mart(base=as_shipped)})""",
        "new_file_run": """WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders),
            r AS (SELECT y, unnest(CASE WHEN y % 3 = 0 THEN [2] WHEN y % 2 = 0 THEN [1, 2] ELSE [1] END) AS run FROM y)
          SELECT 'ad-sessions' AS client_id, 'discrepency_counts_' || y || '.csv' AS file, run FROM r""",
    }
    return oracles | {
        "campaign_mapping_run": f"""SELECT 'TABLE' AS kind, "ID" AS id, "CAMPAIGN_ID" AS campaign, "NAME" AS text FROM ({oracles["campaign_mapping_apply"]})
          UNION ALL SELECT kind, COALESCE(partner_measured_campaign_id, ias_adv_entity_id), "new", report_line
          FROM ({oracles["campaign_mapping_exceptions"]})""",
    }
