"""Folding events to wide ad sessions.

Two layers. *Session facts* are aggregates over the events of one session: which event
types it saw, and properties taken from the first event of a given type. *Rules* derive the
output columns from facts. Both are three-valued: an unknown fact stays NULL through the
rules, and is neither true nor false in the counts of the mart.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconfold.functions.expressions import first_where, literal, local_hour, nodash
from beaconfold.operators.events import dedupe_events, hot_buckets, with_salt
from beaconfold.profiles import PartnerProfile
from beaconfold.schemas import EVENT_TYPES, FRAUD_CATEGORIES, SESSION_DATA, SESSIONS
from beaconfold.sources.events import ORDER

# Sessions of fewer events than this are never worth splitting over tasks.
HOT_SESSION_EVENTS = 1_000_000

# Play time (ms) without sound beyond which an ad counts as muted, endpoints,
# and the codes by which an impression is measurable under each standard.
MUTED_AFTER = 1000
DISPLAY, VIDEO = "display", "video"
MRC_CODES = "1, 3"
GROUPM_CODES = "2, 3"


@dataclass(frozen=True)
class Fact:
    """An aggregate over a session's events, as SQL text, and the event columns it reads."""

    inputs: tuple[str, ...]
    sql: str


# Event types as bits: text is compared once per event, and one aggregate holds all types seen.
EVENT_BITS = {event: 1 << n for n, event in enumerate(EVENT_TYPES)}


def _event_bit(p: PartnerProfile) -> str:
    whens = " ".join(f"WHEN {literal(p.events[event])} THEN {bit}" for event, bit in EVENT_BITS.items())
    return f"CASE type {whens} ELSE 0 END AS _event"


def _is(event: str) -> str:
    return f"_event = {EVENT_BITS[event]}"


def _saw(event: str) -> Fact:
    return Fact(("type",), f"(bit_or(_event) & {EVENT_BITS[event]}) <> 0")


def _of(event: str, column: str, value: str | None = None) -> Fact:
    """First non-null value among events of one type."""
    return Fact(("type", column), first_where(value or column, _is(event), ORDER))


# A display ad loads with its impression, a video with its start; the event's own endpoint decides.
_LOADS = f"((endpoint = '{DISPLAY}' AND {_is('impression')}) OR (endpoint = '{VIDEO}' AND {_is('started')}))"


# Columns carried over from the impression event.
IMPRESSION_COLUMNS = (
    "site",
    "measurement_source_id",
    "partner_measured_advertiser_id",
    "partner_measured_campaign_id",
    "partner_measured_placement_id",
    "partner_measured_creative_id",
    "media_type_id",
    "endpoint",
    "suspicious",
    "general_invalid",
    "fraud_category",
)

# Suffix in session columns -> the event whose in-view state it reports.
CHECKPOINTS = {
    "unload": "unload",
    "1q": "first_quartile",
    "2q": "second_quartile",
    "3q": "third_quartile",
    "4q": "completed",
}

FACTS: dict[str, Fact] = {
    "utchour": Fact(("utchour",), f"min_by(utchour, {ORDER})"),
    **{f"saw_{event}": _saw(event) for event in EVENT_TYPES},
    **{column: _of("impression", column) for column in IMPRESSION_COLUMNS},
    "impression_full_screen": _of("impression", "full_screen"),
    "mrc_measurable": _of("impression", "measurable", f"(measurable IN ({MRC_CODES}))"),
    "groupm_measurable": _of("impression", "measurable", f"(measurable IN ({GROUPM_CODES}))"),
    "mrc_at_load": Fact(("type", "endpoint", "in_view_50"), first_where("in_view_50", _LOADS, ORDER)),
    "groupm_at_load": _of("started", "in_view_100"),
    **{f"mrc_at_{suffix}": _of(event, "in_view_50") for suffix, event in CHECKPOINTS.items()},
    **{f"groupm_at_{suffix}": _of(event, "in_view_100") for suffix, event in CHECKPOINTS.items()},
    "plays_muted": Fact(
        ("non_continuous_play_time", "audible_play_time"),
        f"max(non_continuous_play_time) - max(audible_play_time) > {MUTED_AFTER}",
    ),
}


#: Columns by which events of one key are told apart where a profile has no order of its own: the same for any set of facts.
TIE_COLUMNS = tuple(sorted({c for fact in FACTS.values() for c in fact.inputs}))


def fold_events(
    events: DataFrame,
    profile: PartnerProfile,
    facts: Iterable[str] = tuple(FACTS),
    *,
    impressions_only: bool = True,
    also_by: Iterable[str] = (),
) -> DataFrame:
    """Aggregate deduplicated events to one row of facts per session.

    Without an order column, events come by timestamp and then by type: no two that are left share both.
    """
    wanted = {"_has_impression": FACTS["saw_impression"], **{name: FACTS[name] for name in facts}}
    if ORDER not in events.columns:
        told_apart = [c for c in profile.dedupe_keys if c not in profile.session_keys]
        events = events.withColumn(ORDER, F.struct(*sorted(told_apart, key=lambda c: (c != "timestamp", c))))
    folded = (
        events.selectExpr("*", _event_bit(profile))
        .groupBy(*profile.session_keys, *also_by)
        .agg(*[F.expr(f"{fact.sql} AS {name}") for name, fact in wanted.items()])
    )
    return (folded.where("_has_impression") if impressions_only else folded).drop("_has_impression", *also_by)


def session_facts(
    events: DataFrame,
    profile: PartnerProfile,
    facts: Iterable[str] = tuple(FACTS),
    *,
    impressions_only: bool = True,
    hot_session_events: int = HOT_SESSION_EVENTS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Session facts straight from canonical events of one day.

    Ordinary sessions are brought together by their key once; that one shuffle and sort
    serve both the dedupe and the fold. Sessions too large for one task (see
    :func:`hot_buckets`; pass ``hot`` to reuse a set found earlier, a bounded number of buckets) have their events dealt by key and salt in that
    same shuffle. Copies collapse per session and salt; what is left of large sessions goes on to another
    dedupe and a fold whose map tasks pre-aggregate, so no task receives a whole one. The events are read once: both
    routes begin behind the one shuffle.
    """
    facts = tuple(facts)
    keys = list(profile.session_keys)
    # Session keys lead, so the sort for the dedupe also serves the fold.
    dedupe_keys = keys + [c for c in profile.dedupe_keys if c not in keys]
    if ORDER in events.columns:
        payload = [ORDER, *sorted({c for f in (*facts, "saw_impression") for c in FACTS[f].inputs})]
    else:
        payload = list(TIE_COLUMNS)
    events = events.select(dedupe_keys + [c for c in payload if c not in dedupe_keys])

    found = hot_buckets(events, keys, hot_session_events) if hot is None else hot
    buckets = sorted(r["_bucket"] for r in found.collect())

    def fold(part: DataFrame, also_by: Iterable[str] = ()) -> DataFrame:
        return fold_events(part, profile, facts, impressions_only=impressions_only, also_by=also_by)

    if not buckets:
        return fold(dedupe_events(events.repartition(*keys), dedupe_keys))
    salted = with_salt(events, buckets, keys).repartition(*keys, "_salt")
    # The route is an aggregate and not the salt itself: a filter on it stays behind the shuffle, which both routes share.
    collapsed = dedupe_events(salted.withColumn("_route", F.col("_salt")), [*keys, "_salt", *dedupe_keys[len(keys) :]])
    ordinary, oversized = collapsed.where("_route = 0"), collapsed.where("_route > 0").drop("_salt", "_route")
    return fold(ordinary.drop("_route"), ["_salt"]).unionByName(fold(dedupe_events(oversized, dedupe_keys)))


@dataclass(frozen=True)
class RuleGroup:
    """Output columns as SQL text, and the facts they are computed from."""

    facts: tuple[str, ...]
    columns: Mapping[str, str]


# Verdicts on a session that the rules build on.
CLEAN = "(NOT suspicious AND NOT general_invalid)"
MRC_SEEN = f"((endpoint = '{DISPLAY}' AND saw_in_view) OR (endpoint = '{VIDEO}' AND saw_in_view_50))"
MRC_UNSEEN = f"((endpoint = '{DISPLAY}' AND NOT saw_in_view) OR (endpoint = '{VIDEO}' AND NOT saw_in_view_50))"
MRC_VIEWABLE = f"(mrc_measurable AND {MRC_SEEN})"
GROUPM_VIEWABLE = "(groupm_measurable AND saw_full_in_view)"

_CLEAN = ("suspicious", "general_invalid")
_VIEWABLE = ("endpoint", "mrc_measurable", "groupm_measurable", "saw_in_view", "saw_in_view_50", "saw_full_in_view")
_COMPLETIONS = {suffix: event for suffix, event in CHECKPOINTS.items() if suffix != "unload"}
_IN_VIEW_AT = ("load", *CHECKPOINTS)

_PLAYBACK = {
    "never_started": f"{CLEAN} AND NOT saw_started",
    "muted": f"{CLEAN} AND plays_muted",
    "full_screen": f"{CLEAN} AND impression_full_screen",
}

RULES = {
    "dimensions": RuleGroup(
        tuple(c for c in IMPRESSION_COLUMNS if c in SESSION_DATA.names),
        {c: c for c in IMPRESSION_COLUMNS if c in SESSION_DATA.names},
    ),
    "measurability": RuleGroup(
        ("mrc_measurable", "groupm_measurable"),
        {"mrc_measurable": "mrc_measurable", "groupm_measurable": "groupm_measurable"},
    ),
    "viewability": RuleGroup(
        (*_CLEAN, *_VIEWABLE, "saw_in_view_5s", "saw_in_view_15s", "saw_full_in_view_2s"),
        {
            "in_view": f"{CLEAN} AND {MRC_VIEWABLE}",
            "not_in_view": f"{CLEAN} AND {MRC_UNSEEN}",
            "in_view_5s": f"{CLEAN} AND saw_in_view_5s",
            "in_view_15s": f"{CLEAN} AND saw_in_view_15s",
            "groupm_in_view": f"{CLEAN} AND {GROUPM_VIEWABLE}",
            "groupm_not_in_view": f"{CLEAN} AND NOT {GROUPM_VIEWABLE}",
            "full_ad_in_view": f"{CLEAN} AND groupm_measurable AND saw_full_in_view_2s",
            "publicis_in_view": f"{CLEAN} AND groupm_measurable AND saw_full_in_view_2s",
        },
    ),
    "quartiles": RuleGroup(
        (
            *_CLEAN,
            "mrc_measurable",
            "groupm_measurable",
            *(f"{standard}_at_{suffix}" for standard in ("mrc", "groupm") for suffix in _IN_VIEW_AT),
            *(f"saw_{event}" for event in _COMPLETIONS.values()),
        ),
        {f"in_view_{suffix}": f"{CLEAN} AND mrc_measurable AND mrc_at_{suffix}" for suffix in _IN_VIEW_AT}
        | {
            f"groupm_in_view_{suffix}": f"{CLEAN} AND groupm_measurable AND groupm_at_{suffix}"
            for suffix in _IN_VIEW_AT
        }
        | {f"completed_{suffix}": f"{CLEAN} AND saw_{event}" for suffix, event in _COMPLETIONS.items()}
        | {f"groupm_completed_{suffix}": f"{CLEAN} AND saw_{event}" for suffix, event in _COMPLETIONS.items()},
    ),
    "playback": RuleGroup(
        (*_CLEAN, "saw_started", "plays_muted", "impression_full_screen"),
        _PLAYBACK | {f"groupm_{name}": rule for name, rule in _PLAYBACK.items()},
    ),
    "traffic": RuleGroup(
        (*_CLEAN, *_VIEWABLE),
        {
            "suspicious": "suspicious",
            "general_invalid": "general_invalid",
            "sivt_in_view": f"NOT {CLEAN} AND {MRC_VIEWABLE}",
            "sivt_not_in_view": f"NOT {CLEAN} AND NOT {MRC_VIEWABLE}",
            "groupm_sivt_in_view": f"NOT {CLEAN} AND {GROUPM_VIEWABLE}",
            "groupm_sivt_not_in_view": f"NOT {CLEAN} AND NOT {GROUPM_VIEWABLE}",
            "viewability_measured_or_fraud": f"mrc_measurable OR groupm_measurable OR NOT {CLEAN}",
        },
    ),
    "fraud": RuleGroup(
        ("suspicious", "fraud_category"),
        {column: f"suspicious AND fraud_category = {literal(c)}" for c, column in FRAUD_CATEGORIES.items()},
    ),
}

# Flags this feed never raises. Every other column without a rule is NULL.
ALWAYS_FALSE = (
    "click_through",
    "groupm_in_view_5s",
    "groupm_in_view_15s",
    "groupm_never_in_view",
    "groupm_click_through",
)


def rule_columns(facts: DataFrame, group: str, *carry: str) -> DataFrame:
    """The output columns of one rule group, next to the named columns of ``facts``."""
    return facts.selectExpr(*carry, *[f"{rule} AS {name}" for name, rule in RULES[group].columns.items()])


def session_columns(facts: DataFrame, data_date: str, tz_offset: int) -> DataFrame:
    """The declared session layout from a full set of facts."""
    rules = {name: rule for group in RULES.values() for name, rule in group.columns.items()}
    rules |= {name: "FALSE" for name in ALWAYS_FALSE}
    rules |= {
        "date": literal(nodash(data_date)),
        "hour": local_hour("utchour", tz_offset),
        "impression_id": "impression_id",
        "viewability_measurement_trusted": "mrc_measurable",
    }
    return facts.selectExpr(
        *[f"CAST({rules.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in SESSIONS.fields]
    )


def ad_sessions(
    events: DataFrame, profile: PartnerProfile, data_date: str, tz_offset: int, **folding: object
) -> DataFrame:
    """Ad sessions of one day from its canonical events, in the declared column order."""
    return session_columns(session_facts(events, profile, **folding), data_date, tz_offset)
