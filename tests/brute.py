"""The session rules on plain Python lists, event by event, with three-valued logic."""

from collections import defaultdict

from beaconfold.schemas import EVENT_TYPES, FRAUD_CATEGORIES, SESSIONS


def NOT(a):
    return None if a is None else not a


def AND(*xs):
    return False if any(x is False for x in xs) else None if any(x is None for x in xs) else True


def OR(*xs):
    return True if any(x is True for x in xs) else None if any(x is None for x in xs) else False


def EQ(a, b):
    return None if a is None or b is None else a == b


def dedupe(events, keys):
    first = {}
    for e in sorted(events, key=lambda e: e["event_seq"]):
        first.setdefault(tuple(e[k] for k in keys), e)
    return list(first.values())


def fold(events, profile, data_date, tz_offset):
    groups = defaultdict(list)
    for e in dedupe(events, profile.dedupe_keys):
        groups[tuple(e[k] for k in profile.session_keys)].append(e)
    rows = []
    for group in groups.values():
        group.sort(key=lambda e: e["event_seq"])
        types = {e["type"] for e in group}
        if "impression" in types:
            rows.append(session(group, types, data_date, tz_offset))
    return rows


def session(group, types, data_date, tz_offset):
    def first(event, value):
        return next((value(e) for e in group if e["type"] == event and value(e) is not None), None)

    def prop(event, column):
        return first(event, lambda e: e[column])

    def saw(event):
        return EVENT_TYPES[event] in types

    def measurable(*codes):
        return first("impression", lambda e: None if e["measurable"] is None else e["measurable"] in codes)

    def biggest(column):
        return max((e[column] for e in group if e[column] is not None), default=None)

    S, GI, FC = (prop("impression", c) for c in ("suspicious", "general_invalid", "fraud_category"))
    ep, M, G = prop("impression", "endpoint"), measurable(1, 3), measurable(2, 3)
    C = AND(NOT(S), NOT(GI))
    MV = AND(M, OR(AND(EQ(ep, "display"), saw("in_view")), AND(EQ(ep, "video"), saw("in_view_50"))))
    GV = AND(G, saw("full_in_view"))
    load = next(
        (
            e["in_view_50"]
            for e in group
            if (e["endpoint"], e["type"]) in (("display", "impression"), ("video", "started"))
            and e["in_view_50"] is not None
        ),
        None,
    )
    ncp, ap = biggest("non_continuous_play_time"), biggest("audible_play_time")
    muted = None if ncp is None or ap is None else ncp - ap > 1000
    marks = {"1q": "first_quartile", "2q": "second_quartile", "3q": "third_quartile", "4q": "completed"}

    out = {f.name: None for f in SESSIONS.fields}
    out |= {
        "date": data_date.replace("-", ""),
        "hour": f"{(int(group[0]['utchour']) + int(24 + tz_offset / 3600)) % 24:02d}",
        "impression_id": group[0]["impression_id"],
        "in_view": AND(C, MV),
        "in_view_5s": AND(C, saw("in_view_5s")),
        "in_view_15s": AND(C, saw("in_view_15s")),
        "not_in_view": AND(
            C, OR(AND(EQ(ep, "display"), not saw("in_view")), AND(EQ(ep, "video"), not saw("in_view_50")))
        ),
        "in_view_load": AND(C, M, load),
        "in_view_unload": AND(C, M, prop("unload", "in_view_50")),
        "groupm_in_view_load": AND(C, G, prop("started", "in_view_100")),
        "groupm_in_view_unload": AND(C, G, prop("unload", "in_view_100")),
        "sivt_in_view": AND(NOT(C), MV),
        "sivt_not_in_view": AND(NOT(C), NOT(MV)),
        "groupm_in_view": AND(C, GV),
        "groupm_not_in_view": AND(C, NOT(GV)),
        "groupm_sivt_in_view": AND(NOT(C), GV),
        "groupm_sivt_not_in_view": AND(NOT(C), NOT(GV)),
        "suspicious": S,
        "general_invalid": GI,
        "viewability_measurement_trusted": M,
        "full_ad_in_view": AND(C, G, saw("full_in_view_2s")),
        "publicis_in_view": AND(C, G, saw("full_in_view_2s")),
        "viewability_measured_or_fraud": OR(M, G, NOT(C)),
    }
    for column in (
        *("site", "measurement_source_id", "partner_measured_advertiser_id", "partner_measured_campaign_id"),
        *("partner_measured_placement_id", "partner_measured_creative_id", "media_type_id"),
    ):
        out[column] = prop("impression", column)
    for prefix in ("", "groupm_"):
        out[f"{prefix}never_started"] = AND(C, not saw("started"))
        out[f"{prefix}muted"] = AND(C, muted)
        out[f"{prefix}full_screen"] = AND(C, prop("impression", "full_screen"))
        out[f"{prefix}click_through"] = False
        for mark, event in marks.items():
            out[f"{prefix}completed_{mark}"] = AND(C, saw(event))
    for mark, event in marks.items():
        out[f"in_view_{mark}"] = AND(C, M, prop(EVENT_TYPES[event], "in_view_50"))
        out[f"groupm_in_view_{mark}"] = AND(C, G, prop(EVENT_TYPES[event], "in_view_100"))
    for column in ("groupm_in_view_5s", "groupm_in_view_15s", "groupm_never_in_view"):
        out[column] = False
    for category, column in FRAUD_CATEGORIES.items():
        out[column] = AND(S, EQ(FC, category))
    return tuple(out[f.name] for f in SESSIONS.fields)
