"""What differs from one partner to the next."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from beaconfold.schemas import EVENT_TYPES, WIRE_NAMES


@dataclass(frozen=True)
class PartnerProfile:
    """Settings of one partner's event stream.

    ``session_keys``
        Columns that identify one ad session.
    ``dedupe_keys``
        Columns that identify one event; copies beyond the first are dropped. They must
        contain the session keys, so that one shuffle can serve both steps.
    ``event_order``
        Raw column holding a total order of the events of a session, smallest first.
        ``None`` orders by timestamp and then by a hash of the row.
    ``measurement_source_id``
        The partner's id in the reference tables.
    """

    name: str
    session_keys: tuple[str, ...]
    measurement_source_id: int | None = None
    dedupe_keys: tuple[str, ...] = ("impression_id", "type", "timestamp")
    event_order: str | None = None
    renames: Mapping[str, str] = field(default_factory=lambda: dict(WIRE_NAMES))
    events: Mapping[str, str] = field(default_factory=lambda: dict(EVENT_TYPES))

    def __post_init__(self) -> None:
        missing = set(self.session_keys) - set(self.dedupe_keys)
        if missing:
            raise ValueError(f"session keys {sorted(missing)} are not among the dedupe keys of {self.name}")


# An impression served again at another time is another session.
PINTEREST = PartnerProfile("pinterest", session_keys=("impression_id", "timestamp"))

# All events of an impression make one session, whenever they arrive.
SNAPCHAT = PartnerProfile("snapchat", session_keys=("impression_id",), measurement_source_id=10)

PROFILES = {p.name: p for p in (PINTEREST, SNAPCHAT)}


def select_profiles(partners: list[str] | None = None) -> list[PartnerProfile]:
    """Profiles to run: those named, or all."""
    unknown = set(partners or ()) - set(PROFILES)
    if unknown:
        raise ValueError(f"no profile for {sorted(unknown)}; known are {sorted(PROFILES)}")
    return [PROFILES[name] for name in (partners or PROFILES)]
