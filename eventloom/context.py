"""What an operator needs to know: the two event sources, the day, the event vocabulary."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from eventloom.sources.events import EventSource


@dataclass(frozen=True)
class Roles:
    """Event names by the part they play; every operator reads names from here."""

    exposure: str
    entries: tuple[str, ...]
    generate: str
    select: str
    save: str
    save_use: str
    complete_back: str
    prompt: str
    label_adjust: str
    description_adjust: str
    rate: str
    upgrade_popup: str
    upgrade_confirm: str
    upgrade_cancel: str
    payment_like: str
    credit: str
    credit_feature: str
    tts: str
    tts_feature_path: str
    template_click: str
    generate_success: str
    path_excluded: tuple[str, ...]
    path_excluded_suffix: str
    path_kept: str

    @property
    def funnel(self) -> tuple[str, ...]:
        return (self.exposure, *self.entries, self.generate, self.select, self.save, self.save_use, self.complete_back)

    @property
    def trend(self) -> tuple[str, ...]:
        return (self.exposure, *self.entries, self.generate, self.select, self.save)

    @property
    def exits(self) -> tuple[str, ...]:
        return (self.save_use, self.complete_back)

    @property
    def upgrades(self) -> tuple[str, ...]:
        return (self.upgrade_popup, self.upgrade_confirm, self.upgrade_cancel)


@dataclass(frozen=True)
class TierRule:
    """Users by generates per active day: high >= `high`, mid > `mid`, low > 0, none otherwise."""

    days: int = 14
    high: float = 4.0
    mid: float = 1.5


TIERS = ("high", "mid", "low", "none")
SEGMENTS = ("all", *TIERS)


@dataclass(frozen=True)
class Period:
    """Half-open range of days; `hi=None` leaves the end open."""

    name: str
    lo: date
    hi: date | None


def standard_periods(as_of: date) -> tuple[Period, ...]:
    return tuple(
        Period(name, as_of - timedelta(days=n), as_of)
        for name, n in (("yesterday", 1), ("last_3d", 3), ("last_7d", 7))
    )


@dataclass(frozen=True)
class Ctx:
    """`as_of` is the first day *not* reported on: "today" with its partial data."""

    intraday: EventSource
    daily: EventSource
    as_of: date
    roles: Roles
    tier_rule: TierRule = field(default_factory=TierRule)

    def ago(self, days: int) -> date:
        return self.as_of - timedelta(days=days)

    @property
    def periods(self) -> tuple[Period, ...]:
        return standard_periods(self.as_of)

    @property
    def spark(self):
        return self.intraday.df.sparkSession
