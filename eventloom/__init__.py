"""Product-event analytics as lazy Spark DataFrame transformations."""

from eventloom.context import Ctx, Period, Roles, TierRule, standard_periods
from eventloom.sources.events import EventSource

__all__ = ["Ctx", "EventSource", "Period", "Roles", "TierRule", "standard_periods"]
