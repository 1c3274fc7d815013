"""SQL text for generated expressions.

A section counts dozens of measures; as text each is one call into the JVM instead of ten.
"""

from __future__ import annotations

from datetime import date


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named_sql(names: tuple[str, ...] = (), like: str | None = None) -> str:
    if like is not None:
        return f"event_name like {quoted(like)}"
    if len(names) == 1:
        return f"event_name = {quoted(names[0])}"
    return f"event_name in ({', '.join(map(quoted, names))})"


def between_sql(lo: date | None, hi: date | None) -> str:
    bounds = [f"event_date {op} '{day:%Y%m%d}'" for op, day in ((">=", lo), ("<", hi)) if day is not None]
    return " and ".join(bounds) or "true"


def count_sql(condition: str, weight: str | None = None) -> str:
    """Rows meeting `condition`, or the sum of their `weight`.

    Many `count_if` in one aggregate put a projection of all conditions in front of it, whose
    generated code outgrows what the JVM compiles; this form is generated per aggregate.
    """
    if weight:
        return f"coalesce(sum(case when {condition} then {weight} end), 0L)"
    return f"count(case when {condition} then 1 end)"
