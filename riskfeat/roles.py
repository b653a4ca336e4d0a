"""Which column plays which part, so operators never hard-code names."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EventRoles:
    """Column roles of an event table.

    ``timestamp`` is whole seconds since the log's origin; ``seq`` is a unique row
    id that settles ties, so every ordered operator gives one answer.
    """

    user: str = "user_id"
    timestamp: str = "timestamp"
    seq: str = "seq"
    days: str = "days_diff"
    hour: str = "hour"
    week: str = "week"
    amount: str = "amount"
    property: str = "property"
    session: str = "session"


@dataclass(frozen=True)
class LabelRoles:
    """Column roles of the label table; a NULL label marks a row to score."""

    user: str = "user_id"
    label: str = "label"
    fold: str = "fold"
