"""Column expressions used by several operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.schema import BOT_PATTERNS, SEVERITIES


def count_where(condition: Column) -> Column:
    """Rows that satisfy `condition`; NULL counts as no."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def is_error(status: str = "status_code") -> Column:
    return F.col(status) >= 400


def is_client_error(status: str = "status_code") -> Column:
    return F.col(status).between(400, 499)


def is_server_error(status: str = "status_code") -> Column:
    return F.col(status) >= 500


def ratio(part: str | Column, whole: str | Column) -> Column:
    """part / whole as double, NULL for an empty whole."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.try_divide(part.cast("double"), whole.cast("double"))


def agent_matches(patterns=BOT_PATTERNS, column: str = "user_agent") -> Column:
    agent = F.lower(F.col(column))
    return reduce(lambda a, b: a | b, [agent.contains(p) for p in patterns])


def severity_rank(severity: Column) -> Column:
    """1 for the weakest severity upwards, 0 for anything unknown."""
    return F.coalesce(
        F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), severity), F.lit(0)
    ).cast("int")


def strongest(alerts: Column) -> Column:
    """Highest severity in an alert array; NULL when the array is NULL or empty."""
    severities = F.transform(alerts, lambda a: F.coalesce(a["severity"], F.lit("LOW")))
    return (
        F.when(F.array_contains(severities, "CRITICAL"), F.lit("CRITICAL"))
        .when(F.array_contains(severities, "HIGH"), F.lit("HIGH"))
        .when(F.array_contains(severities, "MEDIUM"), F.lit("MEDIUM"))
        .when(F.size(severities) > 0, F.lit("LOW"))
    )
