"""Colour classes of a value, as listed in the view definitions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class -> rule.  A rule is a list of words, a comparison, a closed
# number range or a boolean; classes are tried in the order given.
SEVERITY = {
    "red": "ERROR|FATAL|CRITICAL",
    "yellow": "WARN|WARNING",
    "green": "INFO|INFORMATION|SUCCESS",
    "blue": "DEBUG|TRACE",
    "gray": "UNKNOWN",
}
SYSLOG_SEVERITY = {
    "red": "ERROR|ALERT|EMERG|CRIT",
    "yellow": "WARNING",
    "green": "NOTICE",
    "blue": "DEBUG|INFO",
    "gray": "UNKNOWN",
}
DURATION_MICROS = {"green": "< 100000", "yellow": "< 500000", "orange": "< 1000000", "red": ">= 1000000"}
LATENCY = {"red": "> 5000", "yellow": "> 1000", "green": "<= 1000"}
COUNT = {"red": "> 1000", "yellow": "> 100", "green": "<= 100"}
COUNT_SMALL = {"red": "> 100", "yellow": "> 10", "green": "<= 10"}
HTTP_STATUS = {"green": "200-299", "yellow": "300-399", "orange": "400-499", "red": "500-599"}
STATUS_WORD = {
    "green": "SUCCESS|OK|COMPLETED|ACTIVE",
    "yellow": "PENDING|PROCESSING|WARNING",
    "red": "ERROR|FAILED|INACTIVE|CRITICAL",
    "blue": "RUNNING|IN_PROGRESS",
}
SPAN_KIND = {
    "blue": "CLIENT",
    "green": "SERVER",
    "yellow": "PRODUCER",
    "orange": "CONSUMER",
    "purple": "INTERNAL",
}
ERROR_FLAG = {"red": "true", "green": "false"}


def color_class(value: Column, options: Mapping[str, str]) -> Column:
    """The first class whose rule holds for `value`; null where none does."""
    result = F
    for color, rule in options.items():
        result = result.when(_holds(value, rule), F.lit(color))
    return result


def _holds(value: Column, rule: str) -> Column:
    compared = re.fullmatch(r"(<=|>=|<|>) *(-?[\d.]+)", rule)
    if compared:
        bound = F.lit(float(compared[2])) if "." in compared[2] else F.lit(int(compared[2]))
        return {
            "<": value < bound,
            "<=": value <= bound,
            ">": value > bound,
            ">=": value >= bound,
        }[compared[1]]
    ranged = re.fullmatch(r"(\d+)-(\d+)", rule)
    if ranged:
        return value.between(int(ranged[1]), int(ranged[2]))
    if rule in ("true", "false"):
        return value.cast("boolean") == F.lit(rule == "true")
    return F.upper(value).isin(rule.split("|"))
