"""Status codes, alert rules and severities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metric value per cluster status.
STATUS_CODES = {"Running": 1, "Completed": 2, "Failed": 3, "Cancelled": 4}

# Severity and notice type per alert rule.
RULE_SEVERITY = {
    "failed": "Critical",
    "terminated": "High",
    "success": "Critical",
    "success_with_errors": "High",
    "running": "Critical",
}
RULE_NOTICE = {
    "failed": "Error",
    "terminated": "Information",
    "success": "Information",
    "success_with_errors": "Warning",
    "running": "Information",
}


def lookup(values: dict, key: Column) -> Column:
    """Constant map lookup; NULL for an unknown key."""
    pairs = [F.lit(part) for pair in values.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def status_code(status: Column) -> Column:
    return lookup(STATUS_CODES, F.initcap(status))


def severity(rule: Column) -> Column:
    return lookup(RULE_SEVERITY, rule)


def notice_type(rule: Column) -> Column:
    return lookup(RULE_NOTICE, rule)
