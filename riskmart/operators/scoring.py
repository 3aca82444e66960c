"""Explainable additive risk rules.

A rule that fires adds its points to the score and its code to the reasons. A
condition that is NULL does not fire.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart.functions.values import fired_codes


@dataclass(frozen=True)
class RiskRule:
    code: str
    points: int
    condition: str


# Codes, points, thresholds and actions of rule set rules-v1.
RULES_VERSION = "rules-v1"
PAYMENT_RULES = (
    RiskRule("AMOUNT_OUTLIER", 30, "amount >= greatest(250, customer_average_amount * 3)"),
    RiskRule("NEW_DEVICE", 20, "is_new_device"),
    RiskRule("IP_HOME_MISMATCH", 20, "ip_region <> home_region"),
    RiskRule("SHIPPING_HOME_MISMATCH", 10, "shipping_region <> home_region"),
    RiskRule("REPEATED_LOGIN_FAILURES", 20, "login_failures >= 3"),
    RiskRule("REPEATED_PAYMENT_ATTEMPTS", 15, "attempt_number >= 4"),
)
SCORE_CAP = 100
ACTIONS = {"DECLINE": 60, "REVIEW": 30, "APPROVE": 0}

# The marketplace heuristic, which labels nothing as confirmed fraud.
HEURISTIC_RULES = (
    RiskRule("AMOUNT_OUTLIER", 35, "payment_value_brl > greatest(customer_average_brl * 3, 500)"),
    RiskRule("HIGH_INSTALLMENTS", 20, "installments >= 10"),
    RiskRule("SPLIT_PAYMENT", 10, "payment_sequence > 1"),
    RiskRule("FAILED_ORDER", 25, "order_status IN ('canceled', 'unavailable')"),
    RiskRule("LOW_REVIEW", 10, "review_score = 1"),
)
BANDS = {"HIGH": 60, "MEDIUM": 30, "LOW": 0}
LABEL_STATUS = "HEURISTIC_PROXY_NOT_CONFIRMED_FRAUD"


def reasons(rules: Sequence[RiskRule]) -> Column:
    return fired_codes((rule.code, rule.condition) for rule in rules)


def points(rules: Sequence[RiskRule]) -> Column:
    return F.expr(" + ".join(f"CASE WHEN {r.condition} THEN {r.points} ELSE 0 END" for r in rules))


def graded(score: Column, floors: dict[str, int]) -> Column:
    """Name of the highest floor the score reaches; floors are listed from the top."""
    *upper, (lowest, _) = floors.items()
    name = F.lit(lowest)
    for label, floor in reversed(upper):
        name = F.when(score >= floor, label).otherwise(name)
    return name
