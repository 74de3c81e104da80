"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.contract import PASSED_RESULTS, RISK_RESULTS, TIER_CODES


def passed(result: Column) -> Column:
    """1 for a passing result, else 0, also for a missing result."""
    return F.when(F.upper(result).isin(*PASSED_RESULTS), 1).otherwise(0)


def performance_tier(result: Column) -> Column:
    """Ordered code of a known result, else null."""
    name = F.upper(result)
    tier = F.lit(None).cast("int")
    for label, code in TIER_CODES.items():
        tier = F.when(name == label, code).otherwise(tier)
    return tier


def academic_risk(result: Column) -> Column:
    """1 for a risk result, 0 for another, null for a missing result."""
    return result.isin(*RISK_RESULTS).cast("int")


def fixed_score(clicks: Column, attempts: Column) -> Column:
    """A deterministic probability for exercising metrics without a model.

    Rounding makes ties on purpose.
    """
    return F.round(1 / (1 + F.exp(-(F.lit(0.2) - 0.01 * clicks + 0.15 * attempts))), 6)
