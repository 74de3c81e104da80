"""Leakage-safe cohort and early-risk analytics as Spark DataFrame operators."""

from cohortlens.plans.commands import (
    build_mart,
    build_scoring_frame,
    profile,
    score,
    train_champion,
)

__all__ = ["build_mart", "profile", "train_champion", "build_scoring_frame", "score"]
