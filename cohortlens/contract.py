"""Column roles, the versioned feature contract and the fixed thresholds."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import types as T

# Column roles of the enrollment mart.
KEYS = ("id_student", "code_module", "code_presentation")
COURSE_KEYS = ("code_module", "code_presentation")
TARGETS = ("final_result", "passed", "performance_tier", "weighted_assessment_score")
OUTCOMES = TARGETS + ("academic_risk",)
SENSITIVE = ("gender", "disability", "region", "imd_band")
DESCRIPTIVE_ONLY = ("gender", "age_band", "highest_education")
CATEGORICAL_FEATURES = ("highest_education", "age_band")
NUMERIC_FEATURES = (
    "num_of_prev_attempts",
    "studied_credits",
    "date_registration",
    "course_duration_days",
    "total_clicks",
    "active_days",
    "vle_events",
    "vle_sites",
    "has_vle_activity",
)
FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES
ACTIVITY = ("total_clicks", "active_days", "vle_events", "vle_sites")
ENGAGEMENT = "total_clicks"
SCORE = "weighted_assessment_score"

# Outcome domain, in display order.
RESULT_ORDER = ("Withdrawn", "Fail", "Pass", "Distinction")
RISK_RESULTS = ("Withdrawn", "Fail")
NON_RISK_RESULTS = ("Pass", "Distinction")
PASSED_RESULTS = ("PASS", "DISTINCTION")
TIER_CODES = {"FAIL": 0, "WITHDRAWN": 1, "PASS": 2, "DISTINCTION": 3}
RISK_LABEL = "Riesgo académico"
NON_RISK_LABEL = "Resultado favorable"
MISSING_LABEL = "Sin dato"

# Category orders used by the descriptive tables.
CATEGORY_ORDERS = {
    "gender": ("F", "M"),
    "age_band": ("0-35", "35-55", "55<="),
    "highest_education": (
        "No Formal quals",
        "Lower Than A Level",
        "A Level or Equivalent",
        "HE Qualification",
        "Post Graduate Qualification",
    ),
}

# Ordinal codes (position = code) of the multi-target preparation.
ORDINAL_LEVELS = {
    "highest_education": ("No Formal", "Lower Secondary", "Upper Secondary", "Bachelor", "Master"),
    "education_level": ("No Formal", "Lower Secondary", "Upper Secondary", "Bachelor", "Master"),
    "age_band": ("0-35", "35-55", "55-"),
}

# Thresholds.
DEFAULT_CUTOFF = 30
DEFAULT_HOLDOUT = "2014J"
NEAR_DUPLICATE = 0.95
SPARSE_GROUP = 30
WHISKER = 1.5
CAPACITY = 0.20
RISK_THRESHOLD = 0.5
CALIBRATION_BINS = 5
MAX_FOLDS = 5
MISSINGNESS_SHIFT = 0.20
TOP_IMPORTANCES = 15
TOP_IMPORTANCES_LEGACY = 10
BANNED_TOKENS = ("kongo",)
TARGET_DEFINITION = (
    "academic_risk = 1 when final_result is Withdrawn or Fail; 0 when Pass or Distinction"
)

CONTRACT_VERSION = "cohortlens-risk-features/v1"
BUNDLE_VERSION = 3
ARTIFACT_VERSION = 2
# Names of the written artifact tables.
ARTIFACTS = {"full": "training_full", "features": "features", "targets": "targets"}


@dataclass(frozen=True)
class ColumnRoles:
    """Which columns are keys, targets, descriptive only, and so on."""

    keys: tuple[str, ...] = KEYS
    targets: tuple[str, ...] = TARGETS
    derived_outcomes: tuple[str, ...] = ("academic_risk",)
    descriptive_only: tuple[str, ...] = DESCRIPTIVE_ONLY
    identifier_prefix: str = "id_"

    def candidates(self, schema: T.StructType) -> list[str]:
        """Columns that are neither keys, outcomes nor descriptive-only."""
        hidden = {*self.keys, *self.targets, *self.derived_outcomes, *self.descriptive_only}
        return [name for name in schema.names if name not in hidden]

    def numeric_candidates(self, schema: T.StructType) -> list[str]:
        return [
            name
            for name in self.candidates(schema)
            if isinstance(schema[name].dataType, T.NumericType)
            and not name.startswith(self.identifier_prefix)
        ]

    def categorical_candidates(self, schema: T.StructType) -> list[str]:
        return [
            name
            for name in self.candidates(schema)
            if isinstance(schema[name].dataType, (T.StringType, T.BooleanType))
        ]


ROLES = ColumnRoles()

# The 22-column mart as it is written to and read from delimited files.
MART_SCHEMA = T.StructType(
    [
        T.StructField("id_student", T.LongType()),
        T.StructField("code_module", T.StringType()),
        T.StructField("code_presentation", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("highest_education", T.StringType()),
        T.StructField("imd_band", T.StringType()),
        T.StructField("disability", T.BooleanType()),
        T.StructField("age_band", T.StringType()),
        T.StructField("num_of_prev_attempts", T.IntegerType()),
        T.StructField("studied_credits", T.IntegerType()),
        T.StructField("date_registration", T.IntegerType()),
        T.StructField("course_duration_days", T.IntegerType()),
        T.StructField("total_clicks", T.LongType()),
        T.StructField("active_days", T.LongType()),
        T.StructField("vle_events", T.LongType()),
        T.StructField("vle_sites", T.LongType()),
        T.StructField("has_vle_activity", T.IntegerType()),
        T.StructField("final_result", T.StringType()),
        T.StructField("passed", T.IntegerType()),
        T.StructField("performance_tier", T.IntegerType()),
        T.StructField("weighted_assessment_score", T.DoubleType()),
    ]
)


def contract_fingerprint() -> str:
    """Hash of the contract; a stored model is refused when it differs."""
    payload = {
        "contract": CONTRACT_VERSION,
        "enrollment_key": KEYS,
        "categorical_features": CATEGORICAL_FEATURES,
        "numeric_features": NUMERIC_FEATURES,
    }
    canonical = json.dumps(payload, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(canonical.encode()).hexdigest()


def require_cutoff(cutoff_day: int) -> int:
    """A cutoff is a plain integer day offset; booleans are not accepted."""
    if type(cutoff_day) is not int:
        raise TypeError(f"cutoff_day must be an integer, got {type(cutoff_day).__name__}")
    return cutoff_day
