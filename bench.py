"""Time the headline queries once warm; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortlens.plans.queries import queries  # noqa: E402
from cohortlens.session import local_session, release  # noqa: E402

HEADLINE = (
    "enrollment_mart",
    "activity_features",
    "weighted_score",
    "scoring_frame",
    "numeric_profile",
    "feature_histograms",
    "clicks_boxplot_by_result",
    "risk_by_engagement_quartile",
    "spearman_matrix",
    "temporal_holdout",
    "risk_metrics",
    "capacity_top20",
    "calibration_bins",
    "unseen_fields",
    "knn_score",
    "eda_headlines",
    "champion_candidates",
    "enrollment_mart_cutoffs",
)


def run(spark, query, folder: str) -> float | None:
    """Seconds of one run, or None where it fails: the others are timed all the same."""
    start = time.perf_counter()
    try:
        query(spark, folder).write.format("noop").mode("overwrite").save()
    except Exception as error:
        print(f"{query.__name__}: {str(error)[:2000]}", file=sys.stderr)
        return None
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cores, shuffle_partitions=cores)
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    for name in HEADLINE:
        run(spark, known[name], folder)
    timed = {name: run(spark, known[name], folder) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds for seconds in timed.values() if seconds), 3),
                "unit": "sec",
                "queries": {name: seconds for name, seconds in timed.items() if seconds is not None},
                "failed": [name for name, seconds in timed.items() if seconds is None],
                "sf": Path(folder).name,
                "cpus": cores,
            }
        )
    )
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
