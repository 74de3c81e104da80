"""The mart at many cutoff days from one scan of the clickstream.

What changes with the cutoff are sums over days. Events are reduced to days and sites, a site
counts on the first day it is seen on, and running sums over the cutoffs give each its clicks,
days, events and sites.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.contract import ACTIVITY, KEYS, SCORE, require_cutoff
from cohortlens.functions.expressions import passed, performance_tier
from cohortlens.operators.mart import cohort, course_scores
from cohortlens.sources.roles import RoleTables


def _ordered(cutoffs: Sequence[int]) -> list[int]:
    days = sorted({require_cutoff(day) for day in cutoffs})
    if not days:
        raise ValueError("no cutoff day is given")
    return days


def activity_between(
    interaction: DataFrame, cutoffs: Sequence[int], laid_out: bool = False
) -> DataFrame:
    """Activity that each cutoff adds to the one before: per enrollment and ``slot``, the
    cutoff's place, its clicks, days, events and sites not seen earlier.

    Where the clickstream is ``laid_out`` by student (``sources.bucketed``), nothing is moved.
    """
    days = _ordered(cutoffs)
    every = F.array(*[F.lit(day) for day in days])
    slot = F.size(F.filter(every, lambda day: day < F.col("event_day")))
    # A key with very many events is reduced on the map side; what is left of it are at most
    # its days times its sites, and everything below keeps the partitioning by key.
    reduced = (
        interaction.where(F.col("event_day") <= days[-1])
        .groupBy(*KEYS, "event_day", "id_site")
        .agg(F.sum("clicks").alias("clicks"), F.count(F.lit(1)).alias("events"))
    )
    reduced = reduced if laid_out else reduced.repartition(*KEYS)
    site = W.partitionBy(*KEYS, "id_site").orderBy("event_day")
    day = W.partitionBy(*KEYS, "event_day").orderBy("id_site")
    first_seen = reduced.select(
        *KEYS,
        slot.alias("slot"),
        "clicks",
        "events",
        # As in a distinct count, a missing site is none.
        (F.col("id_site").isNotNull() & (F.row_number().over(site) == 1)).cast("int").alias("new_site"),
        (F.row_number().over(day) == 1).cast("int").alias("new_day"),
    )
    return first_seen.groupBy(*KEYS, "slot").agg(
        F.sum("clicks").alias("total_clicks"),
        F.sum("new_day").alias("active_days"),
        F.sum("events").alias("vle_events"),
        F.sum("new_site").alias("vle_sites"),
    )


def enrollment_marts(
    roles: RoleTables, cutoffs: Sequence[int], laid_out: bool = False
) -> DataFrame:
    """``cutoff_day`` and the mart's columns: the rows of the mart at each cutoff.

    Every source is read once, however many cutoffs there are. Over tables ``laid_out`` by
    student only courses and assessments, the small tables, are sent around.
    """
    days = _ordered(cutoffs)
    rows = cohort(roles, days[-1])
    result = F.col("final_result")
    added = activity_between(roles.interaction, days, laid_out)
    # One row per key, with its sums up to each cutoff: the wide cohort rows are copied for the
    # cutoffs after all joins, as no copy has to move then.
    until = added.groupBy(*KEYS).agg(
        *[
            F.sum(F.when(F.col("slot") <= at, F.col(name))).alias(f"_{name}_{at}")
            for at in range(len(days))
            for name in ACTIVITY
        ]
    )
    with_scores = rows.join(course_scores(roles.assessment, roles.submission), list(KEYS), "left")
    places = F.array(
        *[
            F.struct(
                F.lit(day).alias("day"),
                *[F.coalesce(F.col(f"_{name}_{at}"), F.lit(0)).alias(name) for name in ACTIVITY],
            )
            for at, day in enumerate(days)
        ]
    )
    joined = with_scores.join(until, list(KEYS), "left").withColumn("_place", F.explode(places))
    summed = joined.withColumns({name: F.col(f"_place.{name}") for name in ACTIVITY})
    # An enrollment is in the mart of a cutoff from its registration on.
    return summed.where(F.col("date_registration") <= F.col("_place.day")).select(
        F.col("_place.day").alias("cutoff_day"),
        *[F.col(name) for name in rows.columns if name != "final_result"],
        *ACTIVITY,
        (F.col("vle_events") > 0).cast("int").alias("has_vle_activity"),
        result,
        passed(result).alias("passed"),
        performance_tier(result).alias("performance_tier"),
        F.col(SCORE),
    )
