"""Role tables stored in buckets of students, so that the mart's joins move no rows.

Enrollments, students, clickstream and submissions are bucketed and sorted by student. Joins
and groupings by student, and by enrollment, which contains the student, then work bucket by
bucket where Spark accepts a layout that is coarser than the join's keys; reading the
tables sets that option on the session.
"""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession

from cohortlens.sources.roles import RoleTables

STUDENT = "id_student"
BUCKETED = ("enrollment", "student", "interaction", "submission")
#: Accept a layout by some of the join's columns as the layout of both sides.
COARSE_LAYOUT = "spark.sql.requireAllClusterKeysForCoPartition"


def _name(prefix: str, role: str) -> str:
    return f"{prefix}_{role}"


def write_bucketed_roles(roles: RoleTables, prefix: str, buckets: int, folder: str | None = None) -> None:
    """Save the roles as tables ``<prefix>_<role>``, below ``folder`` where one is given.

    As many tasks as buckets write a table, so a bucket is one file. Take as many buckets as
    give files of a few hundred megabytes of the largest table.
    """
    for role in fields(RoleTables):
        table: DataFrame = getattr(roles, role.name)
        name = _name(prefix, role.name)
        if role.name in BUCKETED:
            writer = table.repartition(buckets, STUDENT).write.bucketBy(buckets, STUDENT).sortBy(STUDENT)
        else:
            writer = table.write
        if folder:
            writer = writer.option("path", f"{folder}/{name}")
        writer.mode("overwrite").format("parquet").saveAsTable(name)


def read_bucketed_roles(spark: SparkSession, prefix: str) -> RoleTables:
    """The roles saved by ``write_bucketed_roles``."""
    spark.conf.set(COARSE_LAYOUT, "false")
    return RoleTables(**{role.name: spark.table(_name(prefix, role.name)) for role in fields(RoleTables)})
