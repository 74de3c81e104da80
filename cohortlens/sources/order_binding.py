"""Cohort roles derived from an order-processing schema.

Customers act as students, the order priority and half-year as course and
presentation, order lines as clickstream and submissions. It lets every operator
run over whole tables for which no enrollment data exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.contract import COURSE_KEYS, DEFAULT_CUTOFF, KEYS
from cohortlens.session import materialize
from cohortlens.sources.roles import RoleTables

HOLDOUT = "2001J"
SEGMENT_ORDER = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
AGE_ORDER = ("0-35", "35-55", "55<=")
ASSESSMENT_WEIGHTS = {"A": 10.0, "N": 30.0, "R": 60.0}
BLANK_LINE = 7


# Stated schemas spare a job per table that would read file footers.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def order_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Each order under the enrollment key it stands for."""
    start = "make_date(year(o_orderdate), IF(month(o_orderdate) <= 6, 1, 7), 1)"
    return _read(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "o_custkey AS id_student",
        "concat('M', substring(o_orderpriority, 1, 1)) AS code_module",
        "concat(year(o_orderdate), IF(month(o_orderdate) <= 6, 'B', 'J')) AS code_presentation",
        f"datediff(to_date(o_orderdate), {start}) - 60 AS date_registration",
    )


def enrollments(orders: DataFrame) -> DataFrame:
    """The earliest order per key, and how many more there were."""
    # A minimum is combined on the map side, so no task sorts all orders of a key.
    order = F.struct("date_registration", "o_orderkey", "o_orderstatus", "o_totalprice")
    return (
        orders.groupBy(*KEYS)
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("orders"))
        .selectExpr(
            *KEYS,
            "first.date_registration",
            "CAST(orders - 1 AS int) AS num_of_prev_attempts",
            "CAST(30 * (1 + first.o_orderkey % 4) AS int) AS studied_credits",
            "CASE WHEN first.o_orderstatus = 'F' THEN 'Fail' "
            "WHEN first.o_orderstatus = 'P' THEN 'Pass' "
            "WHEN first.o_totalprice > 250000 THEN 'Distinction' ELSE 'Withdrawn' END "
            "AS final_result",
        )
    )


def students(spark: SparkSession, folder: str) -> DataFrame:
    people = _read(spark, folder, "customer").join(
        _read(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey")
    )
    return people.join(
        _read(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")
    ).selectExpr(
        "c_custkey AS id_student",
        "IF(c_custkey % 2 = 0, 'F', 'M') AS gender",
        "r_name AS region",
        "c_mktsegment AS highest_education",
        "IF(c_acctbal >= 0, concat(CAST(floor(c_acctbal / 2500) AS int), 'Q'), NULL) AS imd_band",
        "c_custkey % 10 = 0 AS disability",
        "CASE c_custkey % 3 WHEN 0 THEN '0-35' WHEN 1 THEN '35-55' ELSE '55<=' END AS age_band",
    )


def courses(orders: DataFrame) -> DataFrame:
    return orders.select(*COURSE_KEYS).distinct().selectExpr(
        "*", "IF(code_presentation LIKE '%J', 268, 240) AS course_duration_days"
    )


def _lines(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    lines = _read(spark, folder, "lineitem")
    return lines.join(orders, F.expr("l_orderkey = o_orderkey"))


EVENT_DAY = "datediff(to_date(l_shipdate), DATE '1995-01-01') % 270 - 20"


def interactions(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        *KEYS,
        "l_partkey AS id_site",
        f"{EVENT_DAY} AS event_day",
        "CAST(l_quantity AS int) AS clicks",
    )


def assessments(course: DataFrame) -> DataFrame:
    """Three weighted assessments per course, named by return flag."""
    kinds = ", ".join(f"'{flag}', {weight}D" for flag, weight in ASSESSMENT_WEIGHTS.items())
    return course.selectExpr(*COURSE_KEYS, f"explode(map({kinds})) AS (flag, weight)").selectExpr(
        "concat(code_module, code_presentation, flag) AS id_assessment", *COURSE_KEYS, "weight"
    )


def submissions(lines: DataFrame) -> DataFrame:
    unmarked = "l_linestatus = 'F' AND l_tax < 0.02D"
    return lines.selectExpr(
        "concat(code_module, code_presentation, l_returnflag) AS id_assessment",
        "id_student",
        f"IF({unmarked}, NULL, round(l_discount * 1000)) AS score",
    )


def order_roles(spark: SparkSession, folder: str) -> RoleTables:
    """The six roles over the order tables in ``folder``."""
    orders = order_keys(spark, folder)
    lines = _lines(spark, folder, orders)
    course = courses(orders)
    return RoleTables(
        enrollment=enrollments(orders),
        student=students(spark, folder),
        course=course,
        interaction=interactions(lines),
        assessment=assessments(course),
        submission=submissions(lines),
    )


def order_scoring_tables(
    spark: SparkSession, folder: str, cutoff_day: int = DEFAULT_CUTOFF
) -> dict[str, DataFrame]:
    """The four-table scoring source over the order tables, with blank modules.

    Two tables and the clickstream's filter come from the same enrollments, so
    these are written first.
    """
    orders = order_keys(spark, folder)
    enrolled = materialize(enrollments(orders).where(F.col("date_registration") <= cutoff_day))
    people = enrolled.join(students(spark, folder), "id_student")
    lines = _lines(spark, folder, orders).join(enrolled.select(*KEYS), list(KEYS), "left_semi")
    blank = f"l_linenumber = {BLANK_LINE}"
    stray = f"{blank} AND id_student % 97 = 0"
    return {
        "StudentInfo": people.selectExpr(
            "id_student AS guid_student_id",
            *COURSE_KEYS,
            "gender",
            "region",
            "highest_education",
            "imd_band",
            "age_band",
            "num_of_prev_attempts",
            "studied_credits",
            "disability",
            "final_result",
        ),
        "Registration": enrolled.selectExpr(
            "id_student AS guid_studente_id", *COURSE_KEYS, "date_registration"
        ),
        "VLE_clickStream": lines.selectExpr(
            f"IF({stray}, id_student + 10000000, id_student) AS guid_student_id",
            "l_partkey AS guid_site_id",
            f"IF({blank}, NULL, code_module) AS modulo",
            "code_presentation AS presentation",
            f"{EVENT_DAY} AS date",
            "CAST(l_quantity AS int) AS sum_clics",
        ),
        "cursos": courses(orders).selectExpr(
            *COURSE_KEYS, "course_duration_days AS module_presentation_length"
        ),
    }
