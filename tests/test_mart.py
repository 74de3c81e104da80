from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortlens.contract import KEYS, MART_SCHEMA, TARGETS
from cohortlens.operators import checks, cutoffs, mart
from cohortlens.sinks import tables as sinks
from cohortlens.sources import files, roles
from cohortlens.sources.order_binding import order_roles

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def source(spark):
    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "estudiante": table(
            [(i, "F", "North", "Bachelor", None, False, "0-35", "0-35") for i in (1, 2, 3)],
            "id_estudiante int, genero string, region string, nivel_educativo string, imd_band string,"
            "tiene_discapacidad boolean, grupo_edad_inicio string, grupo_edad_final string",
        ),
        "curso": table([("AAA", "2013J", 100)], "cd_curso string, cd_semestre string, duracion_dias int"),
        "estudiante_curso": table(
            [("AAA", "2013J", i, day, None, 0, 60, "Pass") for i, day in ((1, -10), (2, 31), (3, None))],
            "cd_curso string, cd_semestre string, id_estudiante int, fecha_registro_dias int,"
            "fecha_retiro_dias int, cant_intentos int, cant_creditos int, resultado_final string",
        ),
        "estudiante_recurso": table(
            [("AAA", "2013J", 1, 7, 5, 4), ("AAA", "2013J", 1, 8, 31, 99)],
            "cd_curso string, cd_semestre string, id_estudiante int, id_recurso int,"
            "fecha_interaccion int, cant_clicks int",
        ),
        "asignaciones": table(
            [(1, "AAA", "2013J", "TMA", 20, Decimal("100.00"))],
            "id_asignacion int, cd_curso string, cd_semestre string, tipo_asignacion string,"
            "fecha_limite_dias int, peso_evaluacion decimal(5,2)",
        ),
        "asignacion_estudiante": table(
            [(1, 1, 19, False, Decimal("70.00"))],
            "id_asignacion int, id_estudiante int, dia_entrega int, is_banked boolean, puntuacion decimal(5,2)",
        ),
    }


def test_mart_drops_late_and_unknown_registrations_and_later_events(source):
    rows = mart.enrollment_mart(roles.canonical_roles(source), 30).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.id_student, row.total_clicks, row.active_days, row.vle_events, row.vle_sites) == (
        1, 4, 1, 1, 1,
    )
    assert (row.has_vle_activity, row.final_result, row.passed, row.performance_tier) == (1, "Pass", 1, 2)
    assert row.weighted_assessment_score == 70.0


def test_mart_columns_match_the_written_schema(source):
    df = mart.enrollment_mart(roles.canonical_roles(source), 30)
    assert df.columns == MART_SCHEMA.names


def test_roles_read_from_parquet(spark, source, tmp_path):
    for name, table in source.items():
        table.write.parquet(f"{tmp_path}/{name}")
    got = mart.enrollment_mart(roles.read_parquet_roles(spark, str(tmp_path)), 31)
    assert {r.id_student: r.total_clicks for r in got.collect()} == {1: 103, 2: 0}


def test_score_weights_and_zero_weight(spark):
    submission = spark.createDataFrame(
        [("a", 1, 50.0), ("b", 1, 80.0), ("c", 1, None), ("z", 2, 90.0)],
        "id_assessment string, id_student int, score double",
    )
    assessment = spark.createDataFrame(
        [("a", "M", "P", 10.0), ("b", "M", "P", 30.0), ("c", "M", "P", 60.0), ("z", "M", "P", 0.0)],
        "id_assessment string, code_module string, code_presentation string, weight double",
    )
    got = {r.id_student: r.weighted_assessment_score for r in mart.course_scores(assessment, submission).collect()}
    assert got == {1: pytest.approx(72.5), 2: None}


def test_unknown_result_has_no_tier(spark):
    df = spark.createDataFrame(
        [(1, "M", "P", "Deferred"), (2, "M", "P", None), (3, "M", "P", "distinction")],
        "id_student int, code_module string, code_presentation string, final_result string",
    )
    got = {r.id_student: (r.passed, r.performance_tier) for r in mart.outcome_codes(df).collect()}
    assert got == {1: (0, None), 2: (0, None), 3: (1, 3)}


def test_larger_cutoff_never_lowers_clicks(spark):
    bound = order_roles(spark, SF)
    early = mart.activity_features(bound.interaction, 10).select(*KEYS, F.col("total_clicks").alias("a"))
    late = mart.activity_features(bound.interaction, 60).select(*KEYS, F.col("total_clicks").alias("b"))
    joined = early.join(late, list(KEYS), "left")
    assert joined.where("b is null or b < a").count() == 0


@pytest.mark.parametrize("cutoff", [True, 30.0, "30", None])
def test_cutoff_must_be_an_integer(source, cutoff):
    with pytest.raises(TypeError):
        mart.enrollment_mart(roles.canonical_roles(source), cutoff)


def test_cutoff_filter_reaches_the_scan(spark, source, tmp_path, capsys):
    source["estudiante_recurso"].write.parquet(f"{tmp_path}/events")
    stored = roles.rename(
        spark.read.parquet(f"{tmp_path}/events"), roles.SOURCE_COLUMNS["interaction"]
    )
    mart.activity_features(stored, 30).explain("formatted")
    plan = capsys.readouterr().out
    assert "LessThanOrEqual(fecha_interaccion,30)" in plan


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_artifacts_split_keys_features_and_targets(spark, mart8, tmp_path, file_format):
    moment = datetime(2024, 1, 2, 3, 4, tzinfo=timezone.utc)
    paths = sinks.write_artifacts(
        mart8.orderBy(F.col("id_student").desc()), str(tmp_path), 30, file_format, moment
    )
    full = (files.read_mart_csv if file_format == "csv" else files.read_mart)(spark, paths["full"])
    assert [r.id_student for r in full.collect()] == list(range(1, 9))
    assert sorted(map(str, full.collect())) == sorted(map(str, mart8.collect()))
    reader = spark.read.option("header", True)
    features = reader.format(file_format).load(paths["features"])
    targets = reader.format(file_format).load(paths["targets"])
    assert not set(features.columns) & set(TARGETS)
    assert targets.columns == [*KEYS, *TARGETS]
    meta = spark.read.json(paths["metadata"]).first()
    assert (meta.row_count, meta.feature_column_count, meta.target_column_count) == (8, 15, 4)
    assert meta.generated_at == "2024-01-02T03:04:00+00:00"
    assert files.read_cutoff(spark, paths["metadata"]) == 30


@pytest.mark.parametrize("value", ["true", "30.5", '"30"', "null"])
def test_metadata_without_integer_cutoff_is_refused(spark, tmp_path, value):
    path = tmp_path / "meta.json"
    path.write_text('{"cutoff_day": %s}' % value)
    with pytest.raises(ValueError, match="whole number as cutoff_day"):
        files.read_cutoff(spark, str(path))


def test_csv_header_in_another_order_is_refused(spark, tmp_path):
    path = tmp_path / "mart.csv"
    names = MART_SCHEMA.names
    path.write_text(",".join([names[1], names[0], *names[2:]]) + "\n")
    with pytest.raises(Exception, match="CSV header does not conform|header"):
        files.read_mart_csv(spark, str(path)).collect()


def test_artifacts_refuse_duplicate_keys_and_banned_columns(mart8, tmp_path):
    with pytest.raises(checks.CheckError, match="duplicate_keys"):
        sinks.write_artifacts(mart8.union(mart8.limit(1)), str(tmp_path), 30)
    with pytest.raises(checks.CheckError, match="must not contain"):
        sinks.write_artifacts(mart8.withColumn("Kongo_score", F.lit(1)), str(tmp_path), 30)


def test_submissions_move_by_enrollment_only(spark, tmp_path):
    """No exchange stands between the submissions and the sums per enrollment."""
    spark.createDataFrame([("a1", 1, 50.0), ("a1", 1, None), ("a2", 1, 80.0)], "id_assessment string, id_student int, score double").write.parquet(str(tmp_path / "submission"))
    spark.createDataFrame([("a1", "M", "2001B", 10.0), ("a2", "M", "2001B", 30.0)], "id_assessment string, code_module string, code_presentation string, weight double").write.parquet(str(tmp_path / "assessment"))
    submission, assessment = (spark.read.parquet(str(tmp_path / name)) for name in ("submission", "assessment"))
    # As where the size of a derived table is not known before it is computed.
    assessment = assessment.groupBy("id_assessment", "code_module", "code_presentation").agg({"weight": "max"}).withColumnRenamed("max(weight)", "weight")
    scores = mart.course_scores(assessment, submission)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = scores._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert [tuple(row) for row in scores.collect()] == [(1, "M", "2001B", 72.5)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cohort_rows_are_copied_for_cutoffs_after_the_last_exchange(spark):
    plan = cutoffs.enrollment_marts(order_roles(spark, "/root/testdata/sf0.001"), (0, 30, 60))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Generate explode")] and "Join" not in plan[: plan.index("Generate explode")]
