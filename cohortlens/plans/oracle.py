"""The same results in DuckDB SQL over the raw tables."""

from __future__ import annotations

from itertools import combinations

from cohortlens.contract import FEATURES, MART_SCHEMA, NUMERIC_FEATURES

KEY = "id_student, code_module, code_presentation"
HOLDOUT = "'2001J'"

BINDING = """
ord AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, o_custkey AS id_student,
         'M' || substr(o_orderpriority, 1, 1) AS code_module,
         CAST(year(o_orderdate) AS VARCHAR) || CASE WHEN month(o_orderdate) <= 6 THEN 'B' ELSE 'J' END
           AS code_presentation,
         CAST(datediff('day', make_date(year(o_orderdate), CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 7 END, 1),
              CAST(o_orderdate AS DATE)) - 60 AS INTEGER) AS date_registration
  FROM orders),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY id_student, code_module, code_presentation
                               ORDER BY date_registration, o_orderkey) AS place,
         count(*) OVER (PARTITION BY id_student, code_module, code_presentation) AS orders_of_key
  FROM ord),
enrollment AS (
  SELECT id_student, code_module, code_presentation, date_registration,
         CAST(orders_of_key - 1 AS INTEGER) AS num_of_prev_attempts,
         CAST(30 * (1 + o_orderkey % 4) AS INTEGER) AS studied_credits,
         CASE o_orderstatus WHEN 'F' THEN 'Fail' WHEN 'P' THEN 'Pass'
              ELSE CASE WHEN o_totalprice > 250000 THEN 'Distinction' ELSE 'Withdrawn' END END AS final_result
  FROM numbered WHERE place = 1),
student AS (
  SELECT c_custkey AS id_student, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         r_name AS region, c_mktsegment AS highest_education,
         CASE WHEN c_acctbal < 0 THEN NULL
              ELSE CAST(CAST(floor(c_acctbal / 2500) AS INTEGER) AS VARCHAR) || 'Q' END AS imd_band,
         c_custkey % 10 = 0 AS disability,
         CASE c_custkey % 3 WHEN 0 THEN '0-35' WHEN 1 THEN '35-55' ELSE '55<=' END AS age_band
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
course AS (
  SELECT DISTINCT code_module, code_presentation,
         CASE WHEN code_presentation LIKE '%J' THEN 268 ELSE 240 END AS course_duration_days
  FROM ord),
line AS (SELECT * FROM lineitem JOIN ord ON l_orderkey = o_orderkey),
interaction AS (
  SELECT id_student, code_module, code_presentation, l_partkey AS id_site, l_linenumber,
         CAST(datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 270 - 20 AS INTEGER) AS event_day,
         CAST(l_quantity AS INTEGER) AS clicks
  FROM line),
assessment AS (
  SELECT DISTINCT code_module || code_presentation || l_returnflag AS id_assessment, code_module, code_presentation,
         CASE l_returnflag WHEN 'A' THEN 10.0 WHEN 'N' THEN 30.0 WHEN 'R' THEN 60.0 END AS weight
  FROM line),
submission AS (
  SELECT code_module || code_presentation || l_returnflag AS id_assessment, id_student,
         CASE WHEN l_linestatus = 'F' AND l_tax < 0.02 THEN NULL ELSE round(l_discount * 1000) END AS score
  FROM line)"""

# The mart from its meaning: one list of events and one of marks per key, reduced by list
# functions, and a table that spells out what a result stands for.
MART = """
meaning(final_result, passed, performance_tier, academic_risk) AS (
  VALUES ('Distinction', 1, 3, 0), ('Pass', 1, 2, 0), ('Withdrawn', 0, 1, 1), ('Fail', 0, 0, 1)),
outcome AS (
  SELECT id_student, code_module, code_presentation, final_result, passed, performance_tier
  FROM enrollment LEFT JOIN meaning USING (final_result)),
seen AS (
  SELECT id_student, code_module, code_presentation,
         list({d: event_day, s: id_site, c: clicks}) FILTER (event_day <= 30) AS events
  FROM interaction GROUP BY 1, 2, 3),
activity AS (
  SELECT id_student, code_module, code_presentation,
         CAST(list_sum([e.c FOR e IN events]) AS BIGINT) AS total_clicks,
         CAST(len(list_distinct([e.d FOR e IN events])) AS BIGINT) AS active_days,
         CAST(len(events) AS BIGINT) AS vle_events,
         CAST(len(list_distinct([e.s FOR e IN events])) AS BIGINT) AS vle_sites
  FROM seen WHERE events IS NOT NULL),
mark AS (
  SELECT s.id_student, a.code_module, a.code_presentation, a.weight::DOUBLE AS weight, s.score::DOUBLE AS score
  FROM submission s, assessment a WHERE s.id_assessment = a.id_assessment AND s.score IS NOT NULL),
score AS (
  SELECT id_student, code_module, code_presentation,
         sum(weight * score) / nullif(sum(weight), 0) AS weighted_assessment_score
  FROM mark SEMI JOIN enrollment USING (id_student, code_module, code_presentation) GROUP BY 1, 2, 3),
cohort AS (
  SELECT id_student, code_module, code_presentation, gender, region, highest_education, imd_band, disability,
         age_band, num_of_prev_attempts, studied_credits, date_registration, course_duration_days
  FROM course NATURAL JOIN enrollment NATURAL JOIN student WHERE NOT (date_registration > 30)),
mart AS MATERIALIZED (
  SELECT c.*, ifnull(a.total_clicks, 0) AS total_clicks, ifnull(a.active_days, 0) AS active_days,
         ifnull(a.vle_events, 0) AS vle_events, ifnull(a.vle_sites, 0) AS vle_sites,
         CAST(a.vle_events IS NOT NULL AS INTEGER) AS has_vle_activity,
         m.final_result, m.passed, m.performance_tier, s.weighted_assessment_score, m.academic_risk
  FROM cohort c
  NATURAL JOIN (SELECT id_student, code_module, code_presentation, final_result FROM enrollment) r
  JOIN meaning m ON m.final_result = r.final_result
  LEFT JOIN activity a USING (id_student, code_module, code_presentation)
  LEFT JOIN score s USING (id_student, code_module, code_presentation))"""

SCORED = """
scored AS MATERIALIZED (
  SELECT id_student, code_module, code_presentation, academic_risk AS y, performance_tier, weighted_assessment_score,
         round(1 / (1 + exp(-(0.2 - 0.01 * total_clicks + 0.15 * num_of_prev_attempts))), 6)::DOUBLE AS p
  FROM mart),
thresholds AS (
  SELECT p, count(*) AS n, CAST(sum(y) AS BIGINT) AS pos FROM scored GROUP BY p),
curve AS (
  SELECT p, n, pos, CAST(sum(n) OVER (ORDER BY p DESC) AS BIGINT) AS flagged,
         CAST(sum(pos) OVER (ORDER BY p DESC) AS BIGINT) AS hits, CAST(sum(pos) OVER () AS BIGINT) AS all_pos
  FROM thresholds),
ranked AS (
  SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r FROM scored),
auc AS (
  SELECT (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE)
         / (CAST(sum(y) AS DOUBLE) * CAST(count(*) - sum(y) AS DOUBLE)) AS roc_auc
  FROM ranked),
risk_row AS (
  SELECT (SELECT sum(CAST(pos AS DOUBLE) / all_pos * hits / flagged) FROM curve) AS pr_auc,
         (SELECT roc_auc FROM auc) AS roc_auc,
         avg((p - y) * (p - y)) AS brier_score,
         CAST(count(*) FILTER (p >= 0.5 AND y = 1) AS DOUBLE) / count(*) FILTER (p >= 0.5) AS precision_at_0_5,
         CAST(count(*) FILTER (p >= 0.5 AND y = 1) AS DOUBLE) / sum(y) AS recall_at_0_5
  FROM scored),
picked AS (
  SELECT y, row_number() OVER (ORDER BY p DESC, id_student, code_module, code_presentation) AS r,
         count(*) OVER () AS n FROM scored),
capacity AS (
  SELECT max(greatest(1, CAST(floor(n * 0.2::DOUBLE) AS BIGINT))) AS selected_rows,
         CAST(sum(y) FILTER (r <= greatest(1, floor(n * 0.2::DOUBLE))) AS DOUBLE) AS hit, sum(y) AS all_y FROM picked),
edges AS (
  SELECT quantile_cont(p, 0.2) AS e1, quantile_cont(p, 0.4) AS e2, quantile_cont(p, 0.6) AS e3,
         quantile_cont(p, 0.8) AS e4 FROM scored),
binned AS (
  SELECT (p > e1)::INT + (p > e2)::INT + (p > e3)::INT + (p > e4)::INT AS edge, count(*) AS bin_rows,
         avg(p) AS mean_predicted_risk, avg(y) AS observed_risk
  FROM scored, edges GROUP BY 1),
bins AS (
  SELECT CAST(row_number() OVER (ORDER BY edge) AS INTEGER) AS bin, mean_predicted_risk, observed_risk, bin_rows,
         count(*) OVER () AS q
  FROM binned),
equal_bins AS (
  SELECT greatest(1, ((r - 1) * (SELECT max(q) FROM bins) + n - 2) // (n - 1)) AS bin, count(*) AS rows
  FROM picked GROUP BY 1)"""

DRIFT = f"""
drifted AS MATERIALIZED (
  SELECT * REPLACE (
    CASE WHEN id_student % 50 = 0 THEN 'UNKNOWN' ELSE highest_education END AS highest_education,
    CASE WHEN id_student % 40 = 0 THEN NULL ELSE age_band END AS age_band,
    CASE WHEN id_student % 4 = 0 THEN NULL ELSE studied_credits END AS studied_credits) FROM mart),
training AS (SELECT * FROM mart WHERE code_presentation <> {HOLDOUT}),
flagged AS (
  SELECT id_student, code_module, code_presentation,
    CASE WHEN highest_education IN (SELECT highest_education FROM training) THEN 0 ELSE 1 END AS u1,
    CASE WHEN age_band IS NOT NULL AND age_band IN (SELECT age_band FROM training) THEN 0 ELSE 1 END AS u2,
    CASE WHEN code_module IN (SELECT code_module FROM training) THEN 0 ELSE 1 END AS u3,
    CASE WHEN code_presentation IN (SELECT code_presentation FROM training) THEN 0 ELSE 1 END AS u4
  FROM drifted),
unseen AS (
  SELECT id_student, code_module, code_presentation,
    CASE WHEN u1 + u2 = 2 THEN 'highest_education;age_band' WHEN u1 = 1 THEN 'highest_education'
         WHEN u2 = 1 THEN 'age_band' ELSE 'none' END AS oov_categorical_fields,
    CASE WHEN u3 + u4 = 2 THEN 'code_module;code_presentation' WHEN u3 = 1 THEN 'code_module'
         WHEN u4 = 1 THEN 'code_presentation' ELSE 'none' END AS oov_key_fields
  FROM flagged)"""

SPLIT = f"""
held AS (SELECT DISTINCT id_student FROM mart WHERE code_presentation = {HOLDOUT}),
parts AS (
  SELECT *, CASE WHEN code_presentation = {HOLDOUT} THEN 'holdout'
                 WHEN id_student IN (SELECT id_student FROM held) THEN 'overlap' ELSE 'development' END AS part
  FROM mart)"""

SOURCE = """
early AS (SELECT * FROM enrollment WHERE date_registration <= 30),
stream AS (
  SELECT CASE WHEN l_linenumber = 7 AND id_student % 97 = 0 THEN id_student + 10000000 ELSE id_student END AS id_student,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE code_module END AS code_module, code_presentation,
         id_site, event_day, clicks
  FROM interaction SEMI JOIN early USING (id_student, code_module, code_presentation)
  WHERE event_day <= 30),
modules AS (
  SELECT id_student, code_presentation, count(*) AS candidates, min(code_module) AS only_module
  FROM early GROUP BY ALL),
resolved AS (
  SELECT s.id_student, coalesce(s.code_module, CASE WHEN candidates = 1 THEN only_module END) AS code_module,
         s.code_presentation, id_site, event_day, clicks,
         CASE WHEN s.code_module IS NOT NULL THEN 'with_module' WHEN candidates IS NULL THEN 'no_candidate'
              WHEN candidates = 1 THEN 'resolved' ELSE 'ambiguous' END AS reason
  FROM stream s LEFT JOIN modules USING (id_student, code_presentation)),
resolved_activity AS (
  SELECT id_student, code_module, code_presentation, CAST(sum(clicks) AS BIGINT) AS total_clicks,
         count(DISTINCT event_day) AS active_days, count(*) AS vle_events, count(DISTINCT id_site) AS vle_sites
  FROM resolved WHERE code_module IS NOT NULL GROUP BY ALL)"""


def _with(select: str, *parts: str) -> str:
    return "WITH " + ",".join([BINDING, *parts]) + "\n" + select


def _rounded(columns: list[str]) -> str:
    doubles = {field.name for field in MART_SCHEMA if field.dataType.typeName() == "double"}
    return ", ".join(f"round({name}, 6) AS {name}" if name in doubles else name for name in columns)


def _mart(select: str, *more: str) -> str:
    return _with(select, MART, *more)


def _scored(select: str) -> str:
    return _mart(select, SCORED)


MART_COLUMNS = MART_SCHEMA.names
TARGETS = MART_COLUMNS[-4:]
NUMERIC = list(NUMERIC_FEATURES)
CANDIDATE_CATEGORIES = {
    "region": "region",
    "imd_band": "coalesce(imd_band, 'Sin dato')",
    "disability": "CASE WHEN disability THEN 'True' ELSE 'False' END",
}


def _stack(columns: dict[str, str], name: str, value: str, source: str = "mart", extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS {name}, {expression} AS {value}{extra} FROM {source}"
        for label, expression in columns.items()
    )


def _long_numeric() -> str:
    return "long AS (" + _stack(
        {name: f"CAST({name} AS DOUBLE)" for name in NUMERIC}, "feature", "v"
    ) + ")"


def _profile_counts(columns: dict[str, str], name: str) -> str:
    return _mart(
        f'SELECT "{name}", category, count(*) AS "count", '
        "round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM mart), 6) AS share FROM long GROUP BY ALL",
        "long AS (" + _stack(columns, f'"{name}"', "category") + ")",
    )


def _null_counts(columns: list[str], source: str, name: str, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{column}' AS {name}, count(*) FILTER ({column} IS NULL) AS {value} FROM {source}"
        for column in columns
    )


def _histogram(features: list[str], bins: str) -> str:
    long = "long AS (" + _stack(
        {name: f"CAST({name} AS DOUBLE)" for name in features}, "feature", "v"
    ) + ")"
    return long + f""",
span AS (
  SELECT feature, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END::DOUBLE AS lo,
         CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END::DOUBLE AS hi,
         CAST({bins} AS INTEGER) AS bins, count(*) FILTER (v = 0) AS zero_count
  FROM long WHERE v IS NOT NULL GROUP BY feature),
slots AS (SELECT feature, lo, hi, bins, zero_count, unnest(range(bins)) AS bin FROM span),
hit AS (
  SELECT feature, least(CAST(floor((v - lo) * bins / (hi - lo)) AS BIGINT), bins - 1) AS bin, count(*) AS n
  FROM long JOIN span USING (feature) WHERE v IS NOT NULL GROUP BY ALL)"""


HISTOGRAM_COLUMNS = (
    "CAST(bin AS INTEGER) AS bin, round(lo + bin * ((hi - lo) / bins), 6) AS lower, "
    'round(lo + (bin + 1) * ((hi - lo) / bins), 6) AS upper, coalesce(n, 0) AS "count"'
)


def _box(groups: str, value: str, source: str) -> str:
    return f"""
box AS (
  SELECT {groups}, median({value})::DOUBLE AS median, quantile_cont({value}, 0.25)::DOUBLE AS q1,
         quantile_cont({value}, 0.75)::DOUBLE AS q3, count({value}) AS observed,
         count(*) FILTER ({value} IS NULL) AS missing, min({value})::DOUBLE AS lo, max({value})::DOUBLE AS hi
  FROM {source} GROUP BY ALL),
fences AS (
  SELECT {groups}, min({value}) FILTER ({value} >= q1 - 1.5 * (q3 - q1))::DOUBLE AS lower_whisker,
         max({value}) FILTER ({value} <= q3 + 1.5 * (q3 - q1))::DOUBLE AS upper_whisker
  FROM {source} JOIN box USING ({groups}) GROUP BY ALL)"""


BOX_COLUMNS = (
    "round(median, 6) AS median, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, "
    'round(lo, 6) AS "min", round(hi, 6) AS "max", round(lower_whisker, 6) AS lower_whisker, '
    "round(upper_whisker, 6) AS upper_whisker"
)

QUARTILED = """
quartiled AS (
  SELECT *, 'Q' || CAST(greatest(1, ((r - 1) * 4 + n - 2) // (n - 1)) AS VARCHAR) AS engagement_quantile
  FROM (SELECT *, row_number() OVER (ORDER BY total_clicks, id_student, code_module, code_presentation) AS r,
               count(*) OVER () AS n FROM mart)),
by_quartile AS (
  SELECT engagement_quantile, count(*) AS n_total, CAST(sum(academic_risk) AS BIGINT) AS n_academic_risk,
         round(avg(academic_risk), 6) AS academic_risk_rate FROM quartiled GROUP BY 1)"""

BY_COURSE = """
by_course AS (
  SELECT code_module || ' ' || code_presentation AS label, code_module, code_presentation, count(*) AS n_total,
         CAST(sum(academic_risk) AS BIGINT) AS n_academic_risk,
         CASE WHEN count(*) >= 30 THEN round(avg(academic_risk), 6) END AS academic_risk_rate,
         count(*) < 30 AS suppressed FROM mart GROUP BY code_module, code_presentation)"""


def _ranks() -> str:
    columns = ", ".join(
        f"rank() OVER (ORDER BY {name}) + (count(*) OVER (PARTITION BY {name}) - 1) / 2.0::DOUBLE AS r_{name}"
        for name in NUMERIC
    )
    return f"ranks AS (SELECT {columns} FROM mart)"


def _corr(left: str, right: str) -> str:
    value = f"corr(r_{left}, r_{right})"
    return f"CASE WHEN isnan({value}) THEN NULL ELSE {value} END"


def _pairs() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{left}' AS feature_a, '{right}' AS feature_b, {_corr(left, right)} AS rho FROM ranks"
        for left, right in combinations(NUMERIC, 2)
    )
    return _ranks() + f", pairs AS ({rows})"


def _macro(actual: str, predicted: str, rows: str) -> str:
    return f"""
cells AS (SELECT {actual} AS a, {predicted} AS b, count(*) AS n FROM {rows} GROUP BY ALL),
classes AS (SELECT a AS c FROM cells UNION SELECT b FROM cells),
per_class AS (
  SELECT c, coalesce(sum(n) FILTER (a = c), 0)::DOUBLE AS actual, coalesce(sum(n) FILTER (b = c), 0)::DOUBLE AS predicted,
         coalesce(sum(n) FILTER (a = c AND b = c), 0)::DOUBLE AS hits
  FROM classes, cells GROUP BY c)"""


def _placed(rows: str) -> str:
    """Students in the order of their ids' md5 sums."""
    return (
        "placed AS (SELECT id_student, row_number() OVER (ORDER BY md5(CAST(id_student AS VARCHAR)), id_student) "
        f"AS place, count(*) OVER () AS students FROM (SELECT DISTINCT id_student FROM {rows}))"
    )


def _tested(target: str) -> tuple[str, str]:
    """Rows with the target, and which of them are held out."""
    marked = f"mart WHERE {target} IS NOT NULL"
    return (
        _placed(marked),
        "marked AS (SELECT *, place <= ceil(students / 4.0) AS held FROM mart JOIN placed USING (id_student) "
        f"WHERE {target} IS NOT NULL)",
    )


RATE = "SELECT avg(academic_risk) AS rate FROM parts WHERE part = 'development'"
LEGACY = {
    "binary": ("passed", "'LogisticRegression', 'RandomForest', 'GradientBoosting'"),
    "ordinal": ("performance_tier", "'DecisionTree', 'RandomForest', 'GradientBoosting'"),
    "regression": ("weighted_assessment_score", "'LinearRegression', 'RandomForestRegressor', 'KNN'"),
}
GUESS = "guessed AS (SELECT *, CAST(floor(p * 100) AS INTEGER) % 4 AS guess FROM scored)"


MODEL_CHECKS = (
    "(VALUES ('LogisticRegression', 'probability_is_the_formula'), "
    "('LogisticRegression', 'loss_is_flat'), ('DecisionTreeClassifier', 'leaves_hold_50_rows'), "
    "('DecisionTreeClassifier', 'probability_is_the_leaf_rate'), "
    "('DecisionTreeClassifier', 'depth_is_at_most_4'), "
    "('DecisionTreeClassifier', 'importances_sum_to_1')) AS told(model, check_name)"
)


def oracle_sql() -> dict[str, str]:
    profile_columns = {
        "code_module": "code_module",
        "code_presentation": "code_presentation",
        "gender": "gender",
        "age_band": "age_band",
        "imd_band": "coalesce(imd_band, 'Sin dato')",
    }
    sql = {
        "enrollment_mart": _mart(f"SELECT {_rounded(MART_COLUMNS)} FROM mart"),
        "enrollment_mart_cutoffs": " UNION ALL ".join(
            f"SELECT CAST({day} AS INTEGER) AS cutoff_day, * FROM ("
            + _mart(f"SELECT {_rounded(MART_COLUMNS)} FROM mart")
            .replace("event_day <= 30", f"event_day <= {day}")
            .replace("date_registration > 30", f"date_registration > {day}")
            + ")"
            for day in (0, 30, 60)
        ),
        "enrollment_mart_filtered": _mart(f"SELECT {_rounded(MART_COLUMNS)} FROM mart"),
        "enrollment_mart_bucketed": _mart(f"SELECT {_rounded(MART_COLUMNS)} FROM mart"),
        "sketched_percentiles": _mart(
            "SELECT presentation, feature, percentile, true AS within_error FROM "
            "(SELECT DISTINCT code_presentation AS presentation FROM mart UNION ALL SELECT 'all'), "
            "(SELECT unnest([" + ", ".join(f"'{name}'" for name in NUMERIC_FEATURES) + "]) AS feature), "
            "(SELECT unnest(['q1', 'median', 'q3']) AS percentile)"
        ),
        "sketched_distinct": _mart(
            "SELECT presentation, field, true AS within_error, true AS parts_equal_whole FROM "
            "(SELECT DISTINCT code_presentation AS presentation FROM mart UNION ALL SELECT 'all'), "
            "(SELECT unnest(['id_student', 'code_module', 'region', 'total_clicks']) AS field)"
        ),
        "cohort_filter": _mart("SELECT * FROM cohort"),
        "activity_features": _mart("SELECT * FROM activity"),
        "weighted_score": _mart(
            f"SELECT {KEY}, round(weighted_assessment_score, 6) AS weighted_assessment_score FROM score"
        ),
        "outcome_codes": _mart("SELECT * FROM outcome"),
        "artifact_features": _mart(f"SELECT {_rounded(MART_COLUMNS[:-4])} FROM mart"),
        "artifact_targets": _mart(f"SELECT {_rounded([*MART_COLUMNS[:3], *TARGETS])} FROM mart"),
        "artifact_metadata": _mart(
            "SELECT 2 AS artifact_version, 30 AS cutoff_day, count(*) AS row_count, "
            "15 AS feature_column_count, 4 AS target_column_count, 'training_full' AS full_table, "
            "'features' AS features_table, 'targets' AS targets_table FROM mart"
        ),
        "contract_features": _mart(f"SELECT {KEY}, {', '.join(FEATURES)} FROM mart"),
        "check_completeness": _mart(
            _null_counts(
                [*MART_COLUMNS[:3], "imd_band", "weighted_assessment_score"], "mart", "check_name", "violations"
            )
        ),
        "check_duplicate_keys": _with(
            f"SELECT 'orders' AS check_name, count(*) - count(DISTINCT ({KEY})) AS violations FROM ord "
            f"UNION ALL SELECT 'enrollment', count(*) - count(DISTINCT ({KEY})) FROM enrollment"
        ),
        "check_ranges": _with(
            "SELECT 'negative_clicks' AS check_name, count(*) FILTER (clicks < 0) AS violations FROM interaction "
            "UNION ALL SELECT 'event_after_cutoff', count(*) FILTER (event_day > 30) FROM interaction "
            "UNION ALL SELECT 'non_positive_duration', count(*) FILTER (course_duration_days <= 0) FROM course "
            "UNION ALL SELECT 'starts_after_cutoff', count(*) FILTER (date_registration > 30) FROM enrollment"
        ),
        "check_result_domain": _with(
            "SELECT 'missing' AS check_name, count(*) FILTER (id_student % 50 = 0) AS violations FROM enrollment "
            "UNION ALL SELECT 'unexpected', count(*) FILTER (id_student % 15 = 0 AND id_student % 50 <> 0) "
            "FROM enrollment"
        ),
        "check_all_null": _mart(
            " UNION ALL ".join(
                f"SELECT '{name}' AS check_name, CAST(count({value}) = 0 AS BIGINT) AS violations FROM mart"
                for name, value in {
                    **{name: name for name in NUMERIC}, "studied_credits": "CAST(NULL AS INTEGER)"
                }.items()
            )
        ),
        "check_coverage": _with(
            "SELECT 'only_left' AS check_name, count(*) FILTER (id_student % 60 <> 0 AND id_student % 70 = 0) "
            "AS violations FROM enrollment UNION ALL "
            "SELECT 'only_right', count(*) FILTER (id_student % 60 = 0 AND id_student % 70 <> 0) FROM enrollment"
        ),
        "check_orphan_activity": _with(
            f"SELECT 'activity_without_enrollment' AS check_name, count(*) AS violations FROM "
            f"(SELECT DISTINCT {KEY} FROM interaction EXCEPT SELECT {KEY} FROM enrollment WHERE date_registration <= 30)"
        ),
        "check_classes_present": _mart(
            "SELECT part AS check_name, CAST(count(DISTINCT academic_risk) < 2 AS BIGINT) AS violations "
            "FROM parts GROUP BY part",
            SPLIT,
        ),
        "coerce_numeric": _with(
            f"SELECT {KEY}, CASE WHEN id_student % 7 = 0 OR id_student % 11 = 0 THEN NULL "
            "WHEN id_student % 5 = 0 THEN studied_credits + 0.5::DOUBLE ELSE studied_credits::DOUBLE END "
            "AS studied_credits, CASE WHEN id_student % 3 <> 0 THEN date_registration::DOUBLE END "
            "AS date_registration FROM enrollment"
        ),
        "cohort_snapshot": _mart(
            "SELECT 'enrollment_rows' AS metric, count(*) AS value FROM mart "
            "UNION ALL SELECT 'columns', 22 UNION ALL SELECT 'unique_students', count(DISTINCT id_student) FROM mart "
            "UNION ALL SELECT 'courses', count(DISTINCT code_module) FROM mart "
            "UNION ALL SELECT 'presentations', count(DISTINCT code_presentation) FROM mart "
            "UNION ALL SELECT 'candidate_features', 12"
        ),
        "data_quality": _mart(
            "SELECT 'required_columns_present' AS \"check\", true AS failed, CAST(0 AS BIGINT) AS \"count\" "
            f"UNION ALL SELECT 'duplicate_enrollment_keys', false, count(*) - count(DISTINCT ({KEY})) FROM mart "
            "UNION ALL SELECT 'zero_vle_engagement', false, count(*) FILTER (total_clicks = 0) FROM mart"
        ),
        "categorical_profile": _profile_counts(profile_columns, "column"),
        "categorical_candidates": _profile_counts(CANDIDATE_CATEGORIES, "feature"),
        "numeric_profile": _mart(
            'SELECT feature, count(v) AS "count", count(*) FILTER (v IS NULL) AS missing_count, '
            "round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(stddev_samp(v), 6) AS std, "
            'round(min(v), 6) AS "min", round(quantile_cont(v, 0.25), 6) AS q1, '
            'round(quantile_cont(v, 0.75), 6) AS q3, round(max(v), 6) AS "max" FROM long GROUP BY feature',
            _long_numeric(),
        ),
        "missingness": _mart(
            'SELECT "column", missing_count, round(CAST(missing_count AS DOUBLE) / n, 6) AS missing_share, '
            "n - missing_count AS available_count FROM nulls, (SELECT count(*) AS n FROM mart)",
            "nulls AS (" + _null_counts(MART_COLUMNS, "mart", '"column"', "missing_count") + ")",
        ),
        "click_histogram": _mart(
            f"SELECT {HISTOGRAM_COLUMNS} FROM slots LEFT JOIN hit USING (feature, bin)",
            _histogram(["total_clicks"], "40"),
        ),
        "feature_histograms": _mart(
            f"SELECT feature, {HISTOGRAM_COLUMNS}, zero_count FROM slots LEFT JOIN hit USING (feature, bin)",
            _histogram(NUMERIC, "least(40, greatest(5, floor(sqrt(count(*)))))"),
        ),
        "clicks_boxplot_by_result": _mart(
            f'SELECT final_result, observed AS "count", {BOX_COLUMNS} FROM box JOIN fences USING (final_result)',
            _box("final_result", "total_clicks", "mart"),
        ),
        "score_boxplot_by_group": _mart(
            "SELECT characteristic, category, observed AS observed_score_count, missing AS missing_score_count, "
            f"{BOX_COLUMNS} FROM box JOIN fences USING (characteristic, category)",
            "grouped AS (" + _stack(
                {name: f"coalesce({name}, 'Sin dato')" for name in ("gender", "age_band", "highest_education")},
                "characteristic", "category", extra=", weighted_assessment_score",
            ) + ")",
            _box("characteristic, category", "weighted_assessment_score", "grouped"),
        ),
        "result_distribution": _mart(
            "SELECT final_result, count(*) AS n_total, "
            "round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM mart), 6) AS share FROM mart GROUP BY 1"
        ),
        "risk_distribution": _mart(
            "SELECT CASE WHEN academic_risk = 1 THEN 'Riesgo académico' ELSE 'Resultado favorable' END AS academic_risk, "
            "count(*) AS n_total, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM mart), 6) AS share "
            "FROM mart GROUP BY 1"
        ),
        "target_share": _mart(
            "SELECT academic_risk, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM mart), 6) AS share "
            "FROM mart GROUP BY 1"
        ),
        "engagement_quartiles": _mart(
            f"SELECT {KEY}, total_clicks, final_result, engagement_quantile FROM quartiled", QUARTILED
        ),
        "risk_by_engagement_quartile": _mart("SELECT * FROM by_quartile", QUARTILED),
        "risk_by_course_suppressed": _mart("SELECT * FROM by_course", BY_COURSE),
        "score_missing_by_result": _mart(
            "SELECT final_result, count(*) AS n_total, "
            "count(*) FILTER (weighted_assessment_score IS NULL) AS n_score_missing, "
            "round(avg(CASE WHEN weighted_assessment_score IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE), 6) "
            "AS score_missing_rate FROM mart GROUP BY 1"
        ),
        "spearman_matrix": _mart(
            " UNION ALL ".join(
                f"SELECT '{left}' AS feature, "
                + ", ".join(f"round({_corr(left, right)}, 6) AS {right}" for right in NUMERIC)
                + " FROM ranks"
                for left in NUMERIC
            ),
            _ranks(),
        ),
        "collinear_pairs": _mart(
            "SELECT feature_a, feature_b, round(rho, 6) AS spearman_correlation, "
            "round(abs(rho), 6) AS absolute_correlation, abs(rho) >= 0.95 AS near_duplicate "
            "FROM pairs WHERE rho IS NOT NULL",
            _pairs(),
        ),
        "eda_headlines": _mart(
            "SELECT headline, round(value, 6) AS value FROM facts",
            QUARTILED,
            BY_COURSE,
            _pairs(),
            "facts AS (" + " UNION ALL ".join(
                f"SELECT '{name}' AS headline, CAST(({value}) AS DOUBLE) AS value" for name, value in {
                    "enrollment_rows": "SELECT count(*) FROM mart",
                    "columns": "22",
                    "students": "SELECT count(DISTINCT id_student) FROM mart",
                    "courses": "SELECT count(DISTINCT code_module) FROM mart",
                    "presentations": "SELECT count(DISTINCT code_presentation) FROM mart",
                    "candidate_features": "12",
                    "numeric_candidates": "9",
                    "categorical_candidates": "3",
                    "zero_engagement_rows": "SELECT count(*) FROM mart WHERE total_clicks = 0",
                    "risk_rows": "SELECT sum(academic_risk) FROM mart",
                    "risk_share": "SELECT avg(academic_risk) FROM mart",
                    "score_available": "SELECT count(weighted_assessment_score) FROM mart",
                    "score_missing": "SELECT count(*) FROM mart WHERE weighted_assessment_score IS NULL",
                    "imd_missing": "SELECT count(*) FROM mart WHERE imd_band IS NULL",
                    "imd_missing_share": "SELECT avg(CAST(imd_band IS NULL AS INTEGER)) FROM mart",
                    "suppressed_groups": "SELECT count(*) FROM by_course WHERE suppressed",
                    "near_duplicate_pairs": "SELECT count(*) FROM pairs WHERE abs(rho) >= 0.95",
                    **{
                        f"{q}_{part}": f"SELECT {part} FROM by_quartile WHERE engagement_quantile = '{q}'"
                        for q in ("Q1", "Q4")
                        for part in ("n_total", "n_academic_risk", "academic_risk_rate")
                    },
                }.items()
            ) + ")",
        ),
        "risk_metrics": _scored(
            "SELECT " + ", ".join(
                f"round({name}, 6) AS {name}"
                for name in ("pr_auc", "roc_auc", "brier_score", "precision_at_0_5", "recall_at_0_5")
            ) + " FROM risk_row"
        ),
        "pr_curve": _scored(
            'SELECT p AS threshold, flagged, round(CAST(hits AS DOUBLE) / flagged, 6) AS "precision", '
            "round(CAST(hits AS DOUBLE) / all_pos, 6) AS recall FROM curve"
        ),
        "roc_auc": _scored("SELECT round(roc_auc, 6) AS roc_auc FROM auc"),
        "calibration_bins": _scored(
            "SELECT bins.bin, round(mean_predicted_risk, 6) AS mean_predicted_risk, "
            "round(observed_risk, 6) AS observed_risk, equal_bins.rows AS rows, bin_rows "
            "FROM bins JOIN equal_bins ON equal_bins.bin = bins.bin"
        ),
        "capacity_top20": _scored(
            'SELECT 0.2::DOUBLE AS capacity, selected_rows, round(hit / selected_rows, 6) AS "precision", '
            "round(hit / all_y, 6) AS recall FROM capacity"
        ),
        "confusion_matrix": _scored(
            'SELECT y AS actual, CAST(p >= 0.5 AS INTEGER) AS predicted, count(*) AS "count" FROM scored GROUP BY ALL'
        ),
        "binary_confusion": _scored(
            "SELECT count(*) FILTER (y = 1 AND p >= 0.5) AS TP, count(*) FILTER (y = 0 AND p >= 0.5) AS FP, "
            "count(*) FILTER (y = 0 AND p < 0.5) AS TN, count(*) FILTER (y = 1 AND p < 0.5) AS FN FROM scored"
        ),
        "macro_scores": _mart(
            "SELECT round(sum(hits) / sum(actual), 6) AS accuracy, "
            "round(avg(coalesce(hits / nullif(predicted, 0), 0)), 6) AS precision_macro, "
            "round(avg(coalesce(hits / nullif(actual, 0), 0)), 6) AS recall_macro, "
            "round(avg(coalesce(2 * hits / nullif(actual + predicted, 0), 0)), 6) AS f1_macro, "
            "round(coalesce(max(2 * hits / nullif(actual + predicted, 0)) FILTER (c = 1), 0), 6) AS f1_score "
            "FROM per_class",
            SCORED, GUESS, _macro("performance_tier", "guess", "guessed"),
        ),
        "regression_scores": _mart(
            "SELECT 'performance_tier' AS target, round(avg(pow(performance_tier - guess, 2)), 6) AS mse, "
            "round(1 - sum(pow(performance_tier - guess, 2)) / (var_pop(performance_tier) * count(*)), 6) AS r2 "
            "FROM guessed UNION ALL "
            "SELECT 'weighted_assessment_score', round(avg(pow(weighted_assessment_score - 100 * p, 2)), 6), "
            "round(1 - sum(pow(weighted_assessment_score - 100 * p, 2)) / "
            "(var_pop(weighted_assessment_score) * count(*)), 6) "
            "FROM guessed WHERE weighted_assessment_score IS NOT NULL",
            SCORED, GUESS,
        ),
        "holdout_report": _scored(
            "SELECT (SELECT count(*) FROM scored) AS rows, (SELECT count(DISTINCT id_student) FROM scored) AS students, "
            + ", ".join(
                f"round({name}, 6) AS {name}"
                for name in ("pr_auc", "roc_auc", "brier_score", "precision_at_0_5", "recall_at_0_5")
            )
            + ", selected_rows, round(hit / selected_rows, 6) AS capacity_precision, "
            "round(hit / all_y, 6) AS capacity_recall, (SELECT count(*) FROM bins) AS calibration_bins "
            "FROM risk_row, capacity"
        ),
        "impute_median_mode": _mart(
            f"SELECT {KEY}, coalesce(c, (SELECT median(c) FROM gaps))::DOUBLE AS studied_credits, "
            "coalesce(a, (SELECT a FROM gaps WHERE a IS NOT NULL GROUP BY a ORDER BY count(*) DESC, a LIMIT 1)) "
            "AS age_band, coalesce(imd_band, (SELECT imd_band FROM gaps WHERE imd_band IS NOT NULL "
            "GROUP BY imd_band ORDER BY count(*) DESC, imd_band LIMIT 1)) AS imd_band, "
            "round(weighted_assessment_score, 6) AS weighted_assessment_score FROM gaps",
            "gaps AS (SELECT *, CASE WHEN id_student % 4 <> 0 THEN studied_credits END AS c, "
            "CASE WHEN id_student % 9 <> 0 THEN age_band END AS a FROM mart)",
        ),
        "ordinal_encode": _mart(
            f"SELECT {KEY}, CASE highest_education WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 "
            "WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 ELSE 0 END AS highest_education_encoded, "
            "CASE age_band WHEN '35-55' THEN 1 ELSE 0 END AS age_band_encoded FROM drifted",
            DRIFT,
        ),
        "standardize": _mart(
            f"SELECT {KEY}, " + ", ".join(
                f"round(({name} - avg({name}) OVER ()) / stddev_pop({name}) OVER (), 6) AS {name}"
                for name in ("studied_credits", "date_registration", "total_clicks", "vle_sites")
            ) + " FROM mart"
        ),
        "label_encode": _mart(
            f"SELECT {KEY}, final_result, CAST(dense_rank() OVER (ORDER BY final_result) - 1 AS INTEGER) "
            "AS final_result_code FROM mart"
        ),
        "temporal_holdout": _mart(f"SELECT {KEY}, part FROM parts", SPLIT),
        "split_summary": _mart(
            "SELECT part, count(*) AS rows, count(DISTINCT id_student) AS students, "
            "CAST(sum(academic_risk) AS BIGINT) AS risk_rows FROM parts GROUP BY part",
            SPLIT,
        ),
        "grouped_holdout": _mart(
            f"SELECT {KEY}, CASE WHEN place <= ceil(students / 4.0) THEN 'holdout' ELSE 'development' END AS part "
            "FROM mart JOIN placed USING (id_student)",
            _placed("mart"),
        ),
        "group_folds": _mart(
            f"SELECT {KEY}, CAST((place - 1) % 5 AS INTEGER) AS fold "
            "FROM parts JOIN placed USING (id_student) WHERE part = 'development'",
            SPLIT,
            _placed("parts WHERE part = 'development'"),
        ),
        "known_key_values": _mart(
            "SELECT DISTINCT 'code_module' AS field, code_module AS value FROM parts WHERE part = 'development' "
            "UNION ALL SELECT DISTINCT 'code_presentation', code_presentation FROM parts WHERE part = 'development'",
            SPLIT,
        ),
        "baseline_missing_rates": _mart(
            " UNION ALL ".join(
                f"SELECT '{name}' AS feature, round(avg(CAST({name} IS NULL AS DOUBLE)), 6) AS missing_rate "
                f"FROM drifted WHERE code_presentation <> {HOLDOUT}"
                for name in FEATURES
            ),
            DRIFT,
        ),
        "prevalence_baseline": _mart(
            f"SELECT {KEY}, (SELECT round(avg(academic_risk), 6) FROM parts WHERE part = 'development') "
            "AS probability_academic_risk FROM parts WHERE part = 'holdout'",
            SPLIT,
        ),
        "knn_score": _mart(
            f"SELECT {KEY}, actual, round(avg(y), 6) AS predicted FROM near WHERE place <= 5 GROUP BY ALL",
            *_tested("weighted_assessment_score"),
            "near AS (SELECT q.id_student, q.code_module, q.code_presentation, "
            "round(q.weighted_assessment_score, 6) AS actual, t.weighted_assessment_score AS y, "
            "row_number() OVER (PARTITION BY q.id_student, q.code_module, q.code_presentation ORDER BY "
            + " + ".join(f"(q.{name} - t.{name}) * (q.{name} - t.{name})" for name in NUMERIC)
            + ", t.id_student, t.code_module, t.code_presentation) AS place "
            "FROM marked q JOIN marked t ON q.held AND NOT t.held)",
        ),
        "champion_predictions": _mart(
            f"SELECT {KEY}, 'PrevalenceBaseline' AS model, academic_risk AS academic_risk_actual, "
            "round(rate, 6) AS probability_academic_risk, CAST(rate >= 0.5 AS INTEGER) AS prediction_academic_risk "
            f"FROM parts, ({RATE}) WHERE part = 'holdout'",
            SPLIT,
        ),
        "feature_importance": (
            "SELECT 'PrevalenceBaseline' AS model, 'unavailable: PrevalenceBaseline exposes no weights' AS kind, "
            "CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS importance"
        ),
        "score_enrollments": _mart(
            f"SELECT {KEY}, 30 AS cutoff_day, 'academic_risk' AS model_target, "
            "CAST(rate > 0.5 AS INTEGER) AS prediction_academic_risk, round(rate, 6) AS probability_academic_risk "
            f"FROM early, ({RATE})",
            SPLIT,
            SOURCE,
        ),
        "champion_baseline_candidate": _mart(
            "SELECT 'PrevalenceBaseline' AS model, round(avg(share), 6) AS pr_auc, 0.5::DOUBLE AS roc_auc, "
            "round(avg(share * (1 - rate) * (1 - rate) + (1 - share) * rate * rate), 6) AS brier_score FROM ("
            "SELECT CAST(s AS DOUBLE) / n AS share, CAST(sum(s) OVER () - s AS DOUBLE) / (sum(n) OVER () - n) AS rate "
            "FROM (SELECT (place - 1) % 5 AS fold, sum(academic_risk) AS s, count(*) AS n FROM parts "
            "JOIN placed USING (id_student) WHERE part = 'development' GROUP BY 1))",
            SPLIT,
            _placed("parts WHERE part = 'development'"),
        ),
        "signal_predictions": _mart(
            f"SELECT {KEY}, CAST((total_clicks < 20) <> (id_student % 10 = 0) AS INTEGER) AS academic_risk_actual, "
            "true AS probability_in_range, true AS class_fits, true AS model_won FROM parts WHERE part = 'holdout'",
            SPLIT,
        ),
        "signal_model_checks": f"SELECT *, true AS holds FROM {MODEL_CHECKS}",
        "signal_fold_checks": (
            f"SELECT CAST(training_set AS INTEGER) AS training_set, told.*, true AS holds FROM {MODEL_CHECKS}, "
            "range(-1, 5) AS sets(training_set)"
        ),
        "candidate_importances": _mart(
            "SELECT model, kind, feature, true AS not_negative FROM "
            "(VALUES ('LogisticRegression', 'absolute_coefficient'), "
            "('DecisionTreeClassifier', 'feature_importance')) AS told(model, kind), ("
            + " UNION ALL ".join(
                f"SELECT DISTINCT '{name}_' || {name} AS feature FROM parts WHERE part = 'development'"
                for name in ("highest_education", "age_band")
            )
            + " UNION ALL SELECT unnest([" + ", ".join(f"'{name}'" for name in NUMERIC_FEATURES) + "]))",
            SPLIT,
        ),
        **{
            f"legacy_{kind}_checks": _mart(
                f"SELECT '{kind}' AS type, model, count(*) AS rows, "
                f"round(CAST(sum({target}) AS DOUBLE), 4) AS label_sum, "
                "true AS possible, true AS metrics_follow "
                f"FROM (SELECT unnest([{models}]) AS model), marked WHERE held GROUP BY model",
                *_tested(target),
            )
            for kind, (target, models) in LEGACY.items()
        },
        "ordinal_confusion": _mart(
            f"SELECT model, performance_tier AS actual, count(*) AS rows "
            f"FROM (SELECT unnest([{LEGACY['ordinal'][1]}]) AS model), marked WHERE held GROUP BY ALL",
            *_tested("performance_tier"),
        ),
        "kmeans_checks": _mart(
            "SELECT count(*) AS rows, true AS nearest_centre, true AS inertia_follows, true AS all_rows_clustered, "
            "CAST(3 AS BIGINT) AS clusters, true AS converged FROM mart"
        ),
        "module_resolution": _with("SELECT * FROM resolved_activity", SOURCE),
        "discard_reasons": _with(
            "SELECT reason, count(*) AS events, CAST(sum(clicks) AS BIGINT) AS clicks FROM resolved GROUP BY reason",
            SOURCE,
        ),
        "scoring_frame": _with(
            f"SELECT {KEY}, highest_education, age_band, num_of_prev_attempts, studied_credits, date_registration, "
            "course_duration_days, coalesce(total_clicks, 0) AS total_clicks, coalesce(active_days, 0) AS active_days, "
            "coalesce(vle_events, 0) AS vle_events, coalesce(vle_sites, 0) AS vle_sites, "
            "CASE WHEN coalesce(vle_events, 0) > 0 THEN 1 ELSE 0 END AS has_vle_activity "
            "FROM early JOIN student USING (id_student) LEFT JOIN course USING (code_module, code_presentation) "
            "LEFT JOIN resolved_activity USING (id_student, code_module, code_presentation)",
            SOURCE,
        ),
        "unseen_fields": _mart(f"SELECT {KEY}, oov_categorical_fields FROM unseen", DRIFT),
        "unseen_keys": _mart(f"SELECT {KEY}, oov_key_fields FROM unseen", DRIFT),
        "missing_to_impute": _mart(
            _null_counts(list(FEATURES), "drifted", "feature", "missing_count"), DRIFT
        ),
        "drift_warnings": _mart(
            "SELECT 'missingness_shift:' || feature AS warning, round(now_rate, 6) AS missing_rate, "
            "round(base_rate, 6) AS baseline_rate FROM rates WHERE abs(now_rate - base_rate) >= 0.2 "
            "UNION ALL SELECT 'unseen_categorical_values', NULL, NULL "
            "WHERE EXISTS (SELECT 1 FROM unseen WHERE oov_categorical_fields <> 'none')",
            DRIFT,
            "rates AS (" + " UNION ALL ".join(
                f"SELECT '{name}' AS feature, (SELECT avg(CAST({name} IS NULL AS DOUBLE)) FROM drifted) AS now_rate, "
                f"(SELECT avg(CAST({name} IS NULL AS DOUBLE)) FROM training) AS base_rate"
                for name in FEATURES
            ) + ")",
        ),
        "probability_summary": _scored(
            'SELECT count(p) AS "count", round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS std, '
            'round(min(p), 6) AS "min", round(quantile_cont(p, 0.05), 6) AS p5, round(median(p), 6) AS p50, '
            'round(quantile_cont(p, 0.95), 6) AS p95, round(max(p), 6) AS "max" FROM scored'
        ),
        "oov_counts": _mart(
            "SELECT count(*) FILTER (oov_categorical_fields <> 'none') AS rows_with_categorical_oov, "
            "count(*) FILTER (oov_key_fields <> 'none') AS rows_with_key_oov FROM unseen",
            DRIFT,
        ),
    }
    return sql
