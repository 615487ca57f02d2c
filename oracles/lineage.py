"""Oracle SQL of the lineage reports over the sample run history."""

from basketwork.operators.lineage_seeds import CAPTURES, SOURCES, TARGETS, TRANSFORMATIONS
from basketwork.sources.sample_feeds import EVENT_STEPS
from oracles.base import cte, half_up, sql


def _values(rows: list[tuple], columns: str) -> str:
    shown = ",\n  ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES\n  {shown}) v({columns})"


cte("sources", [], _values(
    SOURCES, "source_id, source_name, source_type, source_location, description, business_owner, technical_owner"))
cte("targets", [], _values(
    TARGETS, "target_id, target_name, target_type, dataset_name, table_name, description, business_purpose"))
cte("rules", [], _values(
    TRANSFORMATIONS,
    "transformation_id, transformation_name, transformation_type, source_field, target_field, transformation_logic, "
    "business_rule, dag_id, task_id"))
cte("steps", [], _values(
    [(kind, *CAPTURES[name]) for kind, name in EVENT_STEPS.items()],
    "event_type, source_id, target_id, transformation_id, relationship_type, base, pipeline_name"))
cte("captures", ["steps"], """
SELECT 'RT_' || event_type || '_' || event_id AS relationship_id, source_id, target_id,
  if(user_id % 7 = 0, 'TRANS_NOT_REGISTERED', transformation_id) AS transformation_id, relationship_type,
  base::DECIMAL(4,2) - (user_id % 4)::DECIMAL(2,0) * 0.05::DECIMAL(3,2) AS score, pipeline_name,
  'dag_' || event_type AS dag_id, 'task_' || (user_id % 5) AS task_id, ts AS execution_date, TRUE AS is_active
FROM events JOIN steps USING (event_type) WHERE event_id % 10 <> 0""")
cte("flow", ["captures", "sources", "targets", "rules"], """
SELECT c.relationship_id, source_name, source_type, source_location, target_name, target_type,
  dataset_name || '.' || table_name AS target_full_name, transformation_name, transformation_type,
  transformation_logic, business_rule, c.relationship_type, c.score::DOUBLE AS confidence_score, c.pipeline_name,
  c.dag_id, c.task_id, c.is_active
FROM captures c JOIN sources USING (source_id) JOIN targets USING (target_id)
LEFT JOIN rules r ON r.transformation_id = c.transformation_id""")


def score(digits: int = 3) -> str:
    # scores have two decimals: exact integers in hundredths
    return half_up("(sum(score) * 100)::HUGEINT", "100 * count(score)", digits)


cte("runs", ["steps"], """
SELECT event_type || '_' || event_id AS execution_id, 'dag_' || event_type AS dag_id, 'task_' || (user_id % 5) AS task_id,
  'run_' || user_id AS run_id, '' AS source_table, target_id AS target_table,
  CASE WHEN NOT ended THEN NULL WHEN event_type = 'error' THEN 0
       ELSE json_extract_string(props, '$.k')::BIGINT END AS records_processed,
  CASE WHEN NOT ended THEN 'RUNNING' WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status,
  ts AS start_time, CASE WHEN ended THEN ts + to_seconds(floor(value)) END AS end_time,
  CASE WHEN ended THEN floor(value)::BIGINT END AS execution_duration_seconds,
  CASE WHEN ended THEN if(event_type = 'error', 'code ' || json_extract_string(props, '$.k'), '') END AS error_message,
  ended AS lineage_captured
FROM (SELECT *, user_id % 20 <> 0 AS ended FROM events) JOIN steps USING (event_type)""")

ORACLES = {
    "l7_complete": sql("SELECT * FROM flow", "flow"),
    "l8_field": sql(
        """SELECT transformation_id, transformation_name, source_field, target_field, transformation_logic,
  business_rule, r.dag_id AS dag_id, r.task_id AS task_id, c.pipeline_name, source_name, target_name,
  c.score::DOUBLE AS confidence_score
FROM rules r JOIN captures c USING (transformation_id) JOIN sources USING (source_id) JOIN targets USING (target_id)""",
        "captures", "sources", "targets", "rules",
    ),
    "l9_impact": sql(
        f"""SELECT target_name, dataset_name || '.' || table_name AS target_full_name,
  count(r.transformation_id) AS transformation_count,
  count(*) FILTER (transformation_type = 'CLEANING') AS cleaning_transformations,
  count(*) FILTER (transformation_type = 'FILTERING') AS filtering_transformations,
  {score()} AS avg_confidence_score,
  string_agg(DISTINCT pipeline_name, ',' ORDER BY pipeline_name) AS contributing_pipelines,
  max(execution_date) AS last_updated,
  CASE WHEN sum(score)::DOUBLE / count(*) >= 0.95 THEN 'HIGH_CONFIDENCE'
       WHEN sum(score)::DOUBLE / count(*) >= 0.85 THEN 'MEDIUM_CONFIDENCE' ELSE 'LOW_CONFIDENCE' END AS quality_rating
FROM captures c JOIN targets USING (target_id) LEFT JOIN rules r ON r.transformation_id = c.transformation_id
GROUP BY target_name, dataset_name, table_name""",
        "captures", "targets", "rules",
    ),
    "l10_dependencies": sql(
        f"""SELECT pipeline_name AS downstream_pipeline, dag_id AS downstream_dag, source_type AS upstream_source_type,
  source_name AS upstream_source, count(*) AS dependency_count,
  string_agg(DISTINCT target_name, ',' ORDER BY target_name) AS affected_targets, {score()} AS avg_confidence,
  CASE WHEN count(*) = 1 THEN 'SIMPLE' WHEN count(*) <= 3 THEN 'MODERATE' ELSE 'COMPLEX' END AS complexity_level
FROM captures JOIN sources USING (source_id) JOIN targets USING (target_id) GROUP BY 1, 2, 3, 4""",
        "captures", "sources", "targets",
    ),
    "l11_summary": sql(
        """SELECT 'SOURCES' AS category, count(*) AS count,
  string_agg(DISTINCT source_type, ',' ORDER BY source_type) AS types FROM sources
UNION ALL SELECT 'TARGETS', count(*), string_agg(DISTINCT target_type, ',' ORDER BY target_type) FROM targets
UNION ALL SELECT 'TRANSFORMATIONS', count(*),
  string_agg(DISTINCT transformation_type, ',' ORDER BY transformation_type) FROM rules
UNION ALL SELECT 'RELATIONSHIPS', count(*),
  string_agg(DISTINCT relationship_type, ',' ORDER BY relationship_type) FROM captures""",
        "captures", "sources", "targets", "rules",
    ),
    "l12_executions": sql("SELECT * FROM runs", "runs"),
    "l13_edges": sql(
        "SELECT *, score::DOUBLE AS confidence_score FROM captures", "captures"
    ).replace("SELECT *, score", "SELECT * EXCLUDE (score), score"),
    "l14_running_times": sql(
        """SELECT dag_id, task_id, count(*) AS executions, count(*) FILTER (execution_status = 'FAILED') AS failures,
  sum(execution_duration_seconds)::DOUBLE / count(execution_duration_seconds) AS avg_seconds
FROM runs GROUP BY 1, 2""",
        "runs",
    ),
    "m2_edges": sql(
        """SELECT source_name, target_name, transformation_name, relationship_type, confidence_score, relationship_id
FROM flow ORDER BY source_name, target_name, transformation_name NULLS FIRST, relationship_id LIMIT 10""",
        "flow",
    ),
    "m3_runs": sql(
        """SELECT execution_id, dag_id, task_id, execution_status, start_time, end_time, records_processed FROM runs
ORDER BY start_time DESC, execution_id LIMIT 15""",
        "runs",
    ),
}
