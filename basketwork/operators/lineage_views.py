"""The lineage registry as catalogue tables, and its reports as permanent views over them.

A view holds its text, so it shows what the tables hold when it is read, in any session with the same catalogue.
Captures are combined before they meet the registry, as in `lineage`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from basketwork.operators.lineage import CONFIDENCE_LEVELS, LOW_CONFIDENCE, Lineage
from basketwork.sources.registry import create_view, save_table, use_database

TABLES = ("sources", "targets", "transformations", "relationships")
_LEVELS = " ".join(f"WHEN score >= {limit} THEN '{label}'" for limit, label in CONFIDENCE_LEVELS)

VIEW_TEXTS = {
    "v_complete_lineage": """
SELECT relationship_id, source_name, source_type, source_location, target_name, target_type,
  dataset_name || '.' || table_name AS target_full_name,
  transformation_name, transformation_type, transformation_logic, business_rule,
  relationship_type, confidence_score, pipeline_name, edge.dag_id, edge.task_id, is_active
FROM (FROM {db}.lineage_relationships |> WHERE is_active) AS edge
  INNER JOIN {db}.lineage_sources USING (source_id)
  INNER JOIN {db}.lineage_targets USING (target_id)
  LEFT JOIN {db}.lineage_transformations USING (transformation_id)""",
    "v_field_lineage": """
SELECT transformation_id, transformation_name, source_field, target_field, transformation_logic, business_rule,
  rule.dag_id, rule.task_id, edge.pipeline_name, source_name, target_name, confidence_score
FROM (FROM {db}.lineage_relationships |> WHERE is_active) AS edge
  INNER JOIN {db}.lineage_transformations AS rule USING (transformation_id)
  INNER JOIN {db}.lineage_sources USING (source_id)
  INNER JOIN {db}.lineage_targets USING (target_id)""",
    "v_lineage_quality_impact": """
WITH captured AS (
  SELECT target_id, transformation_id, pipeline_name, count(*) AS n, count(confidence_score) AS scored,
    sum(CAST(confidence_score AS DECIMAL(18,6))) AS total, max(execution_date) AS last_run
  FROM {db}.lineage_relationships WHERE is_active GROUP BY ALL
), summed AS (
  SELECT target_name, dataset_name || '.' || table_name AS target_full_name,
    coalesce(sum(n) FILTER (WHERE transformation_type IS NOT NULL), 0) AS transformation_count,
    coalesce(sum(n) FILTER (WHERE transformation_type = 'CLEANING'), 0) AS cleaning_transformations,
    coalesce(sum(n) FILTER (WHERE transformation_type = 'FILTERING'), 0) AS filtering_transformations,
    CAST(sum(total) AS DOUBLE) / nullif(sum(scored), 0) AS score,
    array_join(array_sort(collect_set(pipeline_name)), ',') AS contributing_pipelines, max(last_run) AS last_updated
  FROM captured INNER JOIN {db}.lineage_targets USING (target_id)
    LEFT JOIN {db}.lineage_transformations USING (transformation_id)
  GROUP BY target_name, dataset_name, table_name
)
SELECT * EXCEPT (score, last_updated), CAST(round(CAST(score AS DECIMAL(18,9)), 3) AS DOUBLE) AS avg_confidence_score,
  last_updated, CASE {levels} ELSE '{low}' END AS quality_rating
FROM summed""",
    "v_pipeline_dependencies": """
WITH captured AS (
  SELECT pipeline_name, dag_id, source_id, target_id, count(*) AS n, count(confidence_score) AS scored,
    sum(CAST(confidence_score AS DECIMAL(18,6))) AS total
  FROM {db}.lineage_relationships WHERE is_active GROUP BY ALL
), summed AS (
  SELECT pipeline_name AS downstream_pipeline, dag_id AS downstream_dag, source_type AS upstream_source_type,
    source_name AS upstream_source, sum(n) AS dependency_count,
    array_join(array_sort(collect_set(target_name)), ',') AS affected_targets,
    CAST(sum(total) AS DOUBLE) / nullif(sum(scored), 0) AS score
  FROM captured INNER JOIN {db}.lineage_sources USING (source_id) INNER JOIN {db}.lineage_targets USING (target_id)
  GROUP BY ALL
)
SELECT * EXCEPT (score), CAST(round(CAST(score AS DECIMAL(18,9)), 3) AS DOUBLE) AS avg_confidence,
  CASE WHEN dependency_count = 1 THEN 'SIMPLE' WHEN dependency_count <= 3 THEN 'MODERATE' ELSE 'COMPLEX' END AS complexity_level
FROM summed""",
}


def publish(spark: SparkSession, lineage: Lineage, database: str) -> None:
    """Save the four registry tables in a database of the catalogue and create the views over them."""
    use_database(spark, database)
    for name in TABLES:
        save_table(getattr(lineage, name), f"{database}.lineage_{name}")
    for name, text in VIEW_TEXTS.items():
        create_view(spark, f"{database}.{name}", text.format(db=database, levels=_LEVELS, low=LOW_CONFIDENCE))
