"""Lineage registry, views over it, and the append-only execution log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwork import schemas
from basketwork.functions.numbers import count_if, first_match
from basketwork.operators.joins import attach, column_bytes
from basketwork.operators.lineage_seeds import RELATIONSHIPS, SOURCES, TARGETS, TRANSFORMATIONS
from basketwork.session import checkpointed
from basketwork.sources.tables import small_table

# Limits and labels of the lineage reports.
CONFIDENCE_LEVELS = [(0.95, "HIGH_CONFIDENCE"), (0.85, "MEDIUM_CONFIDENCE")]
LOW_CONFIDENCE = "LOW_CONFIDENCE"
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
STAMP = "yyyyMMdd_HHmmss"


@dataclass
class Lineage:
    """The four registry tables; relationships may hold any number of captures."""

    sources: DataFrame
    targets: DataFrame
    transformations: DataFrame
    relationships: DataFrame

    def active(self) -> DataFrame:
        return self.relationships.filter("is_active")

    def with_targets_as_sources(self) -> Lineage:
        """Two-hop form: tables that feed other tables also count as sources."""
        as_sources = self.targets.select(
            F.col("target_id").alias("source_id"),
            F.col("target_name").alias("source_name"),
            F.col("target_type").alias("source_type"),
            F.concat_ws(".", "dataset_name", "table_name").alias("source_location"),
        )
        sources = self.sources.unionByName(as_sources, allowMissingColumns=True)
        return Lineage(sources, self.targets, self.transformations, self.relationships)


def seed(spark: SparkSession, created: dt.datetime) -> Lineage:
    """The predefined sources, targets, rules and relationships."""

    def frame(rows: list[tuple], columns: str, schema, **extra: Column) -> DataFrame:
        df = small_table(spark, rows, columns.split()).withColumns(extra)
        return df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields
            ]
        )

    now = F.lit(created)
    return Lineage(
        frame(
            SOURCES,
            "source_id source_name source_type source_location description business_owner technical_owner",
            schemas.LINEAGE_SOURCES, created_timestamp=now, last_updated=now,
        ),
        frame(
            TARGETS,
            "target_id target_name target_type dataset_name table_name description business_purpose",
            schemas.LINEAGE_TARGETS, created_timestamp=now, last_updated=now,
        ),
        frame(
            TRANSFORMATIONS,
            "transformation_id transformation_name transformation_type source_field target_field "
            "transformation_logic business_rule dag_id task_id",
            schemas.LINEAGE_TRANSFORMATIONS, created_timestamp=now,
        ),
        frame(
            RELATIONSHIPS,
            "relationship_id source_id target_id transformation_id relationship_type confidence_score "
            "pipeline_name dag_id task_id",
            schemas.LINEAGE_RELATIONSHIPS, created_timestamp=now, is_active=F.lit(True),
        ),
    )


def _full_name() -> Column:
    return F.concat("dataset_name", F.lit("."), "table_name").alias("target_full_name")


def _shown(score: Column) -> Column:
    """Three digits, rounded as a decimal."""
    return F.round(score.cast("decimal(18,9)"), 3).cast("double")


def _registered(edges: DataFrame, entries: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Edges with the columns of a registry table; one entry may hold most edges."""
    return attach(edges, entries, key, how, sum(column_bytes(entries).values()), salt_on="relationship_id")


def complete_lineage(lineage: Lineage) -> DataFrame:
    """Active relationships with source, target and rule; unknown sources drop out."""
    edges = lineage.active().select(
        "relationship_id", "source_id", "target_id", "transformation_id", "relationship_type",
        "confidence_score", "pipeline_name", "dag_id", "task_id", "is_active",
    )
    sources = lineage.sources.select("source_id", "source_name", "source_type", "source_location")
    targets = lineage.targets.select("target_id", "target_name", "target_type", _full_name())
    rules = lineage.transformations.select(
        "transformation_id", "transformation_name", "transformation_type", "transformation_logic", "business_rule"
    )
    flow = _registered(edges, sources, "source_id")
    flow = _registered(flow, targets, "target_id")
    flow = _registered(flow, rules, "transformation_id", "left")
    return (
        flow.select(
            "relationship_id", *sources.columns[1:], *targets.columns[1:], *rules.columns[1:],
            "relationship_type", "confidence_score", "pipeline_name", "dag_id", "task_id", "is_active",
        )
        .orderBy("pipeline_name", "target_type", "target_name", "relationship_id")
    )


def field_lineage(lineage: Lineage) -> DataFrame:
    """Field-level rules of active relationships."""
    edges = lineage.active().select(
        "transformation_id", "source_id", "target_id", "pipeline_name", "confidence_score", "relationship_id"
    )
    rules = lineage.transformations.drop("created_timestamp")
    flow = _registered(edges, rules, "transformation_id")
    flow = _registered(flow, lineage.sources.select("source_id", "source_name"), "source_id")
    flow = _registered(flow, lineage.targets.select("target_id", "target_name"), "target_id")
    return (
        flow.orderBy("pipeline_name", "transformation_type", "transformation_name", "relationship_id")
        .select(
            "transformation_id", "transformation_name", "source_field", "target_field", "transformation_logic",
            "business_rule", "dag_id", "task_id", "pipeline_name", "source_name", "target_name", "confidence_score",
        )
    )


def quality_impact(lineage: Lineage) -> DataFrame:
    """Rules, confidence and pipelines per target; sources need not be known."""
    targets = lineage.targets.select("target_id", "target_name", _full_name())
    rules = lineage.transformations.select("transformation_id", F.col("transformation_type").alias("kind"))
    # captures are combined per target, rule and pipeline before they meet the registry
    captures = lineage.active().groupBy("target_id", "transformation_id", "pipeline_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("confidence_score").alias("scored"),
        F.sum(F.col("confidence_score").cast("decimal(18,6)")).alias("score"),
        F.max("execution_date").alias("last_run"),
    )
    edges = captures.join(targets, "target_id").join(
        rules.withColumn("rule_known", F.lit(True)), "transformation_id", "left"
    )
    n = F.col("n")
    grouped = edges.groupBy("target_name", "target_full_name").agg(
        F.coalesce(F.sum(F.when(F.col("rule_known"), n)), F.lit(0)).alias("transformation_count"),
        F.coalesce(F.sum(F.when(F.col("kind") == "CLEANING", n)), F.lit(0)).alias("cleaning_transformations"),
        F.coalesce(F.sum(F.when(F.col("kind") == "FILTERING", n)), F.lit(0)).alias("filtering_transformations"),
        (F.sum("score").cast("double") / F.nullif(F.sum("scored"), F.lit(0))).alias("score"),
        F.array_join(F.array_sort(F.collect_set("pipeline_name")), ",").alias("contributing_pipelines"),
        F.max("last_run").alias("last_updated"),
    )
    score = F.col("score")
    return grouped.orderBy(F.desc("score"), "target_name").select(
        "target_name", "target_full_name", "transformation_count", "cleaning_transformations",
        "filtering_transformations", _shown(score).alias("avg_confidence_score"), "contributing_pipelines",
        "last_updated",
        first_match([(score >= n, label) for n, label in CONFIDENCE_LEVELS], LOW_CONFIDENCE).alias("quality_rating"),
    )


def pipeline_dependencies(lineage: Lineage) -> DataFrame:
    """Per pipeline and source: relationships, targets, confidence, complexity."""
    captures = lineage.active().groupBy("pipeline_name", "dag_id", "source_id", "target_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("confidence_score").alias("scored"),
        F.sum(F.col("confidence_score").cast("decimal(18,6)")).alias("score"),
    )
    edges = captures.join(
        lineage.sources.select("source_id", "source_type", "source_name"), "source_id"
    ).join(lineage.targets.select("target_id", "target_name"), "target_id")
    count = F.col("dependency_count")
    score = F.sum("score").cast("double") / F.nullif(F.sum("scored"), F.lit(0))
    return (
        edges.groupBy(
            F.col("pipeline_name").alias("downstream_pipeline"),
            F.col("dag_id").alias("downstream_dag"),
            F.col("source_type").alias("upstream_source_type"),
            F.col("source_name").alias("upstream_source"),
        )
        .agg(
            F.sum("n").alias("dependency_count"),
            F.array_join(F.array_sort(F.collect_set("target_name")), ",").alias("affected_targets"),
            _shown(score).alias("avg_confidence"),
        )
        .withColumn("complexity_level", first_match([(count == 1, "SIMPLE"), (count <= 3, "MODERATE")], "COMPLEX"))
        .orderBy("downstream_pipeline", F.desc("dependency_count"), "upstream_source")
    )


def summary(lineage: Lineage) -> DataFrame:
    """Entries and distinct types of each registry table."""
    parts = [
        ("SOURCES", lineage.sources, "source_type"),
        ("TARGETS", lineage.targets, "target_type"),
        ("TRANSFORMATIONS", lineage.transformations, "transformation_type"),
        ("RELATIONSHIPS", lineage.active(), "relationship_type"),
    ]
    rows = []
    for label, df, kind in parts:
        per_kind = df.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
        rows.append(
            per_kind.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
                F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("types"),
            ).select(F.lit(label).alias("category"), "*")
        )
    return reduce(DataFrame.unionByName, rows).orderBy("category")


def edges(lineage: Lineage, top: int | None = 10) -> DataFrame:
    """M2: named edges with rule and confidence."""
    return (
        complete_lineage(lineage)
        .orderBy("source_name", "target_name", "transformation_name", "relationship_id")
        .select("source_name", "target_name", "transformation_name", "relationship_type", "confidence_score",
                "relationship_id")
        .transform(lambda rows: rows if top is None else rows.limit(top))
    )


def reach(edges: DataFrame, max_depth: int = 20) -> DataFrame:
    """source_id, target_id, depth: what each entry reaches over any number of edges, and the fewest it takes.

    `edges` holds source_id and target_id; repeated edges count once. A path never comes back to an entry it has
    passed, so cycles end, and entries do not reach themselves. Paths of over `max_depth` edges are not followed.
    """
    distinct = edges.select("source_id", "target_id").filter("source_id <> target_id").distinct()
    return edges.sparkSession.sql(
        """
WITH RECURSIVE step(source_id, target_id, depth, passed) AS (
  SELECT source_id, target_id, 1, array(source_id, target_id) FROM {edges}
  UNION ALL
  SELECT step.source_id, next.target_id, depth + 1, array_append(passed, next.target_id)
  FROM step JOIN {edges} AS next ON step.target_id = next.source_id
  WHERE depth < {max_depth} AND NOT array_contains(passed, next.target_id)
)
SELECT source_id, target_id, min(depth) AS depth FROM step GROUP BY ALL""",
        edges=checkpointed(distinct), max_depth=max_depth,
    )


def lineage_reach(lineage: Lineage, max_depth: int = 20) -> DataFrame:
    """L7 over any depth: named entries that each source or target feeds, directly or through others."""
    entries = lineage.sources.select("source_id", "source_name").unionByName(
        lineage.targets.select(F.col("target_id").alias("source_id"), F.col("target_name").alias("source_name"))
    )
    found = reach(lineage.active(), max_depth)
    ends = entries.select(F.col("source_id").alias("target_id"), F.col("source_name").alias("target_name"))
    return found.join(entries, "source_id").join(ends, "target_id").select("source_name", "target_name", "depth")


VIEWS: Mapping[str, Callable[[Lineage], DataFrame]] = {
    "v_complete_lineage": complete_lineage,
    "v_field_lineage": field_lineage,
    "v_lineage_quality_impact": quality_impact,
    "v_pipeline_dependencies": pipeline_dependencies,
}


def register_views(lineage: Lineage) -> None:
    """The four reports as temporary views."""
    for name, build in VIEWS.items():
        build(lineage).createOrReplaceTempView(name)


# -- execution log ---------------------------------------------------------


def executions(log: DataFrame) -> DataFrame:
    """Current state of each execution in an append-only log.

    A start is one row, a completion another with the end values. The state
    takes the latest value of each; both combine on the map side.
    """
    done = F.col("execution_status") != RUNNING

    def last(name: str) -> Column:
        return F.max_by(name, "end_time").alias(name)

    started = F.min("start_time")
    ended = F.max("end_time")
    return log.groupBy("execution_id").agg(
        *[F.max(c).alias(c) for c in ("dag_id", "task_id", "run_id", "source_table", "target_table")],
        F.max_by("records_processed", F.when(done, F.col("end_time"))).alias("records_processed"),
        F.coalesce(F.max_by("execution_status", F.when(done, F.col("end_time"))), F.lit(RUNNING)).alias(
            "execution_status"
        ),
        started.alias("start_time"),
        ended.alias("end_time"),
        F.timestamp_diff("SECOND", started, ended).alias("execution_duration_seconds"),
        last("error_message"),
        F.bool_or("lineage_captured").alias("lineage_captured"),
        F.min("created_timestamp").alias("created_timestamp"),
    )


def latest_executions(log: DataFrame, top: int | None = 15) -> DataFrame:
    """M3: the newest executions."""
    return (
        executions(log)
        .select("execution_id", "dag_id", "task_id", "execution_status", "start_time", "end_time", "records_processed")
        .orderBy(F.desc("start_time"), "execution_id")
        .transform(lambda rows: rows if top is None else rows.limit(top))
    )


def running_times(log: DataFrame) -> DataFrame:
    """Executions, failures and mean duration per step and status."""
    n, seconds = F.count("execution_duration_seconds"), F.sum("execution_duration_seconds")
    return executions(log).groupBy("dag_id", "task_id").agg(
        F.count(F.lit(1)).alias("executions"),
        count_if(F.col("execution_status") == FAILED).alias("failures"),
        (seconds.cast("double") / F.nullif(n, F.lit(0))).alias("avg_seconds"),
    )


@dataclass
class Step:
    """A tracked step: ids, and the record count its body reports."""

    dag_id: str
    task_id: str
    run_id: str
    execution_id: str
    started: dt.datetime
    source_table: str = ""
    target_table: str = ""
    records: int = 0


@dataclass
class Tracker:
    """Appends executions and relationships to the lineage folder.

    A failure to write the log is kept in `errors` and does not stop the
    pipeline.
    """

    spark: SparkSession
    path: str
    run_id: str
    clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    errors: list[str] = field(default_factory=list)

    def _append(self, table: str, rows: list[dict], schema) -> None:
        try:
            values = [tuple(row.get(f.name) for f in schema.fields) for row in rows]
            self.spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{table}")
        except Exception as error:
            self.errors.append(str(error))

    def _log(self, step: Step, **values: object) -> None:
        row = {
            "execution_id": step.execution_id, "dag_id": step.dag_id, "task_id": step.task_id,
            "run_id": step.run_id, "source_table": step.source_table, "target_table": step.target_table,
            "created_timestamp": self.clock(), **values,
        }
        self._append("execution_log", [row], schemas.EXECUTION_LOG)

    @contextmanager
    def step(self, dag_id: str, task_id: str, source_table: str = "", target_table: str = ""):
        """Log start and end around a step; its body sets `records`."""
        now = self.clock()
        execution_id = f"{dag_id}_{task_id}_{self.run_id}_{now:%Y%m%d_%H%M%S}"
        step = Step(dag_id, task_id, self.run_id, execution_id, now, source_table, target_table)
        self._log(step, execution_status=RUNNING, start_time=now, lineage_captured=False)
        try:
            yield step
        except Exception as error:
            self._end(step, FAILED, str(error), 0)
            raise
        self._end(step, SUCCESS, "", step.records)

    def _end(self, step: Step, status: str, message: str, records: int) -> None:
        now = self.clock()
        self._log(
            step, execution_status=status, start_time=step.started, end_time=now, records_processed=records,
            execution_duration_seconds=int((now - step.started).total_seconds()), error_message=message,
            lineage_captured=True,
        )

    def capture(
        self, step: Step, pipeline_name: str, source_id: str, target_id: str, transformation_id: str,
        relationship_type: str = "TRANSFORMED", confidence_score: float = 0.95,
    ) -> str:
        """One relationship seen at run time."""
        now = self.clock()
        relationship_id = f"RT_{step.dag_id}_{step.task_id}_{target_id}_{now:%Y%m%d_%H%M%S}"
        row = {
            "relationship_id": relationship_id, "source_id": source_id, "target_id": target_id,
            "transformation_id": transformation_id, "relationship_type": relationship_type,
            "confidence_score": confidence_score, "pipeline_name": pipeline_name, "dag_id": step.dag_id,
            "task_id": step.task_id, "execution_date": now, "created_timestamp": now, "is_active": True,
        }
        self._append("relationships", [row], schemas.LINEAGE_RELATIONSHIPS)
        return relationship_id
