"""Spark session settings and the shared folder for written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. AQE coalesces small shuffle partitions,
# splits skewed join partitions and splits hot days on write (rebalance). Small
# tables are written by all cores: their cost is files, not bytes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "basketwork", master: str | None = None, **settings: str) -> SparkSession:
    """A session with `SETTINGS`; keyword settings use `_` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`, else one below the warehouse's.

    On a cluster the warehouse must then lie in a store of its own: a local folder, which is what an unset warehouse
    means, is another one on every machine, and is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not is_shared(warehouse, spark.conf.get("spark.master", "local")):
        raise ValueError(f"{warehouse} is local to each machine: set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/shared"


def is_shared(folder: str, master: str) -> bool:
    """Whether all executors of a master see the same folder: one machine, or a file system named in the path."""
    one_machine = master.split("[")[0] in ("local", "local-cluster")
    scheme = folder.split(":", 1)[0] if ":" in folder else ""
    return one_machine or scheme not in ("", "file")


def checkpointed(df: DataFrame) -> DataFrame:
    """A small result that several parts of a plan read, computed once.

    The rows are written to the shared folder, so they survive lost executors.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
