"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every plan here relies on. Skewed join partitions are split by AQE even when
# that costs one more exchange, and the size check of a broadcast is left to AQE's own threshold.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Tables bucketed by item id may be joined on (id, field, term) without being shuffled again.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A bucket is one task's work also where nothing is joined or grouped, as when postings are made.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  memory: str | None = None, app: str = "catalograph") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``, or the one given to ``setCheckpointDir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("intermediate tables need a folder that the driver and all executors share: "
                           "set spark.checkpoint.dir, or call sparkContext.setCheckpointDir(folder)")
    return folder


_scratch: dict[str, list[str]] = {}  # folders written by each application of this process


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables this application wrote to the shared folder, and return their number.

    For the end of a job: results that have not been written read them lazily, and so do indexes without a path.
    """
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    deleted = 0
    for path in map(hadoop, paths):
        deleted += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return deleted


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage with a written table: what was read once stays fixed when executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
