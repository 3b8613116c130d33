"""Session helpers: where intermediate tables go and how lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # of shuffle files when a query ends


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A folder of our own is
    made only in local mode with the setting absent, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    own = tempfile.mkdtemp(prefix="dunlin-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(own)
    return own


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The result has no lineage, outlives lost executors and is still columnar,
    so later steps prune columns and push filters into it. Nothing reads the
    shuffle files of the write again, so they go with it.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def widen(df: DataFrame) -> DataFrame:
    """Spread a scan of too few partitions over all cores; wide input is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
