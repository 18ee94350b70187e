"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "plyscope", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; keyword settings use ``__`` for dots."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # collect_list keeps hashing for many games per task instead of sorting after 128
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; in local mode a new one if unset."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("plyscope.scratch.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="plyscope-")
        spark.conf.set("plyscope.scratch.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors, unlike cached blocks."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files and checkpoints of tables that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
