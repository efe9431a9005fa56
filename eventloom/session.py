"""Session settings and lineage cuts shared by all operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed for. On a cluster the shuffle partition count is an upper
# bound that adaptive execution coalesces, so it can be set high.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A feature job has more generated classes than the default cache of 100 holds; without this
    # every run compiles them again.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # A checkpoint is removed when nothing refers to its frame any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def one_machine(master: str) -> bool:
    """All tasks of the session run in the driver's own process, so a local folder is shared by all."""
    return master == "local" or master.startswith("local[")


def build_session(app: str = "eventloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_timezone(spark: SparkSession) -> None:
    """Hour, day and epoch functions follow the session zone; all results here are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and return it with its lineage cut.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session without that setting
    gets a temporary folder; a cluster session without it is refused, because a machine-local
    folder would lose data together with an executor.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not one_machine(context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="eventloom-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
