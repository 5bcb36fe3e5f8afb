"""Session helpers shared by every job."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, gets a temporary one,
    which goes when the program ends; on a cluster a folder of one machine would be lost.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if known := spark.conf.get("spark.lakeloom.scratch", None):
        return known
    own = tempfile.mkdtemp(prefix="lakeloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.lakeloom.scratch", own)
    return own


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that all executors share, its lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def local_session(app: str = "lakeloom", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that the tests and the bench share."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("LAKELOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
