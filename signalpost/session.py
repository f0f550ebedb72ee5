"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "signalpost", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators rely on; extra settings as keyword arguments."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    ``spark.checkpoint.dir`` names it.  A private folder is made only for a local session: on a
    cluster a machine-local folder would be lost with its machine, so there the setting is required.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="signalpost-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder for a table that is written and read back."""
    return f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result is stored once and survives the loss of executors."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
