"""Session helpers: one place for the configs every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Configs that matter at scale: AQE re-plans joins and coalesces partitions at
# runtime, the skew-join rule splits a hot key's partition (one key may hold a
# third of the rows), and UTC keeps timestamps comparable across engines.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "vigil") -> SparkSession:
    """Return the active session, or build one with the defaults above."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            builder = builder.config("spark.driver.memory", "8g")
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster the setting names a shared, durable folder. Only where it is
    unset (local tests) do we create one, and then we register it so that
    ``DataFrame.checkpoint()`` works too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="vigil-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root.rstrip("/") + "/rdd")
    return root.rstrip("/")


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it, whatever their
    working folder (on a cluster: the same path, or ship it with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root for written tables."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` once to the shared folder and read it back, so that every
    branch that uses it sees the same rows."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df):
    """Cut a long lineage with a reliable checkpoint in the shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


__all__ = ["get_session", "checkpoint_root", "importable", "shared_dir", "materialize", "cut_lineage"]
