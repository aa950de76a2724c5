"""Session defaults and the shared folder for checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "8", app: str = "vetrail", memory: str = "16g") -> SparkSession:
    """A local session for tests and the benchmark. On a cluster, use the session it gives."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def with_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    For a session started outside the repository; a cluster gets the package as any other dependency.
    """
    home = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        joined = os.pathsep.join([home, *filter(None, paths)])
        spark.sparkContext.environment["PYTHONPATH"] = joined
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read, named by the cluster in ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, which only a local master may do.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="vetrail-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def materialized(rows: DataFrame) -> DataFrame:
    """Write a frame to the shared folder once and go on from there, with the lineage cut.

    A written table rather than a checkpoint: later reads take only the columns they need.
    """
    path = fresh_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def fresh_folder(spark: SparkSession) -> str:
    """A new folder inside the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
