"""Local session for tests and benchmarks, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


def local_session(cpus: int | str = "*", app: str = "termlight") -> SparkSession:
    """A ``local[cpus]`` session; on a cluster, pass the cluster's own session instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, where the driver and the executors are one process, may go without the
    setting; it then gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="termlight-")
    return _local_folders[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_folder(spark)}/termlight/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, name: str):
    """Write ``df`` to the shared folder and read it back, so that a lost executor cannot undo it."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
