"""Session defaults and tables kept in the shared folder."""

from __future__ import annotations

import os
import uuid
import zipfile

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def spark_session(app_name: str = "gridcensus", master: str | None = None,
                  **conf: str) -> SparkSession:
    """Build a session; keyword names use ``__`` where the setting has a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset it becomes a folder of the warehouse, which executors share as well;
    a machine's own temporary folder is never taken. A warehouse on the driver's own disk is
    refused unless the executors are on the same machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        master = spark.conf.get("spark.master", "local")
        if folder.startswith(("file:", "/")) and not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_STORED: list[str] = []


def stored_path(spark: SparkSession) -> str:
    """A new path in the shared folder, which ``release_stored`` deletes with the rest."""
    path = f"{shared_folder(spark)}/stored/{uuid.uuid4().hex}"
    _STORED.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The copy survives the loss of executors, keeps columns apart for pruning, and gives the
    planner true sizes. ``release_stored`` deletes the copies once their readers are done.
    """
    spark = df.sparkSession
    path = stored_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_paths() -> list[str]:
    """Copies made in this process and not released yet, oldest first."""
    return list(_STORED)


def release_stored(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete the copies ``cut_lineage`` made in this process, or those named; returns how many."""
    count = 0
    for name in stored_paths() if paths is None else paths:
        _STORED.remove(name)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        count += bool(files.delete(path, True))
    return count


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers of ``spark``, once per application.

    Functions that run in Python workers are looked up there by module name, so the package must
    be importable wherever a worker starts.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.join(SparkFiles.getRootDirectory(), "package")
    os.makedirs(folder, exist_ok=True)
    archive = os.path.join(folder, os.path.basename(package) + ".zip")
    with zipfile.ZipFile(archive, "w") as out:
        for top, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
