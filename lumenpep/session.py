"""Sessions and shipping the package to executors."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "lumenpep", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings: UTC, adaptive execution, and more where conf says so."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or a temporary one where that is unset and
    all run in one process. On any other master an unset folder is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lumenpep-")
        spark.sparkContext.setCheckpointDir(found)
        atexit.register(shutil.rmtree, found[len("file://"):], ignore_errors=True)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/lumenpep/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """A table written to the shared folder and read again: made once, however often it is read."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession, root: str) -> None:
    """Sends the package to the executors, once a session, unless their Python path has it: workers start in the driver's
    folder on one machine, and take its PYTHONPATH."""
    context = spark.sparkContext
    here = context.master.startswith("local[") and os.path.abspath(os.getcwd()) == os.path.abspath(root)
    if here or _jvm_has(context, root) or getattr(context, "_lumenpep_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="lumenpep-")
    path = os.path.join(folder, "lumenpep.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(os.path.join(root, "lumenpep")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(at, n), os.path.relpath(os.path.join(at, n), root))
    context.addPyFile(path)
    context._lumenpep_shipped = True


def _jvm_has(context, root: str) -> bool:
    """Whether the session's own environment, which local executors share, has root on its Python path."""
    found = context._jvm.System.getenv("PYTHONPATH") or ""
    return os.path.abspath(root) in [os.path.abspath(p) for p in found.split(os.pathsep) if p]
