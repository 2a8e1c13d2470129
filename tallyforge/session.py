"""Session helpers: a local builder for tests and benches, and the shared
scratch folder every stage that cuts lineage writes to."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tallyforge", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TALLYFORGE_DRIVER_MEMORY", "6g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. It is the session's
    spark.checkpoint.dir. Only on one machine (a local master) a temporary folder is
    made where it is unset, and removed when Python ends; elsewhere that raises."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not configured and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not configured:
            configured = tempfile.mkdtemp(prefix="tallyforge-")
            atexit.register(shutil.rmtree, configured, ignore_errors=True)
        sc.setCheckpointDir(configured)
    return configured or sc.getCheckpointDir()


#: Stored tables of this process that are not cleared yet.
_written: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Delete the tables `stored` has written, once no frame that reads them is needed
    any more; how many there were."""
    count = len(_written)
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder and return it without lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df as parquet in the shared folder and read it back: columnar,
    with statistics, readable after the loss of any executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once an application, so
    that they need no copy of it on their path."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tallyforge-code-"), "tallyforge.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("tallyforge", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(archive)  # Spark copies it from the driver to each executor
    _shipped.add(app)
