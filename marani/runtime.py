"""Session defaults and the places where intermediate tables may live."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """See to it that Python workers can import this package: where PYTHONPATH doesn't lead to it, it is sent to them, once for each context."""
    package = os.path.dirname(os.path.abspath(__file__))
    root, name = os.path.split(package)
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if root in known or getattr(context, "_marani_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="marani-"), f"{name}.zip")  # read by the driver's file server only
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), root))
    context.addPyFile(archive)
    context._marani_shipped = True


def local_session(cpus: int | None = None, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    n = str(cpus or os.cpu_count() or 4)
    base = {
        "spark.master": f"local[{n}]",
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": n,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = SparkSession.builder.config(map=base | conf).getOrCreate()
    ship(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one of our own where that is unset and the master is local.

    On a cluster a folder of the driver's machine would be lost to the executors, so there an unset one is an error."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="marani-"))
    return context.getCheckpointDir()


def own_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables within the shared one. It is removed when the driver's process ends."""
    context = spark.sparkContext
    path = f"{shared_dir(spark)}/marani/{context.applicationId}"
    known = getattr(context, "_marani_folders", None)
    if known is None:
        known = context._marani_folders = set()
        atexit.register(clear, context)
    known.add(path)
    return path


def clear(context: SparkContext) -> None:
    """Remove the intermediate tables of an application: results that still read them can't be read any more."""
    for path in sorted(getattr(context, "_marani_folders", ())):
        try:
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration() if context._jsc else context._jvm.org.apache.hadoop.conf.Configuration()).delete(at, True)
        except Exception:  # noqa: BLE001, S110 - the JVM may be gone already
            pass


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write df once as a table in the shared folder and read it back, so that later jobs don't repeat its work.

    The files survive the loss of any executor."""
    path = f"{own_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A table that comes in fewer partitions than there are cores, as a few large files do, is spread over them before costly
    work on its rows. A table with enough partitions passes as it is, and so does the result of a shuffle, of which the
    partitions aren't known before it has run."""
    if "Adaptive" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
