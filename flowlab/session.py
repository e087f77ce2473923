"""Session settings and the place where lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "flowlab", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FLOWLAB_DRIVER_MEMORY", "10g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in tasks refer to it by name; workers need not have it
    installed nor share the driver's working directory.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="flowlab-package-"), "flowlab.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Rows go to Python in batches of about ``size`` bytes, for whole texts.

    By default a batch has up to 10,000 rows or 64 MB. A task holds a batch several
    times (in both processes, as Arrow and as objects), and neither the JVM nor a
    worker gives all of that back for the stages that follow.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable folder named by the cluster.

    Only where none is configured and all tasks run in this process (a local
    test run) a temporary one is made; on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not configured and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = configured or tempfile.mkdtemp(prefix="flowlab-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the files.

    The files survive the loss of executors, unlike cached blocks.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet beside the checkpoints and continue from the files.

    Like :func:`cut_lineage`, for tables of which later passes read few columns.
    """
    folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def use_utc(spark: SparkSession) -> None:
    """Epoch arithmetic on naive timestamps is only defined in one zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
