"""Session settings and the shared scratch folder.

Settings are runtime SQL settings only: cluster size, memory and the master are the
submitter's business.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Only a new session can take these.
STATIC_SETTINGS = {
    # Call sites in error messages double the time to build a long plan from Python.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every pipeline here relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "stallbook", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the benchmark. No web page, no open port."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cores)
        .config(CHECKPOINT_DIR, _own_folder(app))
    )
    for key, value in {**STATIC_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@cache
def _own_folder(application: str) -> str:
    """A folder of a local session's own, gone when Python ends."""
    folder = tempfile.mkdtemp(prefix=f"stallbook-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    A local session that names none gets one of its own; anywhere else that is an error.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        shared = _own_folder(spark.sparkContext.applicationId)
    return f"{shared.rstrip('/')}/stallbook/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


_tables: list[str] = []


def scratch_table(label: str) -> str:
    """A fresh table name, which ``clear_scratch`` drops."""
    _tables.append(f"{label}_{uuid.uuid4().hex}")
    return _tables[-1]


def clear_scratch(spark: SparkSession) -> None:
    """Remove all tables and folders that this application has made below the shared folder.

    For the end of an application: results read from them are gone.
    """
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a pipeline step as a table in the shared folder and read it back.

    For a step that several later steps read: it is computed once, later plans start from a
    plain scan, and a lost executor costs only its own tasks.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
