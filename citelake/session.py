"""Session defaults and the shared scratch area."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Local folders made for single-JVM sessions, by application.
_OWN: dict[str, str] = {}
_SCRATCH: set[str] = set()


def build_session(app: str = "citelake", **conf: str) -> SparkSession:
    """A session with the engine's defaults; keyword `conf` uses `_` for `.`."""
    builder = SparkSession.builder.appName(app)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from `spark.checkpoint.dir`.

    Only a single-JVM session may go without that setting; it then gets a local folder, once.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _OWN:
        _OWN[application] = tempfile.mkdtemp(prefix="citelake-")
        atexit.register(shutil.rmtree, _OWN[application], ignore_errors=True)
    return _OWN[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in the application's own part of it, which is deleted when the driver ends."""
    base = f"{shared_dir(spark).rstrip('/')}/citelake/{spark.sparkContext.applicationId}"
    if base not in _SCRATCH:
        _SCRATCH.add(base)
        fs, path = hadoop_path(spark, base)
        atexit.register(_delete, fs, path)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def _delete(fs, path) -> None:
    with suppress(Exception):  # the JVM may be gone already
        fs.delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, survives lost executors, keeps column pruning."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hadoop_path(spark: SparkSession, path: str):
    """The (file system, path) pair of the JVM for `path`."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)
