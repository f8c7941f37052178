"""Session settings used by the tests and the bench; a cluster brings its own."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("resight")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RESIGHT_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_OWN_DIR = "resight.scratch.dir"


def scratch_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the shared folder the cluster names in
    ``spark.checkpoint.dir``.

    Without one, a session on one machine (``local[...]``) makes a fresh local folder and remembers
    it. On a cluster that would scatter the files over the executors' disks, so it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_DIR, None)
    if not shared:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {master}")
        shared = tempfile.mkdtemp(prefix="resight-")
        spark.conf.set(_OWN_DIR, shared)
    return shared.rstrip("/")


def fresh_path(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/{uuid.uuid4().hex}"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame) -> DataFrame:
    """Write a table to the scratch folder and read it back: cuts the lineage, survives lost executors.

    The shuffle files of the write go as soon as it ends; else they stay until the driver's memory is collected.
    """
    path, conf = fresh_path(df.sparkSession), df.sparkSession.conf
    before = conf.get(_FREE_SHUFFLES, "false")
    conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_FREE_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables written by :func:`saved` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def saved_counting(df: DataFrame, *metrics: Column) -> tuple[DataFrame, dict[str, object]]:
    """As :func:`saved`, with aggregates of what was written, taken by the writing job itself."""
    seen = Observation()
    out = saved(df.observe(seen, *metrics))
    return out, seen.get


def _state(spark: SparkSession, folder: str) -> str:
    """Path, size and time of the tables in a folder, so that changed input is noticed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    seen = sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)
    return uuid.uuid5(uuid.NAMESPACE_URL, repr(seen)).hex


def stored(spark: SparkSession, name: str, folder: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table derived from the tables in ``folder``, written once per session and state of the folder.

    Readers get column pruning and filter pushdown, a lost executor re-reads files instead of
    recomputing, and the lineage is cut.
    """
    key = f"resight.stored.{name}.{_state(spark, folder)}"
    path = spark.conf.get(key, None)
    if path:
        try:
            return spark.read.parquet(path)
        except AnalysisException:  # the scratch folder was cleared meanwhile
            pass
    path = fresh_path(spark)
    build().write.parquet(path)
    spark.conf.set(key, path)
    return spark.read.parquet(path)
