"""Session settings and reliable materialisation."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. Everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "matchlake", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Tables written by `materialise` that nobody has released yet.
_stored: list[str] = []


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in spark.checkpoint.dir.

    Only a session in a single process, which has no other machines, may do without the setting.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="matchlake-checkpoint-")
    context.setCheckpointDir(shared)


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the checkpoint folder and continue from the stored rows.

    Used where two passes must see the very same partitions, and where many passes would
    repeat costly work. The rows outlive any executor, and as parquet they keep column
    pruning and a known size. `release_stored` deletes the table.
    """
    ensure_checkpoint_dir(df.sparkSession)
    folder = df.sparkSession.sparkContext.getCheckpointDir()
    path = f"{folder}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _stored.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(*jobs: Callable) -> list:
    """Results of actions that do not need each other, begun together, so that one fills the cores another leaves idle.

    All of them come to an end; then the first error is raised.
    """
    inheriting = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(jobs)) as pool:
        begun = [pool.submit(inheriting(job)) for job in jobs]
    return [job.result() for job in begun]


def discard(df: DataFrame) -> None:
    """Delete the table that `materialise` wrote for this frame, once no other frame reads it."""
    files = df.inputFiles()
    path = next((p for p in _stored if files and f"/{p.rsplit('/', 1)[1]}/" in files[0]), None)
    if path:
        _stored.remove(path)
        delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the checkpoint folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release_stored(spark: SparkSession) -> int:
    """Delete all tables that `materialise` wrote, once no frame that reads them is needed."""
    released = len(_stored)
    while _stored:
        delete(spark, _stored.pop())
    return released
