"""Session set-up and session-level settings shared by every job."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Session settings of this library, read with `spark.conf.get` and a default.
BROADCAST_BYTES = "spark.basketmarts.broadcastBytes"
ROWS_PER_SPLIT = "spark.basketmarts.rowsPerSplit"

DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024
DEFAULT_ROWS_PER_SPLIT = 4_000_000


def build_session(app_name: str, **settings: str) -> SparkSession:
    """Get or create a session. Environment variables and `settings` only fill in
    what the caller names; anything else stays as the cluster configured it.
    """
    builder = SparkSession.builder.appName(app_name)
    from_environment = {
        "spark.master": os.getenv("SPARK_MASTER"),
        "spark.driver.memory": os.getenv("SPARK_DRIVER_MEMORY"),
        "spark.sql.shuffle.partitions": os.getenv("SPARK_SHUFFLE_PARTITIONS"),
        "spark.eventLog.dir": os.getenv("SPARK_EVENTS_DIR"),
    }
    if from_environment["spark.eventLog.dir"]:
        from_environment["spark.eventLog.enabled"] = "true"
    for name, value in {**from_environment, **settings}.items():
        if value is not None:
            builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def scoped_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Change SQL settings for a block and put the former values back.

    Dots in setting names are written as double underscores:
    `scoped_conf(spark, spark__sql__adaptive__enabled="false")`.
    """
    wanted = {name.replace("__", "."): value for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def empty_stages_kept(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution otherwise cuts off a stage that made no rows, and with it what was
    observed there: how many rows it had read."""
    key = "spark.sql.adaptive.optimizer.excludedRules"
    rule = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    excluded = [r for r in (spark.conf.get(key, None) or "").split(",") if r]
    with scoped_conf(spark, **{key.replace(".", "__"): ",".join([*excluded, rule])}):
        yield


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES, str(DEFAULT_BROADCAST_BYTES)))


def rows_per_split(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_SPLIT, str(DEFAULT_ROWS_PER_SPLIT)))


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="basket-marts-")


def _scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    A local session that names none (a test, a laptop) gets a temporary folder; on a
    cluster other machines could not see one, so there the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/basket_marts"


_owned: set[str] = set()


def session_root(spark: SparkSession) -> str:
    """This session's folder in the scratch folder. It is deleted when the driver's JVM ends."""
    root = f"{_scratch_root(spark)}/{spark.sparkContext.applicationId}"
    if root not in _owned:
        _owned.add(root)
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the session's scratch folder."""
    return f"{session_root(spark)}/{label}-{uuid.uuid4().hex}"


def session_path(spark: SparkSession, label: str, source: str) -> str:
    """The path in the scratch folder that this session keeps for what it makes of `source`:
    to be overwritten, so that repeated runs leave one copy.
    """
    key = hashlib.sha256(source.encode()).hexdigest()[:16]
    return f"{session_root(spark)}/{label}-{key}"


@contextmanager
def in_scratch(rows, label: str) -> Iterator:
    """Rows that a block uses several times: written to the scratch folder once, read back, and
    removed after the block."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        remove_folder(spark, path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Move a finished folder to where another may be. The other is set aside first and put
    back if the move fails, so that one of them is always there whole.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    new, place = path(staged), path(target)
    aside = path(place.getParent(), f".{place.getName()}-{uuid.uuid4().hex}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place.getParent())
    had_one = files.exists(place)
    if had_one and not files.rename(place, aside):
        raise OSError(f"cannot set {target} aside")
    try:
        if not files.rename(new, place):
            raise OSError(f"cannot move {staged} to {target}")
    except BaseException:
        if had_one:
            files.rename(aside, place)
        raise
    if had_one:
        files.delete(aside, True)
