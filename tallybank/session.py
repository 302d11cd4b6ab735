"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(app: str = "tallybank", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with this project's defaults. On a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return use_utc(spark)


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are read and bucketed in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in `spark.checkpoint.dir`.

    Only a local session without the setting falls back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return local_dir(spark.sparkContext.applicationId)


@cache
def local_dir(application: str) -> str:
    """One temporary folder per local application."""
    return tempfile.mkdtemp(prefix=f"tallybank-{application}-")


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one."""
    return f"{shared_dir(spark)}/tallybank-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the application's folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that this application wrote to `scratch_path`; results that still read it end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def use_checkpoints(spark: SparkSession) -> None:
    """Point `DataFrame.checkpoint` at the shared folder unless the cluster already did."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


@contextmanager
def session_conf(spark: SparkSession, conf: Mapping[str, object]) -> Iterator[None]:
    """Settings for one block; the session is shared, so the old values come back afterwards."""
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
