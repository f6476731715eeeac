"""Session settings, sessions of our own, folders every executor shares."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def start_session(settings: Mapping[str, str]) -> SparkSession:
    """A session built with every setting of the spec."""
    builder = SparkSession.builder
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession, settings: Mapping[str, str]) -> list[str]:
    """Set what a running session still lets us set; return the keys it refused.

    Settings Spark fixes at start-up (master, serializer, hadoop and yarn keys) have to be given
    to ``spark-submit`` or to ``start_session``.
    """
    refused = []
    for key, value in settings.items():
        try:
            spark.conf.set(key, value)
        except AnalysisException:
            refused.append(key)
    if refused:
        log.warning("fixed at session start, not applied: %s", ", ".join(refused))
    return refused


@contextmanager
def scoped_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """The settings for the length of a block; what the session had before is put back."""
    before = {key: spark.conf.get(key, None) for key in settings if spark.conf.isModifiable(key)}
    apply_settings(spark, settings)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def private_session(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A session with the caller's settings and database, and some of its own.

    What it sets changes nothing for the caller, nor for the caller's other threads.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, value in settings.items():
        session.conf.set(key, value)
    session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return session


@contextmanager
def moved_to(session: SparkSession, df: DataFrame) -> Iterator[DataFrame]:
    """The same rows as a frame of another session, for the length of a block."""
    if df.sparkSession is session:
        yield df
        return
    name = f"tableflow_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        yield session.table(f"global_temp.{name}")
    finally:
        session.catalog.dropGlobalTempView(name)


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path on it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete what a run of ours has left under its own name, if anything."""
    fs, folder = hadoop_path(spark, path)
    if fs.exists(folder) and not fs.delete(folder, True):
        log.warning("could not remove %s", path)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the session's ``spark.checkpoint.dir``.

    Every executor must see the folder. Only a session on local[n] that names none, as in tests, gets
    a machine-local one; on a cluster the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/tableflow-{label}-{uuid.uuid4().hex}"
