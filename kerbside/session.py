"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "kerbside", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; anything in ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder is used only when the setting is absent and the
    session is local, as in unit tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = os.path.join(tempfile.gettempdir(), "kerbside-shared")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are compared as UTC everywhere, so the session zone is fixed."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def written(df: DataFrame, label: str = "cut") -> DataFrame:
    """Store ``df`` in the shared folder and read it back.

    Cuts the lineage of iterative jobs in a way that survives lost executors,
    and gives Catalyst the true size of the data for later join choices.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that this library wrote, on whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
