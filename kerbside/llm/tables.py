"""Reading the given tables and storing intermediate ones."""

from __future__ import annotations

import posixpath
import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the folder all executors share and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared one, as a URI any file system client can open."""
    base = shared_dir(spark)
    if not urlsplit(base).scheme:
        base = "file://" + posixpath.abspath(base)
    return f"{base}/{label}-{uuid.uuid4().hex}"


def numbered_in_order(df: DataFrame, order: list, label: str) -> DataFrame:
    """Add ``ordinal``: 1, 2, 3, ... in ``order`` over the whole table.

    A range-partitioned sort is written once with each row's place in its
    partition; the sizes of the partitions ahead, one row a partition, are
    added. No task holds more than one range.
    """
    place = F.monotonically_increasing_id()  # the partition in the upper bits, the place in it in the lower 33
    laid = stored(df.orderBy(*order).withColumn("__place", place), label)
    part, inside = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    sizes = laid.groupBy(part.alias("__part")).agg((F.max(inside) + 1).alias("__size"))
    ahead = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(ahead), F.lit(0)).alias("__ahead"))
    joined = laid.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return joined.select(*df.columns, (inside + F.col("__ahead") + 1).alias("ordinal"))


def unused(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    while name in df.columns:
        name += "_"
    return name


def lowered(column):
    """A-Z to a-z and nothing else, whatever the locale."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, upper, upper.lower())
