"""Speed-reading ingest: message stream -> typed readings -> keyed table.

Rows whose key is already stored are ignored, so replaying a topic or a batch
leaves the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kerbside.session import dropped, written
from kerbside.sources.messages import structured_readings

KEY = ("LinkID", "data_collected")
DAY = "collected_day"
BATCH = "batch"
BROKER_ORDER = ("partition", "offset")
MOST_PER_BATCH = 50_000_000
MOST_FILES = 10_000
FILE_ROWS = 1_000_000
DAY_FILES = 24
MARKS = 4096
MOST_TASKS = 2000
RAW = "raw"
RAW_SCHEMA = "value string, timestamp timestamp, offset bigint"


def broker_stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", most_per_batch: int = MOST_PER_BATCH
) -> DataFrame:
    """Raw messages of a topic, at most so many a batch; needs the Kafka connector on the class path.

    Offsets repeat across partitions, so readings are ordered by partition and offset.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", most_per_batch)
        .load()
        .select("value", "timestamp", "partition", "offset")
    )


def folder_stream(
    spark: SparkSession, folder: str, fmt: str = "json", schema: str = RAW_SCHEMA, most_files: int = MOST_FILES
) -> DataFrame:
    """The same raw messages from files that land in a folder, at most so many files a batch."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", most_files).load(folder)


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Earliest row of every key.

    Written as an aggregate rather than a row number so duplicates of a hot
    key collapse before the shuffle.
    """
    rest = [c for c in rows.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return rows.groupBy(*key).agg(first).select(*key, "_first.*").select(*rows.columns)


def absent_from(rows: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.join(stored.select(*key), list(key), "left_anti")


def insert_if_absent(
    rows: DataFrame, stored: DataFrame, key: Sequence[str] = KEY, order: Sequence[str] = ("offset",)
) -> DataFrame:
    """Rows to append: the first of each new key."""
    return absent_from(first_per_key(rows, key, order), stored, key)


def split_rejects(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings with and without a usable link id."""
    return readings.filter(F.col("LinkID").isNotNull()), readings.filter(F.col("LinkID").isNull())


def _files_schema() -> str:
    return (
        "version bigint, action string, batch bigint, file string, day date, n bigint, first_seen timestamp, last_seen timestamp, "
        "first_link string, last_link string, marks array<int>"
    )


def key_marks(marks: int = MARKS) -> Column:
    """Which of ``marks`` hash classes a set of keys touches: two sets without a common class share no key."""
    return F.sort_array(F.collect_set(F.pmod(F.xxhash64(*KEY), F.lit(marks)).cast("int")))


@dataclass(frozen=True)
class ReadingsTable:
    """Keyed Parquet table with a commit log; a key is stored once, the first reading wins.

    A batch writes its new rows to a folder of its own, at most ``file_rows``
    in a file and sorted by key, then one commit row per file: day, key ranges
    and the hash classes of its keys. A commit is a single file, so it is there
    whole or not at all; what a failed attempt left is in no commit and is
    never read. A batch that was committed before is not written again.

    The key check reads only files whose ranges and hash classes meet those of
    the batch, so a late message opens the few files of its own time. Readers
    see the files of one version. ``compact`` rewrites days that hold many
    files; the log keeps the older versions readable until ``vacuum``.

    One writer at a time; readers are not disturbed by it. ``order`` decides
    which of two arriving readings is first: by partition and offset where the
    messages have a partition, else by offset.
    """

    path: str
    order: tuple[str, ...] | None = None
    file_rows: int = FILE_ROWS
    day_files: int = DAY_FILES

    @property
    def rejects_path(self) -> str:
        return f"{self.path}-rejects"

    @property
    def log_path(self) -> str:
        return f"{self.path}-commits"

    # --- reading ---

    def log(self, spark: SparkSession) -> DataFrame:
        """All commit rows."""
        return _read_or_empty(spark, self.log_path, _files_schema())

    def version(self, spark: SparkSession) -> int:
        """The newest version; 0 before the first commit."""
        return self.log(spark).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def files(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """Commit rows of the files that make up a version."""
        seen = self.log(spark)
        if version is not None:
            seen = seen.filter(F.col("version") <= version)
        gone = seen.filter("action = 'remove'").select("file").distinct()
        return seen.filter("action = 'add'").join(gone, "file", "left_anti")

    def read(self, spark: SparkSession, version: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The rows of a version (the newest by default)."""
        return self._rows_of(spark, [r["file"] for r in self.files(spark, version).select("file").collect()], schema)

    def _rows_of(self, spark: SparkSession, files: list[str], schema: T.StructType | None = None) -> DataFrame:
        if schema is not None:
            schema = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType()), T.StructField(DAY, T.DateType())])
        if not files:
            return spark.createDataFrame([], schema if schema is not None else _files_schema())
        reader = spark.read.option("basePath", self.path)
        rows = (reader.schema(schema) if schema is not None else reader).parquet(*files)
        return rows.drop("attempt")

    # --- writing ---

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Sink callback of the stream: append the first row of every new key."""
        spark = batch.sparkSession
        if not self.log(spark).filter((F.col("batch") == batch_id) & (F.col("action") != "remove")).isEmpty():
            return
        batch = batch.persist()
        try:
            good, bad = split_rejects(batch)
            bad.withColumn(BATCH, F.lit(batch_id).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(self.rejects_path)
            good = good.drop(RAW)
            order = self.order or (BROKER_ORDER if "partition" in batch.columns else ("offset",))
            fresh = insert_if_absent(good, self._stored_like(spark, good), KEY, order)
            self._commit(spark, self._written(fresh, batch_id), batch_id)
        finally:
            batch.unpersist()

    def _stored_like(self, spark: SparkSession, good: DataFrame) -> DataFrame:
        """Stored rows that may share a key with the batch."""
        what = good.agg(
            F.min("data_collected").alias("first"), F.max("data_collected").alias("last"), F.min("LinkID").alias("low"), F.max("LinkID").alias("high"),
            key_marks().alias("touched"),
        )
        meet = (F.col("first_seen") <= F.col("last")) & (F.col("last_seen") >= F.col("first")) & (F.col("first_link") <= F.col("high")) & (F.col("last_link") >= F.col("low"))
        near = self.files(spark).join(F.broadcast(what), meet).filter(F.arrays_overlap("marks", "touched"))  # one row, of at most MARKS classes
        return self._rows_of(spark, [r["file"] for r in near.select("file").collect()], good.schema)

    def _written(self, rows: DataFrame, batch_id: int) -> str:
        """Store rows in a new folder, in sorted files of bounded size; a day has no more files than its rows need."""
        folder = f"{self.path}/{BATCH}={batch_id}/attempt={uuid.uuid4().hex}"
        rows = written(rows.withColumn(DAY, F.to_date("data_collected")), "readings")
        days = rows.groupBy(DAY).agg(F.count("*").alias("n"))
        pieces = days.select(DAY, F.ceil(F.col("n") / self.file_rows).cast("int").alias("pieces"))
        total = pieces.agg(F.sum("pieces")).first()[0] or 1
        # Classes of the link id cut a large day; a file is one class.
        cut = rows.join(F.broadcast(pieces), DAY).withColumn("piece", F.pmod(F.xxhash64("LinkID", "data_collected"), F.col("pieces")))
        laid = cut.repartition(min(total, MOST_TASKS), DAY, "piece").sortWithinPartitions(DAY, "piece", *KEY)
        laid.drop("pieces", "piece").write.partitionBy(DAY).option("maxRecordsPerFile", 2 * self.file_rows).parquet(folder)
        return folder

    def _commit(self, spark: SparkSession, folder: str, batch_id: int, removed: DataFrame | None = None) -> int:
        """Append one version to the log: the folder's files, and those that they replace."""
        version = self.version(spark) + 1
        found = _read_or_empty(spark, folder, None)
        columns = ["version", "action", "batch", "file", "day", "n", "first_seen", "last_seen", "first_link", "last_link", "marks"]
        if "data_collected" in found.columns:
            added = found.groupBy(F.col("_metadata.file_path").alias("file")).agg(
                F.max(DAY).cast("date").alias("day"), F.count("*").alias("n"), F.min("data_collected").alias("first_seen"), F.max("data_collected").alias("last_seen"),
                F.min("LinkID").alias("first_link"), F.max("LinkID").alias("last_link"), key_marks().alias("marks"),
            ).withColumn("action", F.lit("add"))
        else:
            # An empty batch is committed as well, so that it is not looked at again.
            added = spark.createDataFrame([], _files_schema()).drop("version", "batch")
        rows = added.withColumns({"version": F.lit(version).cast("bigint"), "batch": F.lit(batch_id).cast("bigint")}).select(*columns)
        head = spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit("commit").alias("action"), F.lit(batch_id).cast("bigint").alias("batch"))
        rows = rows.unionByName(head, allowMissingColumns=True)
        if removed is not None:
            rows = rows.unionByName(removed.withColumns({"version": F.lit(version).cast("bigint"), "action": F.lit("remove")}).select(*columns))
        rows.coalesce(1).write.mode("append").parquet(self.log_path)
        return version

    def compact(self, spark: SparkSession) -> int | None:
        """Rewrite every day with more than ``day_files`` files into as few as its rows need; gives the new version."""
        live = self.files(spark)
        many = live.groupBy("day").agg(F.count("*").alias("files"), F.sum("n").alias("rows"))
        least = F.ceil(F.col("rows") / self.file_rows)
        days = many.filter((F.col("files") > self.day_files) & (F.col("files") > least)).select("day")
        old = written(live.join(F.broadcast(days), "day").select(*live.columns), "compacted")  # one row a day
        names = [r["file"] for r in old.select("file").collect()]
        if not names:
            return None
        batch_id = -1 - self.version(spark)
        rows = self._rows_of(spark, names).withColumnRenamed(BATCH, "_batch").drop(DAY)
        return self._commit(spark, self._written(rows.drop("_batch"), batch_id), batch_id, old)

    def vacuum(self, spark: SparkSession, versions: int = 1) -> int:
        """Delete files that none of the last ``versions`` versions holds; gives their number."""
        newest = self.version(spark)
        kept = {r["file"] for v in range(max(1, newest - versions + 1), newest + 1) for r in self.files(spark, v).select("file").collect()}
        known = {r["file"] for r in self.log(spark).filter("action = 'add'").select("file").collect()}
        for name in known - kept:
            dropped(spark, name)
        return len(known - kept)


def _read_or_empty(spark: SparkSession, path: str, schema: str | None) -> DataFrame:
    """Parquet at a path; no rows where nothing was written yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema or _files_schema())


def run_to_exhaustion(
    raw: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process what has arrived since the last run, then stop.

    Progress is kept under ``checkpoint``, so an hourly run reads only new
    messages instead of the topic from its start.
    """
    query = (
        structured_readings(raw, RAW)
        .writeStream.outputMode("append")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def ingest(raw: DataFrame, table: ReadingsTable, checkpoint: str) -> StreamingQuery:
    return run_to_exhaustion(raw, table.write_batch, checkpoint)
