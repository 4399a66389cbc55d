import json

from pyspark.sql import functions as F

from kerbside.streaming import ingest as I


def message(offset, value, ts="2024-01-01 00:00:00"):
    return json.dumps({"value": value, "timestamp": ts, "offset": offset})


def reading(link, band):
    return json.dumps({"LinkID": link, "RoadName": "R", "SpeedBand": band})


def test_ingest_keeps_first_of_each_key_and_reruns_cleanly(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    first = [
        message(1, reading("a", 3)), message(2, reading("a", 3)), message(3, reading("a", 7)),
        message(4, "{broken"), message(5, reading("b", "4")), message(6, reading("c", 3.5)),
    ]
    (landing / "one.json").write_text("\n".join(first))
    table = I.ReadingsTable(str(tmp_path / "readings"))

    def run():
        raw = I.folder_stream(spark, str(landing))
        I.ingest(raw, table, str(tmp_path / "progress"))
        rows = spark.read.parquet(table.path).orderBy("offset").collect()
        return [(r["LinkID"], r["SpeedBand"], r["offset"]) for r in rows]

    expected = [("a", 3, 1), ("b", None, 5), ("c", None, 6)]
    assert run() == expected
    assert run() == expected  # nothing new: no batch
    later = [message(7, reading("a", 1)), message(8, reading("a", 2), "2024-01-01 01:00:00"), message(9, reading("d", 1))]
    (landing / "two.json").write_text("\n".join(later))
    assert run() == expected + [("a", 2, 8), ("d", 1, 9)]
    assert spark.read.parquet(table.rejects_path).count() == 1
    hours = spark.read.parquet(table.path).filter("offset = 8").select(F.hour("data_collected")).first()[0]
    assert hours == 9  # one o'clock UTC, eight hours ahead


def test_replayed_batch_changes_nothing(spark, tmp_path):
    table = I.ReadingsTable(str(tmp_path / "readings"))
    rows = [("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-01 00:00:00", 2), ("b", "2024-01-02 00:00:00", 3)]
    batch = spark.createDataFrame(rows, "LinkID string, data_collected string, offset bigint").withColumn(
        "data_collected", F.to_timestamp("data_collected")
    )
    for batch_id in (0, 0, 1):
        table.write_batch(batch, batch_id)
        assert sorted(r["offset"] for r in spark.read.parquet(table.path).collect()) == [1, 3]


def hours(spark, rows):
    return spark.createDataFrame(rows, "LinkID string, data_collected string, offset bigint, partition int").withColumn(
        "data_collected", F.to_timestamp("data_collected")
    )


def contents(table, spark, version=None):
    return sorted((r["LinkID"], str(r["data_collected"]), r["offset"]) for r in table.read(spark, version).collect())


def test_versions_replay_and_compaction(spark, tmp_path):
    table = I.ReadingsTable(str(tmp_path / "readings"), file_rows=50, day_files=2)
    first = hours(spark, [(f"l{i % 40}", f"2024-01-01 0{i % 3}:00:00", i, 0) for i in range(200)])
    second = hours(spark, [(f"l{i % 60}", f"2024-01-01 0{2 + i % 2}:00:00", 1000 + i, 0) for i in range(200)] + [("late", "2023-12-31 00:00:00", 5000, 0)])
    table.write_batch(first, 0)
    after_first = contents(table, spark)
    assert len(after_first) == 120
    table.write_batch(second, 1)
    both = contents(table, spark)
    stored = {r[:2] for r in after_first}
    assert [r for r in both if r[:2] in stored] == after_first and len({r[:2] for r in both}) == len(both)
    table.write_batch(second, 1)  # a replay
    table.write_batch(first, 7)  # the same readings in a new batch
    assert contents(table, spark) == both and table.version(spark) == 3
    for n in range(3):
        table.write_batch(hours(spark, [(f"x{n}", "2024-01-01 05:00:00", 9000 + n, 0)]), 10 + n)
    whole = contents(table, spark)
    assert len(whole) == len(both) + 3
    version = table.compact(spark)
    assert contents(table, spark) == whole and version == 7
    for r in table.files(spark).groupBy("day").agg(F.count("*").alias("files"), F.sum("n").alias("n")).collect():
        assert r["files"] <= max(2, -(-r["n"] // 50))
    # Older versions stay readable until they are cleared away.
    assert contents(table, spark, 1) == after_first and contents(table, spark, 3) == both
    assert table.compact(spark) is None
    assert table.vacuum(spark) > 0 and contents(table, spark) == whole


def test_a_late_message_opens_only_files_of_its_time(spark, tmp_path, monkeypatch):
    table = I.ReadingsTable(str(tmp_path / "readings"))
    for day in range(1, 6):
        table.write_batch(hours(spark, [(f"l{i}", f"2024-01-0{day} 00:00:00", 10 * day + i, 0) for i in range(5)]), day)
    opened = []
    inner = I.ReadingsTable._rows_of
    monkeypatch.setattr(I.ReadingsTable, "_rows_of", lambda self, s, files, schema=None: (opened.append(len(files)), inner(self, s, files, schema))[1])
    table.write_batch(hours(spark, [("l1", "2024-01-02 00:00:00", 99, 0), ("l9", "2024-01-02 00:00:00", 98, 0)]), 9)
    assert opened == [1]
    assert ("l1", "2024-01-02 00:00:00", 21) in contents(table, spark) and ("l9", "2024-01-02 00:00:00", 98) in contents(table, spark)


def test_what_a_failed_attempt_left_is_not_read(spark, tmp_path, monkeypatch):
    table = I.ReadingsTable(str(tmp_path / "readings"))
    batch = hours(spark, [("a", "2024-01-01 00:00:00", 1, 0)])

    def fails(*given, **more):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(I.ReadingsTable, "_commit", fails)
        try:
            table.write_batch(batch, 0)
        except RuntimeError:
            pass
    assert table.files(spark).count() == 0
    table.write_batch(batch, 0)
    assert contents(table, spark) == [("a", "2024-01-01 00:00:00", 1)]


def test_a_tie_across_partitions_goes_to_the_lower_partition(spark, tmp_path):
    table = I.ReadingsTable(str(tmp_path / "readings"))
    table.write_batch(hours(spark, [("a", "2024-01-01 00:00:00", 4, 2), ("a", "2024-01-01 00:00:00", 4, 1), ("a", "2024-01-01 00:00:00", 9, 0)]), 0)
    assert [(r["offset"], r["partition"]) for r in table.read(spark).collect()] == [(9, 0)]


def test_rejects_can_be_read(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "one.json").write_text("\n".join([message(1, reading("a", 3)), message(2, "{broken"), message(3, "null")]))
    table = I.ReadingsTable(str(tmp_path / "readings"))
    I.ingest(I.folder_stream(spark, str(landing)), table, str(tmp_path / "progress"))
    assert sorted(r["raw"] for r in spark.read.parquet(table.rejects_path).collect()) == ["null", "{broken"]
    assert "raw" not in table.read(spark).columns
