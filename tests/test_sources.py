import json

import pytest
from pyspark.sql import functions as F

from kerbside.functions.scalars import traffic_multiplier
from kerbside.operators import districts as D
from kerbside.operators import fleet, geo, traffic
from kerbside.sources import files, fitted, messages
from kerbside.sources.jdbc import JdbcTable

# A known day of hourly totals.
DAY = [277, 276, 273, 280, 279, 277, 282, 302, 374, 400, 346, 326, 339, 294, 340, 323, 328, 330, 364, 375, 332, 298,
       308, 283]


def test_known_day_gives_known_multipliers(spark, tmp_path):
    path = tmp_path / "day.json"
    path.write_text(json.dumps({f"2024-10-05 {h:02}:00:00": v for h, v in enumerate(DAY)}))
    series = messages.read_hourly_series(spark, str(path))
    hours = traffic.in_time_order(series).withColumnRenamed("ordinal", "hour")
    picked = traffic.planning_hours(hours).orderBy("hour").select(traffic_multiplier(F.col("total")).alias("m")).collect()
    assert [r["m"] for r in picked] == [1.25, 1.25, 1.25, 1.05, 1.25, 1.1, 1.25, 1.25, 1.5, 1.5]


def test_snapshot_log_totals(spark, tmp_path):
    path = tmp_path / "log.json"
    log = {f"2024-01-01 0{h}:00:00": [{"EstTime": h, "Name": "x"}, {"EstTime": 10}] for h in range(6)}
    path.write_text(json.dumps(log, indent=1))
    totals = traffic.skip_first(traffic.snapshot_totals(messages.read_snapshots(spark, str(path))), 4)
    assert sorted(r["total"] for r in totals.collect()) == [14, 15]


def test_sequences_drop_incomplete_tail(spark):
    rows = [(f"2024-01-{1 + i // 24:02} {i % 24:02}:00:00", i) for i in range(24 * 4 + 5)]
    series = spark.createDataFrame(rows, "ts string, total int").withColumn("ts", F.to_timestamp("ts"))
    out = traffic.sequences(series).orderBy("seq").collect()
    assert [r["seq"] for r in out] == [0, 1, 2]
    assert out[1]["inputs"] == list(range(24, 48)) and out[1]["outputs"] == list(range(48, 72))


def test_page_messages_keep_unknown_fields(spark, tmp_path):
    (tmp_path / "page1.json").write_text('{"odata": 1, "value": [{"LinkID": "1", "New": {"a": 1}}, {"LinkID": "2"}]}')
    (tmp_path / "page2.json").write_text('{"value": []}')
    out = messages.page_messages(messages.read_pages(spark, str(tmp_path)))
    assert sorted(r["value"] for r in out.collect()) == ['{"LinkID":"1","New":{"a":1}}', '{"LinkID":"2"}']
    messages.write_messages(out, str(tmp_path / "landing"))
    assert spark.read.text(str(tmp_path / "landing")).count() == 2


VEHICLE_CSV = """,Vehicle_Model,Mileage,Maintenance_History,Reported_Issues,Vehicle_Age,Fuel_Type,Transmission_Type,Engine_Size,Odometer_Reading,Last_Service_Date,Warranty_Expiry_Date,Owner_Type,Insurance_Premium,Service_History,Accident_History,Fuel_Efficiency,Tire_Condition,Brake_Condition
1,Truck,70000.5,Poor,1,1,Diesel,Manual,2000,8000.25,6/4/2023,14/1/2026,Third,19000.5,5,2,11.5,Worn Out,New
2,Truck,80000.5,Good,0,7,Petrol,Automatic,800,9000.25,12/11/2023,1/2/2024,First,18000.5,1,0,14.5,Good,Good
"""


def test_vehicle_csv_round_trip(spark, tmp_path):
    path = tmp_path / "vehicles.csv"
    path.write_text(VEHICLE_CSV)
    rows = files.read_vehicles(spark, str(path))
    encoded = fleet.encoded(rows, "2024-10-26").withColumn("prediction", F.lit(1))
    scored = fleet.scored_fleet(encoded)
    assert scored.columns == ["Truck_ID", *fleet.FEATURES, files.LABEL]
    files.write_csv(scored, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), header=True).orderBy("Truck_ID").collect()
    assert [r["Tire_Condition"] for r in back] == ["0", "1"] and back[0][fleet.MANUAL] == "true"
    assert fleet.text_columns(rows).columns[:2] == ["Vehicle_Model", "Maintenance_History"]
    assert "Mileage" in fleet.number_columns(rows).columns


def test_waste_sheet_and_districts(spark, tmp_path):
    sheet = tmp_path / "waste.csv"
    sheet.write_text(
        "Planning Area of Residence,Subzone,Population,Waste Generated Per Day (kg)\n"
        "Total,Total,9,600.0\nBedok,Total,5,500.0\nBedok,North,5,500.0\nTuas,Total,0,0.0\n"
    )
    columns = [files.SHEET_AREA, files.SHEET_SUBZONE, "Population", files.SHEET_KG]
    totals = D.area_totals(files.read_waste_sheet(spark, str(sheet), columns))
    assert sorted(tuple(r) for r in totals.collect()) == [("Bedok", 500.0), ("Tuas", 0.0)]
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[0, 0], [2, 0], [2, 4], [0, 4], [0, 0]]
    feature = lambda name, kind, coords: {
        "type": "Feature", "properties": {"planning_area": name, "id": 3}, "geometry": {"type": kind, "coordinates": coords}
    }
    path = tmp_path / "districts.json"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [
        feature("Bedok", "Polygon", [square, hole]),
        feature("Tuas", "Polygon", [square]),
        feature("Sea", "MultiPolygon", [[square], [[[10, 0], [12, 0], [12, 2], [10, 2], [10, 0]]]]),
    ]}))
    shaped = geo.with_centroid(files.read_districts(spark, str(path)))
    joined = D.not_empty(D.with_waste(shaped, totals, 2))
    out = {r["planning_area"]: r for r in joined.collect()}
    assert set(out) == {"Bedok", "Sea"} and out["Sea"][files.SHEET_KG] is None
    assert (out["Bedok"]["lon"], out["Bedok"]["lat"]) == (3.0, 2.0)
    assert out["Sea"]["lon"] == pytest.approx((16 * 2 + 4 * 11) / 20)
    assert [r["planning_area"] for r in D.excluding(shaped, ["Sea", "Tuas"]).collect()] == ["Bedok"]


def test_node_waste_rules(spark):
    rows = [(0, 5, "A", 10), (1, 5, "B", 20), (2, 6, "B", 70)]
    snapped = spark.createDataFrame(rows, "ordinal int, node int, planning_area string, kg int")
    first = {r["node"]: (r["planning_area"], r["kg"]) for r in D.node_waste(snapped).collect()}
    assert first == {5: ("B", 20), 6: ("B", 20)}
    total = {r["node"]: r["kg"] for r in D.node_waste(snapped, "sum").collect()}
    assert total == {5: 30, 6: 70}


GRAPHML = """<?xml version="1.0" encoding="utf-8"?>
<graphml><key id="d4" for="node" attr.name="y" attr.type="string"/><key id="d5" for="node" attr.name="x" attr.type="string"/>
<key id="d9" for="edge" attr.name="length" attr.type="string"/><key id="d12" for="edge" attr.name="maxspeed" attr.type="string"/>
<graph edgedefault="directed">
<node id="11"><data key="d4">1.3</data><data key="d5">103.8</data></node>
<node id="12"><data key="d4">1.4</data><data key="d5">103.9</data></node>
<edge source="11" target="12" id="0"><data key="d9">120.5</data><data key="d12">['60', '50']</data></edge>
<edge source="11" target="12" id="1"><data key="d9">1.0</data></edge>
<edge source="12" target="11" id="0"><data key="d9">80</data><data key="d12">70</data></edge>
</graph></graphml>"""


def test_road_network_file(spark, tmp_path):
    path = tmp_path / "roads.graphml"
    path.write_text(GRAPHML)
    nodes, edges = files.read_road_network(spark, str(path))
    assert sorted(tuple(r) for r in nodes.collect()) == [(11, 103.8, 1.3), (12, 103.9, 1.4)]
    got = {(r["src"], r["key"]): (r["dst"], r["length"], r["maxspeed"]) for r in edges.collect()}
    assert got == {(11, 0): (12, 120.5, ["60", "50"]), (11, 1): (12, 1.0, None), (12, 0): (11, 80.0, ["70"])}


def test_scaler_round_trip(spark, tmp_path):
    scaler = traffic.fit_scaler(spark.createDataFrame([(1, 9.0), (3, 4.0)], "a int, b double"), ["a", "b"])
    fitted.save_scaler(scaler, str(tmp_path / "s"))
    back = fitted.load_scaler(spark, str(tmp_path / "s"))
    assert sorted(tuple(r) for r in back.collect()) == [("a", 1.0, 3.0), ("b", 4.0, 9.0)]


def test_jdbc_append_arguments():
    calls = {}

    class Rows:
        class write:  # noqa: N801
            @staticmethod
            def jdbc(**kwargs):
                calls.update(kwargs)

    JdbcTable("jdbc:x://h/db", "traffic_data", {"user": "u"}).batch_writer()(Rows, 3)
    assert calls == {"url": "jdbc:x://h/db", "table": "traffic_data", "mode": "append", "properties": {"user": "u"}}


def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def cut_files(spark):
    small_splits(spark)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_road_file_is_read_by_many_tasks(spark, tmp_path, cut_files):
    head, tail = GRAPHML.split("<node", 1)[0], "</graph></graphml>"
    nodes = [f'<node id="{i}">\n  <data key="d4">{i / 7}</data><data key="d5">{i / 3}</data>\n</node>' for i in range(500)]
    bare = ['<node id="900"/>', "<node id='901' />"]
    edges = [f'<edge source="{i}" target="{(i + 1) % 500}" id="0"><data key="d9">{i}.5</data></edge>' for i in range(500)] + ['<edge source="900" target="901"/>']
    path = tmp_path / "roads.graphml"
    path.write_text(head + "\n".join(nodes + bare + edges) + tail)
    got_nodes, got_edges = files.read_road_network(spark, str(path))
    assert got_nodes.rdd.getNumPartitions() > 5
    assert sorted(tuple(r) for r in got_nodes.collect()) == [(i, i / 3, i / 7) for i in range(500)] + [(900, None, None), (901, None, None)]
    found = sorted((r["src"], r["dst"], r["key"], r["length"]) for r in got_edges.filter("src < 900").collect())
    assert found == [(i, (i + 1) % 500, 0, i + 0.5) for i in range(500)]
    assert [tuple(r) for r in got_edges.filter("src = 900").select("dst", "key", "length").collect()] == [(901, 0, None)]


def test_one_log_is_read_by_many_tasks(spark, tmp_path, cut_files):
    path = tmp_path / "log.json"
    log = {f"2024-01-{d:02} {h:02}:00:00": [{"EstTime": d, "Name": "x, {y}"}, {"EstTime": h}] for d in range(1, 29) for h in range(24)}
    path.write_text(json.dumps(log | {"2024-02-01 00:00:00": []}, indent=1))
    records = messages.read_snapshots(spark, str(path))
    assert records.rdd.getNumPartitions() > 5
    assert {str(r["ts"]): r["total"] for r in traffic.snapshot_totals(records).collect()} == {k: v[0]["EstTime"] + v[1]["EstTime"] for k, v in log.items()}
    flat = tmp_path / "series.json"
    flat.write_text(json.dumps({k: i for i, k in enumerate(log)}))
    series = messages.read_hourly_series(spark, str(flat))
    assert sorted(r["total"] for r in series.collect()) == list(range(len(log)))


def test_text_that_is_no_entry_stops_the_read(spark, tmp_path):
    path = tmp_path / "log.json"
    path.write_text('{"2024-01-01 00:00:00": [{"EstTime": 1, "Name": "a]b"}]}')
    with pytest.raises(Exception, match="not an entry"):
        messages.read_snapshots(spark, str(path)).collect()


def test_ordinals_run_over_all_documents(spark, tmp_path):
    square = [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]
    for n in range(3):
        lines = [json.dumps({"features": [
            {"properties": {"planning_area": f"{n}-{d}-{i}"}, "geometry": {"type": "Polygon", "coordinates": square}} for i in range(2)
        ]}) for d in range(2)]
        (tmp_path / f"{n}.json").write_text("\n".join(lines))
    out = files.read_districts(spark, str(tmp_path), a_line=True).collect()
    assert sorted((r["ordinal"], r["planning_area"]) for r in out) == list(enumerate(f"{n}-{d}-{i}" for n in range(3) for d in range(2) for i in range(2)))
