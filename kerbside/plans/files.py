"""Registered queries that write tables as files and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators import districts as D
from kerbside.operators import fleet as O
from kerbside.operators import geo as G
from kerbside.plans import tables as V
from kerbside.plans.districts import ORACLE as DISTRICT_SQL
from kerbside.plans.fleet import ORACLE as FLEET_SQL
from kerbside.session import shared_dir
from kerbside.sources import files as S

FEATURES_PER_FILE = 500


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(V.pin_utc(spark))}/{label}-{uuid.uuid4().hex}"


def vehicle_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Raw vehicles out to CSV and in again, then encoded, stored and reread as the scored fleet."""
    raw, scored = _folder(spark, "vehicles"), _folder(spark, "scored")
    S.write_csv(V.vehicles(spark, sf), raw)
    fleet = O.encoded(S.read_vehicles(spark, raw), V.AS_OF).withColumn("prediction", F.col("Reported_Issues") >= 4)
    out = O.scored_fleet(fleet)
    S.write_csv(out, scored)
    return spark.read.schema(out.schema).csv(scored, header=True)


def waste_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """The sheet as exported files."""
    path = _folder(spark, "waste")
    sheet = V.waste_sheet(spark, sf).drop("row")
    S.write_csv(sheet, path)
    return D.area_totals(S.read_waste_sheet(spark, path, sheet.columns)).toDF("area", "kg")


def district_features(spark: SparkSession, sf: str) -> DataFrame:
    """District shapes as feature collections, a few hundred features to a line."""
    path = _folder(spark, "districts")
    several = F.size("parts") > 1
    shape = F.struct(
        F.when(several, "MultiPolygon").otherwise("Polygon").alias("type"),
        F.when(several, F.to_json("parts")).otherwise(F.to_json(F.col("parts")[0])).alias("coordinates"),
    )
    feature = F.concat(
        F.lit('{"type":"Feature","properties":{"planning_area":"'), F.col("ordinal").cast("string"),
        F.lit('"},"geometry":{"type":"'), shape["type"], F.lit('","coordinates":'), shape["coordinates"], F.lit("}}"),
    )
    rows = V.district_shapes(spark, sf).select(
        F.floor(F.col("ordinal") / FEATURES_PER_FILE).alias("part"), feature.alias("feature")
    )
    documents = rows.groupBy("part").agg(F.concat_ws(",", F.collect_list("feature")).alias("list"))
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.col("list"), F.lit("]}"))
    documents.select(whole.alias("value")).write.text(path)
    placed = G.with_centroid(S.read_districts(spark, path, a_line=True))
    return placed.select(
        F.col("planning_area").cast("bigint").alias("ordinal"), F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat")
    )


def road_file(spark: SparkSession, sf: str) -> DataFrame:
    """Roads as GraphML documents, read back in parallel and timed."""
    from kerbside.operators.roads import timed_edges

    path = _folder(spark, "roads")
    keys = [("d1", "node", "x"), ("d2", "node", "y"), ("d3", "edge", "length"), ("d4", "edge", "maxspeed")]
    header = "".join(f'<key id="{i}" for="{owner}" attr.name="{name}" attr.type="string"/>' for i, owner, name in keys)
    head = spark.createDataFrame([(f"<graphml>{header}<graph edgedefault='directed'>",)], "value string")

    def data(key: str, value):
        return F.concat(F.lit(f'<data key="{key}">'), value.cast("string"), F.lit("</data>"))

    listed = F.concat(F.lit("['"), F.concat_ws("', '", "maxspeed"), F.lit("']"))
    limit = F.when(F.size("maxspeed") == 1, F.col("maxspeed")[0]).when(F.size("maxspeed") > 1, listed)
    edge = F.concat(
        F.lit('<edge source="'), F.col("src").cast("string"), F.lit('" target="'), F.col("dst").cast("string"),
        F.lit('" id="'), F.col("key").cast("string"), F.lit('">'), data("d3", F.col("length")),
        F.coalesce(data("d4", limit), F.lit("")), F.lit("</edge>"),
    )
    node = F.concat(
        F.lit('<node id="'), F.col("node").cast("string"), F.lit('">'), data("d1", F.col("lon")), data("d2", F.col("lat")),
        F.lit("</node>"),
    )
    # an element a line; the lines of a file need no order but that of the header, which is a file of its own
    rows = V.junctions(spark, sf).select(node.alias("value")).unionByName(V.roads(spark, sf).select(edge.alias("value")))
    rows.unionByName(head).write.text(path)
    nodes, edges = S.read_road_network(spark, path)
    timed = timed_edges(edges).select("src", "dst", "length", F.round("minutes", 6).alias("minutes"))
    count = nodes.filter("x IS NOT NULL AND y IS NOT NULL").select(F.count("*")).scalar()
    return timed.withColumn("nodes", count)


QUERIES = {
    "s7_s8_vehicle_csv": vehicle_csv,
    "s10_waste_sheet": waste_sheet,
    "s11_district_features": district_features,
    "s12_road_file": road_file,
}
ORACLE = {
    "s7_s8_vehicle_csv": FLEET_SQL["m13_scored_fleet"],
    "s10_waste_sheet": DISTRICT_SQL["p1_area_totals"],
    "s11_district_features": DISTRICT_SQL["g3_centroids"],
    "s12_road_file": f"""WITH {V.ROADS_SQL} SELECT src, dst, length, round(minutes, 6)::DOUBLE AS minutes,
        (SELECT count(*) FROM part) AS nodes FROM timed""",
}
