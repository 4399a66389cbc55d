"""File readers and writers for fleet tables, districts, waste sheets and road networks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Column names and types of the vehicle table.
VEHICLE_SCHEMA = """Truck_ID int, Vehicle_Model string, Mileage double, Maintenance_History string,
 Reported_Issues int, Vehicle_Age int, Fuel_Type string, Transmission_Type string, Engine_Size int,
 Odometer_Reading double, Last_Service_Date string, Warranty_Expiry_Date string, Owner_Type string,
 Insurance_Premium double, Service_History int, Accident_History int, Fuel_Efficiency double,
 Tire_Condition string, Brake_Condition string"""
LABEL = "Need_Maintenance"

# Column names of the waste sheet and the district property joined to it.
SHEET_AREA, SHEET_SUBZONE, SHEET_KG = "Planning Area of Residence", "Subzone", "Waste Generated Per Day (kg)"
DISTRICT_AREA = "planning_area"

DISTRICT_SCHEMA = (
    "features array<struct<properties:map<string,string>,"
    "geometry:struct<type:string,coordinates:string>>>"
)
RING = "array<array<double>>"


def read_vehicles(spark: SparkSession, path: str, labelled: bool = False) -> DataFrame:
    """Vehicle CSV; the first, unnamed column is the truck id."""
    schema = VEHICLE_SCHEMA + (f", {LABEL} int" if labelled else "")
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def read_waste_sheet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Exported sheet with its columns in order; the last one is the daily waste."""
    schema = ", ".join(
        f"`{c}` {'double' if c == SHEET_KG else 'string'}" for c in columns
    )
    return spark.read.csv(path, header=True, schema=schema)


def read_districts(spark: SparkSession, path: str, a_line: bool = False) -> DataFrame:
    """District features: ordinal, property map and the rings of every polygon part.

    A file is one document, or one a line. The ordinal runs over all documents,
    by file and by the place of the document's first feature in it.
    """
    features = spark.read.schema(DISTRICT_SCHEMA).json(path, multiLine=not a_line).withColumn("file", F.col("_metadata.file_path"))
    # A document is told apart from others of its file by its content; the order among them is fixed by it.
    first = F.coalesce(F.to_json(F.get("features", F.lit(0))), F.lit(""))
    sizes = features.select("file", first.alias("first"), F.size("features").alias("n")).groupBy("file", "first").agg(F.sum("n").alias("n"))
    ahead = W.orderBy("file", "first").rowsBetween(W.unboundedPreceding, -1)  # a row per document
    starts = sizes.select("file", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    numbered = features.withColumn("first", first).join(starts, ["file", "first"])
    rows = numbered.select("start", F.posexplode("features").alias("place", "feature")).withColumn("ordinal", F.col("start") + F.col("place"))
    shape = F.col("feature.geometry")
    single = F.array(F.from_json(shape["coordinates"], f"array<{RING}>"))
    several = F.from_json(shape["coordinates"], f"array<array<{RING}>>")
    return rows.select(
        "ordinal",
        F.col("feature.properties")[DISTRICT_AREA].alias(DISTRICT_AREA),
        F.col("feature.properties").alias("properties"),
        F.when(shape["type"] == "MultiPolygon", several).otherwise(single).alias("parts"),
    )


_TAG = r"""<{tag}\b(?:[^>"']|"[^"]*"|'[^']*')*>"""


def _elements(pieces: DataFrame, tag: str, schema: str) -> DataFrame:
    """The elements of one kind in pieces of a file that end with an element's end tag."""
    opening = _TAG.format(tag=tag)
    pattern = "(?s)" + opening[:-1] + r"(?:/>|(?<!/)>.*?</" + tag[:-1] + r"(?=e>|$)(?:e>)?)"
    texts = pieces.filter(F.col("value").contains(f"<{tag}")).select(F.explode(F.regexp_extract_all("value", F.lit(pattern), 0)).alias("text"))
    closed = F.when(F.col("text").endswith(">"), F.col("text")).otherwise(F.concat("text", F.lit("e>")))
    return texts.select(F.from_xml(closed, schema).alias("e")).select("e.*")


def _attribute(keys: dict[tuple[str, str], str], owner: str, name: str) -> Column:
    """Text of one attribute out of the row's ``data`` elements."""
    if (owner, name) not in keys:
        return F.lit(None).cast("string")
    wanted = F.filter("data", lambda d: d["_key"] == keys[owner, name])
    return F.get(wanted, F.lit(0))["_VALUE"]


def read_road_network(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(id, x, y)`` and edges ``(src, dst, key, length, maxspeed)`` of GraphML files.

    ``</node>`` and ``</edge>`` end alike, and the text reader cuts files at
    that common end: one long file is read by many tasks, a row holds one
    element with its data (and such without data ahead of it). A raw ``e>``
    inside a text is not expected; writers escape the bracket. Attribute ids
    come from the few ``key`` elements of the header.
    """
    pieces = spark.read.option("lineSep", "e>").text(path)
    tags = pieces.filter(F.col("value").contains("<key")).select(F.explode(F.regexp_extract_all("value", F.lit(_TAG.format(tag="key")), 0)).alias("tag"))
    parts = {n: F.regexp_extract("tag", rf"""\s{n}\s*=\s*["']([^"']*)["']""", 1) for n in ("id", "for", "attr.name")}
    header = tags.select(*[v.alias(n.replace("attr.", "")) for n, v in parts.items()]).distinct()
    keys = {(r["for"], r["name"]): r["id"] for r in header.collect()}
    data = "data array<struct<_VALUE:string,_key:string>>"
    nodes = _elements(pieces, "node", f"_id long, {data}").select(
        F.col("_id").alias("id"),
        _attribute(keys, "node", "x").cast("double").alias("x"),
        _attribute(keys, "node", "y").cast("double").alias("y"),
    )
    edges = _elements(pieces, "edge", f"_id int, _source long, _target long, {data}").select(
        F.col("_source").alias("src"),
        F.col("_target").alias("dst"),
        F.coalesce(F.col("_id"), F.lit(0)).alias("key"),
        _attribute(keys, "edge", "length").cast("double").alias("length"),
        F.expr("NULL").cast("array<string>").alias("maxspeed")
        if ("edge", "maxspeed") not in keys
        else F.when(
            _attribute(keys, "edge", "maxspeed").isNotNull(),
            F.regexp_extract_all(_attribute(keys, "edge", "maxspeed"), F.lit(r"(\d+)"), 1),
        ).alias("maxspeed"),
    )
    return nodes, edges
