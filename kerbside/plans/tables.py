"""The given parquet tables, and the domain tables read out of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import pin_utc, shared_dir

AREAS = 25
DEPOTS = 5
LOCATIONS = AREAS + DEPOTS
TRUCKS = 30
PAGE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    shared_dir(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    naive = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive})


# --- readings and travel times, from events -------------------------------------------


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed messages as a broker would hand them over: value, timestamp, offset.

    Some are not JSON and some carry the band as text, as real feeds do.
    """
    k = F.col("k")
    band = (k % 8 + 1).cast("string")
    body = F.concat(
        F.lit('{"LinkID":"'), F.col("user_id").cast("string"),
        F.lit('","RoadName":"Road '), (F.col("user_id") % 100).cast("string"),
        F.lit('","RoadCategory":"'), F.col("event_type"),
        F.lit('","SpeedBand":'), F.when(k % 17 == 1, F.concat(F.lit('"'), band, F.lit('"'))).otherwise(band),
        F.lit(',"MinimumSpeed":"'), (k % 8 * 10).cast("string"),
        F.lit('","MaximumSpeed":"'), (k % 8 * 10 + 9).cast("string"), F.lit('"}'),
    )
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return events.select(
        F.when(k % 17 == 0, F.substring(body, 1, 20)).otherwise(body).alias("value"),
        F.date_trunc("hour", "ts").alias("timestamp"),
        F.col("event_id").alias("offset"),
    )


def snapshot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log texts ``{hour: [{EstTime}, ...]}``; an hour is spread over several entries."""
    rows = table(spark, sf_dir, "events").select(
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("hour"),
        F.floor(F.col("event_id") / PAGE).alias("page"),
        cents("value").alias("EstTime"),
    )
    entries = rows.groupBy("hour", "page").agg(F.collect_list(F.struct("EstTime")).alias("records"))
    return entries.select(
        F.to_json(F.map_from_arrays(F.array("hour"), F.array("records"))).alias("value")
    )


def travel_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot records ``(ts, EstTime)`` on the hour."""
    return table(spark, sf_dir, "events").select(
        F.date_trunc("hour", "ts").alias("ts"), cents("value").alias("EstTime")
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly totals brought into the range the traffic bands are made for."""
    totals = travel_times(spark, sf_dir).groupBy("ts").agg(F.sum("EstTime").alias("total"))
    return totals.withColumn("total", 250 + F.col("total") % 150)


HOURLY_SQL = """hourly AS (
  SELECT date_trunc('hour', ts) AS ts, (250 + sum(round(value * 100)::BIGINT) % 150)::BIGINT AS total
  FROM events GROUP BY 1)"""


# --- vehicles, from part and lineitem --------------------------------------------------

AS_OF = "2001-01-01"


def _pick(index, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw vehicle rows; some conditions are NULL or outside the known levels."""
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"),
            F.max("l_extendedprice").alias("premium"), F.count("*").alias("services"),
        )
    )
    key, size = F.col("p_partkey"), F.col("p_size")
    rows = table(spark, sf_dir, "part").join(shipped, key == F.col("l_partkey"), "left")
    return rows.select(
        key.cast("int").alias("Truck_ID"),
        F.lit("Truck").alias("Vehicle_Model"),
        F.col("p_retailprice").alias("Mileage"),
        F.when(size % 7 == 0, "Unknown").otherwise(_pick(size, ["Poor", "Average", "Good"])).alias("Maintenance_History"),
        (size % 6).alias("Reported_Issues"),
        (key % 15).cast("int").alias("Vehicle_Age"),
        _pick(key, ["Diesel", "Electric", "Petrol"]).alias("Fuel_Type"),
        _pick(size, ["Manual", "Automatic"]).alias("Transmission_Type"),
        _pick(key, [800, 1000, 1500, 2000, 2500]).alias("Engine_Size"),
        (F.col("p_retailprice") * 100 + size).alias("Odometer_Reading"),
        F.date_format("first", "d/M/yyyy").alias("Last_Service_Date"),
        F.date_format("last", "d/M/yyyy").alias("Warranty_Expiry_Date"),
        _pick(size + key, ["First", "Second", "Third"]).alias("Owner_Type"),
        F.coalesce("premium", F.lit(0.0)).alias("Insurance_Premium"),
        (F.coalesce("services", F.lit(0)) % 11).cast("int").alias("Service_History"),
        (key % 4).cast("int").alias("Accident_History"),
        (10 + size / 5).alias("Fuel_Efficiency"),
        F.when(size % 13 != 0, _pick(key + 1, ["Worn Out", "Good", "New"])).alias("Tire_Condition"),
        _pick(key * 2 + size, ["Worn Out", "Good", "New"]).alias("Brake_Condition"),
    )


def labelled_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles with a maintenance label: a rule with one flipped verdict in twenty."""
    from kerbside.functions.draws import draw

    due = (F.col("Reported_Issues") >= 4) | (
        F.coalesce(F.col("Tire_Condition") == "Worn Out", F.lit(False)) & (F.col("Vehicle_Age") > 7)
    )
    flip = draw("label", F.col("Truck_ID")) % 20 == 0
    return vehicles(spark, sf_dir).withColumn("label", (due != flip).cast("int"))


VEHICLES_SQL = """shipped AS (
  SELECT l_partkey, min(l_shipdate) AS first, max(l_shipdate) AS last, max(l_extendedprice) AS premium,
    count(*) AS services FROM lineitem GROUP BY 1),
vehicles AS (
  SELECT p_partkey::INT AS id, p_retailprice AS mileage,
    CASE WHEN p_size % 7 = 0 THEN 'Unknown' ELSE ['Poor', 'Average', 'Good'][p_size % 3 + 1] END AS history,
    (p_size % 6)::INT AS issues, (p_partkey % 15)::INT AS age,
    ['Diesel', 'Electric', 'Petrol'][p_partkey % 3 + 1] AS fuel,
    ['Manual', 'Automatic'][p_size % 2 + 1] AS transmission,
    [800, 1000, 1500, 2000, 2500][p_partkey % 5 + 1]::INT AS engine,
    p_retailprice * 100 + p_size AS odometer,
    first::DATE AS serviced, last::DATE AS warranty,
    ['First', 'Second', 'Third'][(p_size + p_partkey) % 3 + 1] AS owner,
    coalesce(premium, 0.0) AS premium, (coalesce(services, 0) % 11)::INT AS services,
    (p_partkey % 4)::INT AS accidents, 10 + p_size / 5 AS efficiency,
    CASE WHEN p_size % 13 <> 0 THEN ['Worn Out', 'Good', 'New'][(p_partkey + 1) % 3 + 1] END AS tire,
    ['Worn Out', 'Good', 'New'][(p_partkey * 2 + p_size) % 3 + 1] AS brake
  FROM part LEFT JOIN shipped ON p_partkey = l_partkey),
encoded AS (
  SELECT *, date_diff('day', serviced, DATE '2001-01-01')::INT AS since,
    (date_diff('day', DATE '2001-01-01', warranty) - 1)::INT AS warranty_left,
    coalesce(list_position(['Worn Out', 'Good', 'New'], tire) - 1, -1)::INT AS tire_code,
    coalesce(list_position(['Worn Out', 'Good', 'New'], brake) - 1, -1)::INT AS brake_code,
    coalesce(list_position(['First', 'Second', 'Third'], owner) - 1, -1)::INT AS owner_code,
    coalesce(list_position(['Poor', 'Average', 'Good'], history) - 1, -1)::INT AS history_code,
    transmission = 'Manual' AS manual,
    ((issues >= 4 OR (coalesce(tire = 'Worn Out', false) AND age > 7)) <>
      (('0x' || substr(md5('label|' || id::VARCHAR), 1, 8))::BIGINT % 20 = 0))::INT AS label
  FROM vehicles)"""


# --- districts, waste and places, from customer and nation ------------------------------


def waste_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """National total, area totals and subzones, as in the published sheet.

    One area carries another name than its district and every sixth collects nothing.
    """
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    name = F.when(F.col("n_nationkey") == 7, "ELSEWHERE").otherwise(F.col("n_name"))
    kg = F.when(F.col("n_nationkey") % 6 != 0, cents("c_acctbal")).otherwise(0)
    sums = (
        people.select(name.alias("area"), F.col("c_mktsegment").alias("segment"), kg.alias("kg"))
        .rollup("area", "segment")
        .agg(F.sum("kg").cast("double").alias("kg"))
    )
    return sums.select(
        F.when(F.col("area").isNull(), "Total").otherwise(F.col("area")).alias("Planning Area of Residence"),
        F.coalesce("segment", F.lit("Total")).alias("Subzone"),
        F.lit("2020").alias("Year"),
        F.col("kg").alias("Waste Generated Per Day (kg)"),
        F.when(F.col("area").isNull(), 0).otherwise(1).alias("row"),
    )


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One district per customer; several share an area name."""
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return people.select(F.col("c_custkey").alias("ordinal"), F.col("n_name").alias("planning_area"))


def _square(x, y, side):
    return F.array(F.array(x, y), F.array(x + side, y), F.array(x + side, y + side), F.array(x, y + side), F.array(x, y))


def district_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A square per customer; some have an off-centre hole, some a second part."""
    key = F.col("c_custkey")
    x, y = (key % 50).cast("double"), F.floor(key / 50).cast("double")
    side = (1 + F.col("c_nationkey") % 3).cast("double")
    shell = _square(x, y, side)
    hole = F.reverse(_square(x + side / 8, y + side / 8, side / 2))
    first = F.when(key % 2 == 0, F.array(shell, hole)).otherwise(F.array(shell))
    second = F.array(_square(x + 10, y, F.lit(1.0)))
    return table(spark, sf_dir, "customer").select(
        key.alias("ordinal"),
        F.when(key % 3 == 0, F.array(first, second)).otherwise(F.array(first)).alias("parts"),
    )


def _place(seed: str, key: str, start: float):
    from kerbside.functions.draws import draw

    return start + (draw(seed, F.col(key)) % 400000) / 1e6


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("point"), _place("px", "c_custkey", 103.6).alias("lon"),
        _place("py", "c_custkey", 1.2).alias("lat"),
    )


def junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("node"), _place("nx", "p_partkey", 103.6).alias("lon"),
        _place("ny", "p_partkey", 1.2).alias("lat"),
    )


# --- road graph: customers are junctions ------------------------------------------------


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three roads out of every junction, some with a parallel edge of key 1."""
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    n = people.select(F.count("*")).scalar()
    k = F.col("k")

    def edge(step: int, target, key: int):
        return F.struct(
            target.alias("dst"), F.lit(key).alias("key"),
            ((k * 37 + step * 101) % 900 * (1 - key)).cast("double").alias("length"),
        )

    out = F.array(
        edge(1, (k + 1) % F.col("n"), 0), edge(7, (k + 7) % F.col("n"), 0),
        edge(3, (3 * k + 1) % F.col("n"), 0), edge(1, (k + 1) % F.col("n"), 1),
    )
    limits = (
        F.when(k % 4 == 0, F.lit(None).cast("array<string>"))
        .when(k % 4 == 1, F.array(F.lit("50"), F.lit("30")))
        .otherwise(F.array((40 + 10 * (k % 5)).cast("string")))
    )
    return people.withColumn("n", n).select(k.alias("src"), limits.alias("maxspeed"), F.inline(out)).filter(
        "src <> dst"
    )


def collection_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("loc"), F.col("n_name").alias("name"))


def depot_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        (AREAS + F.col("r_regionkey")).alias("loc"), F.col("r_name").alias("name")
    )


def on_road(places: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The junction of every location."""
    n = table(spark, sf_dir, "customer").select(F.count("*")).scalar()
    return places.withColumn("node", F.floor(F.col("loc") * n / LOCATIONS).cast("bigint"))


ROADS_SQL = """n AS (SELECT count(*) AS n FROM customer),
roads AS (
  SELECT c_custkey AS src, t.dst, ((c_custkey * 37 + t.step * 101) % 900)::DOUBLE AS length,
    CASE WHEN c_custkey % 4 = 0 THEN 40 WHEN c_custkey % 4 = 1 THEN 30 ELSE 40 + 10 * (c_custkey % 5) END AS kph
  FROM customer, n, LATERAL (SELECT unnest([1, 7, 3]) AS step,
    unnest([(c_custkey + 1) % n, (c_custkey + 7) % n, (3 * c_custkey + 1) % n]) AS dst) t WHERE t.dst <> c_custkey),
timed AS (SELECT *, CASE WHEN length = 0 THEN 0.0::DOUBLE
  ELSE length / (kph * 1000 / 3600::DOUBLE) / 60 END AS minutes FROM roads),
places AS (SELECT n_nationkey::INT AS loc FROM nation UNION ALL SELECT 25 + r_regionkey FROM region),
chosen AS (SELECT loc, (loc * n // 30)::BIGINT AS node FROM places, n)"""


# --- waste, trucks, travel minutes and slots of the planners ----------------------------


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily waste ``(loc, kg)`` of the 25 collection locations."""
    cents_each = "sum(cast(round(abs(c_acctbal) * 100) AS bigint)) div count(*) div 100"
    sums = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("loc")).agg(
        F.expr(cents_each).alias("kg")
    )
    return sums.withColumn("kg", F.col("kg") * (1 + F.col("loc") * 7 % 16))


def fleet(spark: SparkSession, sf_dir: str, seed: str | None = None) -> DataFrame:
    """Every supplier runs a truck; with a seed they take turns in a drawn order."""
    from kerbside.functions.draws import draw
    from kerbside.functions.running import numbered
    from kerbside.functions.scalars import truck_capacity

    trucks = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("truck"))
    if seed is None:
        ordered = numbered(trucks, ["truck"], F.floor(F.col("truck") / 4096), name="truck_ord")
    else:
        place = draw(seed, F.col("truck"))
        ordered = numbered(trucks, [place, "truck"], F.floor(place / 2**20), name="truck_ord")
    return ordered.withColumn("capacity", truck_capacity(F.col("truck_ord")))


def region_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One truck per region: too few for a day, so each has more trips than there are slots."""
    from kerbside.functions.scalars import truck_capacity

    trucks = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("truck"))
    return trucks.withColumn("truck_ord", F.col("truck")).withColumn("capacity", truck_capacity(F.col("truck_ord")))


def travel_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed minutes between locations; the key domain bounds it to 30 x 30 rows."""
    a, b = F.col("l_partkey") % LOCATIONS, F.col("l_orderkey") % LOCATIONS
    mean = F.expr("cast(sum(l_quantity) AS bigint) div count(*) + 1")
    rows = table(spark, sf_dir, "lineitem").groupBy(a.cast("int").alias("a"), b.cast("int").alias("b"))
    observed = rows.agg(mean.alias("minutes"))
    return observed.withColumn("minutes", F.when(F.col("a") == F.col("b"), 0).otherwise(F.col("minutes")))


def slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten departure hours with their slow-down in percent."""
    from kerbside.functions.scalars import traffic_multiplier
    from kerbside.operators.traffic import planning_hours

    rows = table(spark, sf_dir, "events").select(
        F.hour("ts").alias("hour"), cents("value").alias("v")
    )
    totals = planning_hours(rows).groupBy("hour").agg((250 + F.sum("v") % 150).alias("total"))
    return totals.select(
        F.col("hour").alias("slot"), F.round(traffic_multiplier(F.col("total")) * 100).cast("bigint").alias("percent")
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate plans: 64 orders make a candidate, every line a collection.

    A trip visits a location once, so trips and candidates stay small however
    many lines fall on one key; the sums combine before the shuffle.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy(
        F.floor(F.col("l_orderkey") / 64).alias("cand"),
        (F.col("l_suppkey") % TRUCKS).cast("int").alias("truck"),
        (10 + F.floor(F.col("l_partkey") / AREAS) % 10).cast("int").alias("slot"),
        (F.col("l_partkey") % AREAS).cast("int").alias("loc"),
    )
    kg = lines.agg((F.sum("l_quantity").cast("bigint") * 100).alias("kg"))
    from pyspark.sql import Window as W

    trip = W.partitionBy("cand", "truck", "slot").orderBy(F.col("kg").desc(), "loc")
    return kg.select(
        "*",
        (AREAS + (F.col("cand") + F.col("truck")) % DEPOTS).cast("int").alias("depot"),
        F.row_number().over(trip).alias("pos"),
    )


def plan_trucks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trucks that appear in the candidate plans, with capacities."""
    from kerbside.functions.scalars import truck_capacity

    trucks = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % TRUCKS).cast("int").alias("truck"))
    return trucks.distinct().withColumn("capacity", truck_capacity(F.col("truck")))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collection_places(spark, sf_dir).unionByName(depot_places(spark, sf_dir))


AREAS_SQL = """areas AS (SELECT c_nationkey::INT AS loc,
  (sum(round(abs(c_acctbal) * 100)::BIGINT)::BIGINT // count(*) // 100 * (1 + c_nationkey * 7 % 16))::BIGINT AS kg
  FROM customer GROUP BY c_nationkey)"""
FLEET_SQL = """fleet AS (SELECT s_suppkey AS truck, row_number() OVER (ORDER BY s_suppkey) - 1 AS truck_ord,
  10000 + 2000 * ((row_number() OVER (ORDER BY s_suppkey) - 1) % 5) AS capacity FROM supplier)"""
REGION_FLEET_SQL = """fleet AS (SELECT r_regionkey::BIGINT AS truck, r_regionkey::BIGINT AS truck_ord,
  10000 + 2000 * (r_regionkey % 5) AS capacity FROM region)"""
MATRIX_SQL = """matrix AS (SELECT (l_partkey % 30)::INT AS a, (l_orderkey % 30)::INT AS b,
  CASE WHEN l_partkey % 30 = l_orderkey % 30 THEN 0 ELSE sum(l_quantity)::BIGINT // count(*) + 1 END::BIGINT AS minutes
  FROM lineitem GROUP BY l_partkey % 30, l_orderkey % 30)"""
SLOTS_SQL = """slot_totals AS (SELECT hour(ts)::INT AS slot, 250 + sum(round(value * 100)::BIGINT) % 150 AS total
  FROM events WHERE hour(ts) > 9 AND hour(ts) < 20 GROUP BY 1),
slots AS (SELECT slot, CASE WHEN total > 350 THEN 150 WHEN total > 325 THEN 125 WHEN total > 300 THEN 110
  WHEN total > 275 THEN 105 ELSE 100 END::BIGINT AS percent FROM slot_totals)"""
STOPS_SQL = """stop_sums AS (SELECT l_orderkey // 64 AS cand, (l_suppkey % 30)::INT AS truck,
  (10 + (l_partkey // 25) % 10)::INT AS slot, (l_partkey % 25)::INT AS loc, (sum(l_quantity)::BIGINT * 100)::BIGINT AS kg
  FROM lineitem GROUP BY 1, 2, 3, 4),
stops AS (SELECT *, (25 + (cand + truck) % 5)::INT AS depot,
  row_number() OVER (PARTITION BY cand, truck, slot ORDER BY kg DESC, loc) AS pos FROM stop_sums)"""
LEGS_SQL = f"""{STOPS_SQL},
leg_parts AS (SELECT cand, truck, slot, pos AS seq,
    coalesce(lag(loc) OVER w, depot) AS a, loc AS b FROM stops WINDOW w AS (PARTITION BY cand, truck, slot ORDER BY pos)
  UNION ALL SELECT cand, truck, slot, max(pos) + 1, arg_max(loc, pos), any_value(depot) FROM stops GROUP BY 1, 2, 3),
{MATRIX_SQL}, {SLOTS_SQL},
costed AS (SELECT l.*, coalesce(m.minutes, 30) * percent AS cost
  FROM leg_parts l LEFT JOIN matrix m USING (a, b) JOIN slots USING (slot)),
costs AS (SELECT cand, (sum(cost) + (30 - count(DISTINCT truck)) * 100000)::BIGINT AS cost FROM costed GROUP BY cand)"""
NAMES_SQL = "names AS (SELECT n_nationkey::INT AS loc, n_name AS name FROM nation UNION ALL SELECT 25 + r_regionkey, r_name FROM region)"
