"""Registered queries over trips, plans and their search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.running import numbered, spread
from kerbside.functions.scalars import first_word, route_text, truck_capacity
from kerbside.operators import fill as L
from kerbside.operators import permutation as P
from kerbside.operators import search as S
from kerbside.operators import trips as T
from kerbside.plans import tables as V
from kerbside.session import written

QUERIES: dict = {}
GENERATIONS = 5
ORACLE: dict[str, str] = {}

MATRIX_ROWS = V.LOCATIONS**2
DEFAULT_MINUTES = 30
PENALTY = 100_000  # 1000 minutes at 100 percent
SECOND_TOUR_DEPOTS = (28, 29)
DAY = "2024-10-26"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def slot_text(slot):
    return F.concat(F.lit(f"{DAY} "), F.lpad(slot.cast("string"), 2, "0"), F.lit(":00:00"))


SLOT_TEXT_SQL = f"'{DAY} ' || lpad(slot::VARCHAR, 2, '0') || ':00:00'"


def _costed(spark: SparkSession, sf: str) -> DataFrame:
    legs = T.closed_legs(V.stops(spark, sf))
    return T.leg_costs(
        legs, V.travel_minutes(spark, sf), V.slots(spark, sf), "percent", MATRIX_ROWS, DEFAULT_MINUTES
    )


def _costs(spark: SparkSession, sf: str) -> DataFrame:
    return T.plan_costs(_costed(spark, sf), V.TRUCKS, PENALTY)


def _population(spark: SparkSession, sf: str) -> DataFrame:
    lines = V.table(spark, sf, "lineitem")
    return lines.agg((F.floor(F.max("l_orderkey") / 64) + 1).alias("n"))


POPULATION_SQL = "pop AS (SELECT max(l_orderkey) // 64 + 1 AS n FROM lineitem)"


# --- filling trucks ---------------------------------------------------------------------


@query(
    "f14_truck_capacities",
    f"WITH {V.FLEET_SQL} SELECT truck, truck_ord::BIGINT AS truck_ord, capacity::BIGINT AS capacity FROM fleet",
)
def truck_capacities(spark: SparkSession, sf: str) -> DataFrame:
    return V.fleet(spark, sf).withColumn("truck_ord", F.col("truck_ord").cast("bigint"))


FILL_SQL = """locs AS (SELECT c_nationkey AS zone, c_custkey AS loc, floor(abs(c_acctbal))::BIGINT AS kg FROM customer),
laid AS (SELECT *, (sum(kg) OVER w - kg)::BIGINT AS lo, (sum(kg) OVER w)::BIGINT AS hi FROM locs
  WINDOW w AS (PARTITION BY zone ORDER BY loc)),
trucks0 AS (SELECT s_nationkey AS zone, s_suppkey AS truck,
  row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS ord FROM supplier),
trucks AS (SELECT *, 10000 + 2000 * (ord % 5) AS cap FROM trucks0),
ahead AS (SELECT *, sum(cap) OVER (PARTITION BY zone ORDER BY ord) - cap AS before,
  sum(cap) OVER (PARTITION BY zone) AS fleet FROM trucks),
need AS (SELECT zone, sum(kg) AS total FROM locs GROUP BY zone),
trips AS (SELECT zone, truck, round, (round * fleet + before)::BIGINT AS lo, (round * fleet + before + cap)::BIGINT AS hi
  FROM (SELECT a.*, need.total, unnest(range(0, greatest(0, ceil((total - before) / fleet))::BIGINT)) AS round
    FROM ahead a JOIN need USING (zone)))"""


@query(
    "j6_greedy_fill",
    f"""WITH {FILL_SQL} SELECT zone::INT AS zone, truck, round::BIGINT AS round, loc,
        (least(l.hi, t.hi) - greatest(l.lo, t.lo))::BIGINT AS kg
      FROM laid l JOIN trips t USING (zone) WHERE l.lo < t.hi AND l.hi > t.lo
      UNION ALL SELECT zone::INT, NULL, NULL, loc, (hi - lo)::BIGINT FROM laid
      WHERE hi > lo AND zone NOT IN (SELECT zone FROM trips)""",
)
def greedy_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer's waste over the trucks of its nation; without trucks it stays, with a NULL truck."""
    places = V.table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("zone"), F.col("c_custkey").alias("loc"),
        F.floor(F.abs("c_acctbal")).cast("bigint").alias("kg"),
    )
    trucks = V.table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("zone"), F.col("s_suppkey").alias("truck")
    )
    trucks = numbered(trucks, ["truck"], F.floor(F.col("truck") / 4096), ["zone"], "truck_ord").withColumn(
        "capacity", truck_capacity(F.col("truck_ord"))
    )
    need = places.groupBy("zone").agg(F.sum("kg").alias("total"))
    laid = L.location_ranges(places, ["loc"], F.floor(F.col("loc") / 4096), ["zone"])
    trips = L.trip_ranges(trucks, need, ["zone"])
    loads = L.greedy_fill(laid, trips, ["zone"]).select("zone", "truck", "round", "loc", "kg")
    loads = loads.unionByName(L.unfilled(laid, trips, ["zone"]).select(*loads.columns))
    return loads.select("zone", "truck", F.col("round").cast("bigint").alias("round"), "loc", "kg")


def _depots(spark: SparkSession, sf: str) -> DataFrame:
    return V.depot_places(spark, sf).withColumn("depot_ord", F.col("loc"))


DEPOT_SQL = f"""{V.MATRIX_SQL},
nearest AS (SELECT a AS first, arg_min(b, (minutes, b)) AS depot FROM matrix WHERE b >= 25 GROUP BY a)"""


@query(
    "a9_closest_depots",
    f"""WITH {V.STOPS_SQL}, {DEPOT_SQL}
      SELECT cand, truck, slot, loc, nearest.depot FROM stops JOIN nearest ON first = loc WHERE pos = 1""",
)
def closest_depots(spark: SparkSession, sf: str) -> DataFrame:
    firsts = V.stops(spark, sf).filter("pos = 1").select("cand", "truck", "slot", "loc")
    near = L.closest_depots(V.travel_minutes(spark, sf), _depots(spark, sf), V.DEPOTS)
    return firsts.join(F.broadcast(near), "loc")  # one row per location, 30 at most


@query(
    "w3_numbered_trips",
    f"""WITH {V.STOPS_SQL}, t AS (SELECT DISTINCT cand, truck, slot FROM stops)
      SELECT cand, truck, slot, row_number() OVER w AS trip_no,
        strftime(TIMESTAMP '{DAY} 10:00:00' + (row_number() OVER w - 1) * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS leaves
      FROM t WINDOW w AS (PARTITION BY cand, truck ORDER BY slot)""",
)
def numbered_trips(spark: SparkSession, sf: str) -> DataFrame:
    trips = V.stops(spark, sf).select(*T.TRIP).distinct()
    out = T.numbered_trips(trips, F.to_timestamp(F.lit(f"{DAY} 10:00:00")))
    return out.withColumn("leaves", F.date_format("leaves", "yyyy-MM-dd HH:mm:ss"))


@query(
    "w4_drawn_slots",
    f"""WITH {V.STOPS_SQL}, {V.SLOTS_SQL},
      t AS (SELECT DISTINCT cand, truck, slot FROM stops),
      n AS (SELECT cand, truck, count(*) AS n FROM t GROUP BY 1, 2),
      r AS (SELECT cand, truck, n, slot, row_number() OVER (PARTITION BY cand, truck
          ORDER BY ('0x' || substr(md5('w4|' || cand || '|' || truck || '|' || slot), 1, 8))::BIGINT, slot) AS rn
        FROM n, slots)
      SELECT cand, truck, row_number() OVER (PARTITION BY cand, truck ORDER BY slot)::INT AS trip_no, slot
      FROM r WHERE rn <= n""",
)
def drawn_slots(spark: SparkSession, sf: str) -> DataFrame:
    trips = V.stops(spark, sf).select(*T.TRIP).distinct()
    counts = trips.groupBy("cand", "truck").agg(F.count("*").cast("int").alias("n"))
    rows = counts.withColumn("_day", L.day_slots(V.slots(spark, sf)))
    chosen = L.drawn_slots("w4", F.col("_day"), F.col("n"), F.col("cand"), F.col("truck"))
    return rows.select("cand", "truck", F.posexplode(chosen).alias("i", "slot")).select(
        "cand", "truck", (F.col("i") + 1).alias("trip_no"), "slot"
    )


# --- legs, costs and views ----------------------------------------------------------------


@query("w5_trip_legs", f"WITH {V.LEGS_SQL} SELECT cand, truck, slot, seq::INT AS seq, a, b FROM leg_parts")
def trip_legs(spark: SparkSession, sf: str) -> DataFrame:
    return T.closed_legs(V.stops(spark, sf))


@query(
    "j5_leg_costs",
    f"WITH {V.LEGS_SQL} SELECT cand, truck, slot, seq::INT AS seq, a, b, cost::BIGINT AS cost FROM costed",
)
def leg_costs(spark: SparkSession, sf: str) -> DataFrame:
    return _costed(spark, sf)


@query("a7_plan_costs", f"WITH {V.LEGS_SQL} SELECT cand, cost FROM costs")
def plan_costs(spark: SparkSession, sf: str) -> DataFrame:
    return _costs(spark, sf)


@query("o1_best_plan", f"WITH {V.LEGS_SQL} SELECT cand, cost FROM costs ORDER BY cost, cand LIMIT 1")
def best_plan(spark: SparkSession, sf: str) -> DataFrame:
    return T.best_plan(_costs(spark, sf))


@query(
    "a8_generation_costs",
    f"""WITH {V.LEGS_SQL} SELECT cand % 10 AS generation, min(cost) AS min, round(avg(cost), 4) AS avg, max(cost) AS max
      FROM costs GROUP BY 1""",
)
def generation_costs(spark: SparkSession, sf: str) -> DataFrame:
    log = S.generation_log(_costs(spark, sf).withColumn("generation", F.col("cand") % 10))
    return log.drop("change").withColumn("avg", F.round("avg", 4))


@query(
    "r9_run_log",
    f"""WITH {V.LEGS_SQL}, g AS (SELECT cand % 10 AS generation, min(cost) AS min FROM costs GROUP BY 1)
      SELECT generation, min, (min - lag(min) OVER (ORDER BY generation))::BIGINT AS change FROM g""",
)
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    log = S.generation_log(_costs(spark, sf).withColumn("generation", F.col("cand") % 10))
    return log.select("generation", "min", "change")


@query(
    "j7_free_slots",
    f"""WITH {V.STOPS_SQL}, {V.SLOTS_SQL}, t AS (SELECT DISTINCT cand, truck FROM stops)
      SELECT cand, truck, slots.slot FROM t, slots
      WHERE NOT EXISTS (SELECT 1 FROM stops s WHERE s.cand = t.cand AND s.truck = t.truck AND s.slot = slots.slot)""",
)
def free_slots(spark: SparkSession, sf: str) -> DataFrame:
    return T.free_slots(V.stops(spark, sf), V.slots(spark, sf))


@query(
    "u3_unvisited_locations",
    f"""WITH {V.STOPS_SQL}, c AS (SELECT DISTINCT cand FROM stops)
      SELECT cand, n_nationkey::INT AS loc FROM c, nation EXCEPT SELECT cand, loc FROM stops""",
)
def unvisited(spark: SparkSession, sf: str) -> DataFrame:
    return T.unvisited(V.stops(spark, sf), V.collection_places(spark, sf))


@query(
    "u3_unvisited_by_truck",
    f"""WITH {V.STOPS_SQL}, c AS (SELECT DISTINCT cand, truck FROM stops)
      SELECT cand * 30 + truck AS cand, n_nationkey::INT AS loc FROM c, nation EXCEPT SELECT cand * 30 + truck, loc FROM stops""",
)
def unvisited_by_truck(spark: SparkSession, sf: str) -> DataFrame:
    """What each truck of a plan leaves to the others: a truck's trips as a plan of their own."""
    own = V.stops(spark, sf).withColumn("cand", F.col("cand") * V.TRUCKS + F.col("truck"))
    return T.unvisited(own, V.collection_places(spark, sf))


@query(
    "w7_truck_schedules",
    f"""WITH {V.STOPS_SQL}, t AS (SELECT cand, truck, slot, string_agg(loc::VARCHAR, ',' ORDER BY pos) AS locs
        FROM stops GROUP BY 1, 2, 3)
      SELECT cand, truck, string_agg(slot || ':' || locs, ' ' ORDER BY slot) AS schedule FROM t GROUP BY 1, 2""",
)
def truck_schedules(spark: SparkSession, sf: str) -> DataFrame:
    lists = T.schedules(V.stops(spark, sf))
    text = F.transform(
        "trips", lambda t: F.concat_ws(":", t["slot"].cast("string"), F.concat_ws(",", t["locs"].cast("array<string>")))
    )
    return lists.select("cand", "truck", F.concat_ws(" ", text).alias("schedule"))


def _routes(spark: SparkSession, sf: str) -> DataFrame:
    return T.named_routes(V.stops(spark, sf), V.names(spark, sf), V.LOCATIONS)


def _view(spark: SparkSession, sf: str) -> DataFrame:
    return T.plan_view(_routes(spark, sf), slot_text(F.col("slot")))


ROUTES_SQL = f"""{V.STOPS_SQL}, {V.NAMES_SQL},
routes AS (SELECT cand, truck, slot, any_value(d.name) || ' -> ' || string_agg(n.name, ' -> ' ORDER BY pos)
    || ' -> ' || any_value(d.name) AS route
  FROM stops JOIN names n USING (loc) JOIN names d ON d.loc = stops.depot GROUP BY 1, 2, 3),
view AS (SELECT cand, truck + 1 AS "Truck", {SLOT_TEXT_SQL} AS "Departure Time", route AS "Locations" FROM routes)"""


@query("j2_route_names", f"WITH {ROUTES_SQL} SELECT cand, truck, slot, route FROM routes")
def route_names(spark: SparkSession, sf: str) -> DataFrame:
    return _routes(spark, sf)


@query("n1_p10_plan_view", f"WITH {ROUTES_SQL} SELECT * FROM view")
def plan_view(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, sf)


@query("p7_trips_of_truck", f'WITH {ROUTES_SQL} SELECT * FROM view WHERE "Truck" = 7')
def trips_of_truck(spark: SparkSession, sf: str) -> DataFrame:
    return T.of_truck(_view(spark, sf), 7)


@query("p8_trips_of_time", f"""WITH {ROUTES_SQL} SELECT * FROM view WHERE "Departure Time" = '{DAY} 14:00:00'""")
def trips_of_time(spark: SparkSession, sf: str) -> DataFrame:
    return T.of_time(_view(spark, sf), f"{DAY} 14:00:00")


@query("p9_trips_of_depot", f"""WITH {ROUTES_SQL} SELECT * FROM view WHERE split_part("Locations", ' ', 1) = 'ASIA'""")
def trips_of_depot(spark: SparkSession, sf: str) -> DataFrame:
    return T.of_depot(_view(spark, sf), "ASIA")


@query("p11_truck_choices", 'SELECT s_suppkey + 1 AS "Truck" FROM supplier ORDER BY 1')
def truck_choices(spark: SparkSession, sf: str) -> DataFrame:
    return T.truck_choices(V.fleet(spark, sf))


@query("p11_time_choices", f'WITH {ROUTES_SQL} SELECT DISTINCT "Departure Time" FROM view ORDER BY 1')
def time_choices(spark: SparkSession, sf: str) -> DataFrame:
    return T.time_choices(_view(spark, sf))


@query(
    "f7_route_text",
    "SELECT c_custkey, c_name || ' -> ' || c_mktsegment || ' -> ' || c_name AS route FROM customer",
)
def route_texts(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "customer").select(
        "c_custkey", route_text(F.array("c_name", "c_mktsegment", "c_name")).alias("route")
    )


@query("f15_first_word", "SELECT p_partkey, split_part(p_name, ' ', 1) AS word FROM part")
def first_words(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "part").select("p_partkey", first_word(F.col("p_name")).alias("word"))


@query(
    "r8_plan_audit",
    f"""WITH {V.STOPS_SQL}, {V.AREAS_SQL},
      more AS (SELECT cand, truck, slot, loc, kg FROM stops UNION ALL SELECT cand, truck, slot, 99, 0 FROM stops WHERE pos = 1),
      p AS (SELECT cand, loc, sum(kg) AS kg, count(*) AS visits FROM more GROUP BY 1, 2),
      q AS (SELECT cand, coalesce(sum(least(p.kg, k.kg)) FILTER (k.kg IS NOT NULL), 0) AS collected,
          coalesce(sum(visits) FILTER (k.kg IS NULL), 0) AS unknown FROM p LEFT JOIN areas k USING (loc) GROUP BY 1),
      t AS (SELECT cand, truck, slot, sum(kg) AS load FROM stops GROUP BY 1, 2, 3),
      u AS (SELECT cand, truck, count(*) FILTER (load > 10000 + 2000 * (truck % 5)) AS over, count(*) AS trips FROM t GROUP BY 1, 2),
      v AS (SELECT cand, sum(over) AS over, count(*) FILTER (trips > 8) AS booked FROM u GROUP BY 1)
      SELECT cand, ((SELECT sum(kg) FROM areas) - collected)::BIGINT AS uncollected_kg, over::BIGINT AS overloaded_trips,
        booked::BIGINT AS overbooked_trucks, unknown::BIGINT AS unknown_stops FROM q JOIN v USING (cand)""",
)
def plan_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Every trip also calls at a place the waste table does not know, without loading."""
    stops = V.stops(spark, sf)
    detour = stops.filter("pos = 1").withColumns({"loc": F.lit(99), "kg": F.lit(0).cast("bigint"), "pos": F.lit(0)})
    return T.audit(stops.unionByName(detour), V.areas(spark, sf), V.plan_trucks(spark, sf), 8, V.LOCATIONS, V.TRUCKS)


# --- visit orders -------------------------------------------------------------------------


def _visits(spark: SparkSession, sf: str, lists: bool = False) -> DataFrame:
    """Every order is a candidate that visits all areas in its own sequence."""
    candidates = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("cand"))
    return P.shuffled_visits(candidates, V.areas(spark, sf), "r7", lists)


def _split(spark: SparkSession, sf: str, lists: bool = False) -> DataFrame:
    return P.capacity_split(_visits(spark, sf, lists=True), lists=lists)


def _tours(spark: SparkSession, sf: str, lists: bool = False) -> DataFrame:
    return P.tour_lengths(
        _split(spark, sf, lists=True), V.travel_minutes(spark, sf), SECOND_TOUR_DEPOTS, MATRIX_ROWS, DEFAULT_MINUTES, lists
    )


VISITS_SQL = f"""{V.AREAS_SQL},
visits AS (SELECT o_orderkey AS cand, row_number() OVER (PARTITION BY o_orderkey
    ORDER BY ('0x' || substr(md5('r7|' || o_orderkey || '|' || loc), 1, 8))::BIGINT, loc) - 1 AS pos, loc, kg
  FROM orders, areas)"""
SPLIT_SQL = f"""{VISITS_SQL},
rests AS (SELECT *, kg // 50000 AS full_loads, kg % 50000 AS rest FROM visits),
ends AS (SELECT *, sum(rest) OVER w - rest AS s, sum(rest) OVER w AS e, sum(full_loads) OVER w AS closed
  FROM rests WINDOW w AS (PARTITION BY cand ORDER BY pos)),
keyed AS (SELECT *, greatest((s + 49999) // 50000 - 1, 0) AS k0, greatest((e + 49999) // 50000 - 1, 0) AS k1 FROM ends),
shared AS (SELECT cand, pos, loc, closed, s, e, unnest(range(k0::BIGINT, k1::BIGINT + 1)) AS k FROM keyed),
shared_idx AS (SELECT cand, k, k + max(closed) AS idx FROM shared GROUP BY cand, k),
split AS (
  SELECT cand, unnest(range((closed - full_loads + k0)::BIGINT, (closed + k0)::BIGINT)) AS idx, true AS dedicated, pos, loc,
    50000 AS kg FROM keyed WHERE full_loads > 0
  UNION ALL
  SELECT cand, i.idx, false, pos, loc, greatest(least(e, 50000 * (k + 1)) - greatest(s, 50000 * k), 0)
  FROM shared JOIN shared_idx i USING (cand, k))"""
TOURS_SQL = f"""{SPLIT_SQL}, {V.MATRIX_SQL},
tour_legs AS (
  SELECT cand, idx, 0 AS which, lag(loc) OVER w AS a, loc AS b FROM split WINDOW w AS (PARTITION BY cand, idx ORDER BY pos)
  UNION ALL SELECT cand, idx, d, 27 + d, arg_min(loc, pos) FROM split, range(1, 3) r(d) GROUP BY cand, idx, d
  UNION ALL SELECT cand, idx, d, arg_max(loc, pos), 27 + d FROM split, range(1, 3) r(d) GROUP BY cand, idx, d),
tours AS (SELECT cand, idx, sum(coalesce(minutes, 30)) FILTER (which <> 2) AS from_first,
    sum(coalesce(minutes, 30)) FILTER (which <> 1) AS from_second
  FROM tour_legs LEFT JOIN matrix USING (a, b) WHERE tour_legs.a IS NOT NULL GROUP BY cand, idx)"""


@query("r7_visit_orders", f"WITH {VISITS_SQL} SELECT cand, pos::INT AS pos, loc, kg FROM visits")
def visit_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _visits(spark, sf)


@query(
    "w2_capacity_split",
    f"WITH {SPLIT_SQL} SELECT cand, idx::BIGINT AS idx, dedicated, pos::INT AS pos, loc, kg::BIGINT AS kg FROM split",
)
def capacity_split(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf)


@query(
    "w6_tour_lengths",
    f"""WITH {TOURS_SQL} SELECT cand, idx::BIGINT AS idx, from_first::BIGINT AS from_first, from_second::BIGINT AS from_second,
        from_first < from_second AS first_shorter, least(from_first, from_second)::BIGINT AS shortest FROM tours""",
)
def tour_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return _tours(spark, sf)


@query(
    "o2_ranked_choices",
    f"""WITH {TOURS_SQL} SELECT cand, dist::BIGINT AS dist, depot, idx::BIGINT AS idx FROM (
        SELECT cand, from_first AS dist, 1 AS depot, idx FROM tours
        UNION ALL SELECT cand, from_second, 2, idx FROM tours) ORDER BY cand, dist, depot, idx""",
)
def ranked_choices(spark: SparkSession, sf: str) -> DataFrame:
    return P.ranked_choices(_tours(spark, sf))


@query(
    "w8_depot_shares",
    f"""WITH RECURSIVE {TOURS_SQL},
      choices AS (SELECT cand, dist, depot, idx, row_number() OVER (PARTITION BY cand ORDER BY dist, depot, idx) AS n FROM (
        SELECT cand, from_first AS dist, 1 AS depot, idx FROM tours UNION ALL SELECT cand, from_second, 2, idx FROM tours)),
      caps AS (SELECT cand, floor(max(idx) * 1.2::DOUBLE / 2) AS cap, count(*) AS routes FROM tours GROUP BY cand),
      fold(cand, n, one, two, done, total) AS (
        SELECT cand, 0::BIGINT, 0::BIGINT, 0::BIGINT, []::BIGINT[], 0::BIGINT FROM caps
        UNION ALL
        SELECT f.cand, f.n + 1, f.one + CASE WHEN t.takes AND c.depot = 1 THEN 1 ELSE 0 END,
          f.two + CASE WHEN t.takes AND c.depot = 2 THEN 1 ELSE 0 END,
          CASE WHEN t.takes THEN list_append(f.done, c.idx::BIGINT) ELSE f.done END,
          f.total + CASE WHEN t.takes THEN c.dist::BIGINT ELSE 0 END
        FROM fold f JOIN choices c ON c.cand = f.cand AND c.n = f.n + 1 JOIN caps ON caps.cand = f.cand,
          LATERAL (SELECT NOT list_contains(f.done, c.idx::BIGINT)
            AND CASE WHEN c.depot = 1 THEN f.one ELSE f.two END < caps.cap AS takes) t)
      SELECT f.cand, total AS distance, one AS first_depot, two AS second_depot,
        (routes - len(done))::BIGINT AS unassigned FROM fold f JOIN caps ON caps.cand = f.cand AND f.n = 2 * routes""",
)
def depot_shares(spark: SparkSession, sf: str) -> DataFrame:
    out = P.depot_shares(_tours(spark, sf, lists=True))
    return out.withColumn("unassigned", F.col("unassigned").cast("bigint"))


@query(
    "a12_distinct_routes",
    f"""WITH {TOURS_SQL}, r AS (SELECT cand, idx, string_agg(loc::VARCHAR, ',' ORDER BY pos) AS route FROM split GROUP BY 1, 2)
      SELECT DISTINCT CASE WHEN from_first < from_second THEN 1 ELSE 2 END AS depot, route FROM r JOIN tours USING (cand, idx)""",
)
def distinct_routes(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf, lists=True)
    tours = P.tour_lengths(split, V.travel_minutes(spark, sf), SECOND_TOUR_DEPOTS, MATRIX_ROWS, DEFAULT_MINUTES, lists=True)
    return P.distinct_routes(split, tours).withColumn("route", F.concat_ws(",", F.col("route").cast("array<string>")))


def _orders_as_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Visit orders as one array per candidate, rotated by the candidate's number."""
    locs = V.areas(spark, sf).agg(F.sort_array(F.collect_list("loc"))).scalar()
    rows = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("cand"), locs.alias("all"))
    shift = (F.col("cand") % F.size("all")).cast("int")
    return rows.select(
        "cand",
        F.concat(F.slice("all", shift + 1, F.size("all")), F.slice("all", F.lit(1), shift)).alias("order"),
    )


def _swap_sql(i: int, probability: float, source: str) -> str:
    def h(tag):
        return f"('0x' || substr(md5('r10-{tag}{i}|' || cand), 1, 8))::BIGINT"

    return f"""s{i} AS (SELECT cand, CASE WHEN {h('gate')} < {int(probability * 2**32)} THEN
        list_transform(o, lambda x: CASE WHEN x = o[{h('place')} % len(o) + 1] THEN list_sort(o)[{h('value')} % len(o) + 1]
          WHEN x = list_sort(o)[{h('value')} % len(o) + 1] THEN o[{h('place')} % len(o) + 1] ELSE x END)
        ELSE o END AS o FROM {source})"""


@query(
    "r10_swapped_orders",
    f"""WITH start AS (SELECT o_orderkey AS cand, list_transform(range(0, 25), lambda i: (i + o_orderkey) % 25) AS o FROM orders),
      {_swap_sql(0, 0.8, 'start')}, {_swap_sql(1, 0.5, 's0')}, {_swap_sql(2, 0.2, 's1')}
      SELECT cand, array_to_string(o, ',') AS "order" FROM s2""",
)
def swapped_orders(spark: SparkSession, sf: str) -> DataFrame:
    out = P.swapped(_orders_as_arrays(spark, sf), "r10")
    return out.withColumn("order", F.concat_ws(",", F.col("order").cast("array<string>")))


# --- population search --------------------------------------------------------------------


def _first_population(spark: SparkSession, sf: str, fleet: DataFrame | None = None) -> DataFrame:
    """A candidate plan per customer over all areas and the whole fleet."""
    areas = V.areas(spark, sf)
    need = areas.agg(F.sum("kg").alias("total"))
    trips = written(L.trip_ranges(V.fleet(spark, sf) if fleet is None else fleet, need), "trips")
    candidates = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("cand"))
    return S.initial_population(
        candidates, areas, trips, V.travel_minutes(spark, sf), _depots(spark, sf), V.slots(spark, sf), "r1",
        location_rows=V.LOCATIONS,
    )


POPULATION_START_SQL = f"""{V.AREAS_SQL}, {V.FLEET_SQL}, {DEPOT_SQL}, {V.SLOTS_SQL},
laid0 AS (SELECT c_custkey AS cand, loc, kg, row_number() OVER (PARTITION BY c_custkey
    ORDER BY ('0x' || substr(md5('r1|' || c_custkey || '|' || loc), 1, 8))::BIGINT, loc) AS pos FROM customer, areas),
laid AS (SELECT *, (sum(kg) OVER w - kg)::BIGINT AS lo, (sum(kg) OVER w)::BIGINT AS hi FROM laid0
  WINDOW w AS (PARTITION BY cand ORDER BY pos)),
ahead AS (SELECT *, sum(capacity) OVER (ORDER BY truck_ord) - capacity AS before, sum(capacity) OVER () AS total_cap,
  (SELECT sum(kg) FROM areas) AS total FROM fleet),
trips0 AS (SELECT *, unnest(range(0, greatest(0, ceil((total - before) / total_cap))::BIGINT)) AS round FROM ahead),
trips AS (SELECT truck, round, (round * total_cap + before)::BIGINT AS lo, (round * total_cap + before + capacity)::BIGINT AS hi,
  count(*) OVER (PARTITION BY truck) AS booked FROM trips0),
loads AS (SELECT cand, truck, round, booked, loc, least(l.hi, t.hi) - greatest(l.lo, t.lo) AS kg,
    row_number() OVER (PARTITION BY cand, truck, round ORDER BY l.lo) AS pos
  FROM laid l JOIN trips t ON l.lo < t.hi AND l.hi > t.lo),
firsts AS (SELECT cand, truck, round, n.depot FROM loads JOIN nearest n ON n.first = loc WHERE pos = 1),
draws AS (SELECT cand, truck, booked, slot, row_number() OVER (PARTITION BY cand, truck
    ORDER BY ('0x' || substr(md5('r1-slots|' || cand || '|' || truck || '|' || slot), 1, 8))::BIGINT, slot) AS rn
  FROM (SELECT DISTINCT cand, truck, booked FROM loads), slots),
drawn AS (SELECT cand, truck, slot, row_number() OVER (PARTITION BY cand, truck ORDER BY slot) - 1 AS round
  FROM draws WHERE rn <= booked AND booked <= (SELECT count(*) FROM slots)),
population AS (SELECT cand, truck, round, d.slot, pos, loc, kg, depot
  FROM loads JOIN firsts USING (cand, truck, round) LEFT JOIN drawn d USING (cand, truck, round))"""


@query(
    "r1_initial_population",
    f"""WITH {POPULATION_START_SQL} SELECT cand, truck, round::BIGINT AS round, slot, pos::INT AS pos, loc, kg::BIGINT AS kg,
        depot FROM population""",
)
def initial_population(spark: SparkSession, sf: str) -> DataFrame:
    out = _first_population(spark, sf)
    return out.withColumn("round", F.col("round").cast("bigint"))


def _first_costs(spark: SparkSession, sf: str, stops: DataFrame) -> DataFrame:
    legs = T.closed_legs(spread(stops, "cand"))  # trips, trucks and candidates then need no further shuffle
    costed = T.leg_costs(
        legs, V.travel_minutes(spark, sf), V.slots(spark, sf), "percent", MATRIX_ROWS, DEFAULT_MINUTES
    )
    trucks = V.table(spark, sf, "supplier").count()
    return T.plan_costs(costed, trucks, PENALTY)


@query(
    "r2_population_costs",
    f"""WITH {POPULATION_START_SQL}, legs AS (
        SELECT cand, truck, slot, coalesce(lag(loc) OVER w, depot) AS a, loc AS b FROM population
          WINDOW w AS (PARTITION BY cand, truck, slot ORDER BY pos)
        UNION ALL SELECT cand, truck, slot, arg_max(loc, pos), any_value(depot) FROM population GROUP BY cand, truck, slot)
      SELECT cand, (sum(coalesce(minutes, 30) * percent) + ((SELECT count(*) FROM supplier) - count(DISTINCT truck)) * 100000)::BIGINT
        AS cost FROM legs LEFT JOIN matrix USING (a, b) JOIN slots USING (slot) GROUP BY cand""",
)
def population_costs(spark: SparkSession, sf: str) -> DataFrame:
    return _first_costs(spark, sf, _first_population(spark, sf))


@query(
    "r3_tournament",
    f"""WITH {V.LEGS_SQL}, {POPULATION_SQL},
      e AS (SELECT cand AS place, ('0x' || substr(md5('select-' || i || '|' || cand), 1, 8))::BIGINT % n AS cand
        FROM costs, pop, range(0, 3) r(i))
      SELECT place, arg_min(e.cand, (cost, e.cand)) AS cand, min(cost) AS cost FROM e JOIN costs USING (cand) GROUP BY place""",
)
def tournament(spark: SparkSession, sf: str) -> DataFrame:
    return S.tournament(_costs(spark, sf), _population(spark, sf))


@query(
    "r4_crossover",
    f"""WITH {V.STOPS_SQL}, {POPULATION_SQL}, h AS (SELECT stops.*, n,
        1 + ('0x' || substr(md5('cross-cut|' || (cand // 2)), 1, 8))::BIGINT % 29 AS cut,
        ('0x' || substr(md5('cross-gate|' || (cand // 2)), 1, 8))::BIGINT < {int(0.3 * 2**32)} AS gate FROM stops, pop)
      SELECT CASE WHEN gate AND truck >= cut AND xor(cand, 1) < n THEN xor(cand, 1) ELSE cand END AS cand,
        truck, slot, pos::INT AS pos, loc, kg, depot FROM h""",
)
def crossover(spark: SparkSession, sf: str) -> DataFrame:
    return S.crossed(V.stops(spark, sf), _population(spark, sf), V.TRUCKS)


CROSSED_SQL = f"""{V.STOPS_SQL}, {POPULATION_SQL}, h AS (SELECT stops.*, n,
    1 + ('0x' || substr(md5('cross-cut|' || (cand // 2)), 1, 8))::BIGINT % 29 AS cut,
    ('0x' || substr(md5('cross-gate|' || (cand // 2)), 1, 8))::BIGINT < {int(0.3 * 2**32)} AS gate FROM stops, pop),
  crossed AS (SELECT CASE WHEN gate AND truck >= cut AND xor(cand, 1) < n THEN xor(cand, 1) ELSE cand END AS cand,
    truck, slot, pos, loc, depot FROM h)"""
# One step visits the next stop of every candidate; the rest of a location is kept in a map.
REPAIR_SQL = f"""{CROSSED_SQL}, {V.AREAS_SQL},
  visits AS MATERIALIZED (SELECT *, 10000 + 2000 * (truck % 5) AS capacity, row_number() OVER (PARTITION BY cand ORDER BY truck, slot, pos) AS i FROM crossed),
  walk AS (
    SELECT cand, 0::BIGINT AS i, (SELECT list(kg ORDER BY loc) FROM areas) AS rest, NULL::INT AS truck, NULL::INT AS slot, 0::BIGINT AS room, 0::BIGINT AS taken,
      0::BIGINT AS kg, NULL::INT AS loc, NULL::INT AS depot FROM (SELECT DISTINCT cand FROM visits)
    UNION ALL
    SELECT cand, i, list_transform(rest, lambda v, k: CASE WHEN k = spot THEN v - load ELSE v END), truck, slot, open - load,
      before + (load > 0)::INT, load, loc, depot
    FROM (SELECT *, CASE WHEN open > 0 AND before < 3 AND rest[spot] > 0 THEN least(open, rest[spot]) ELSE 0 END AS load
      FROM (SELECT v.cand, v.i, w.rest, v.truck, v.slot, v.loc, v.depot, list_position((SELECT list(loc ORDER BY loc) FROM areas), v.loc) AS spot,
          CASE WHEN w.truck = v.truck AND w.slot = v.slot THEN w.room ELSE v.capacity END AS open,
          CASE WHEN w.truck = v.truck AND w.slot = v.slot THEN w.taken ELSE 0 END AS before
        FROM walk w JOIN visits v ON v.cand = w.cand AND v.i = w.i + 1))),
  made AS (SELECT cand, truck, slot, taken AS pos, loc, kg, depot, room, i FROM walk WHERE kg > 0),
  finals AS (SELECT cand, rest FROM walk QUALIFY row_number() OVER (PARTITION BY cand ORDER BY i DESC) = 1),
  opened AS (SELECT m.*, k, row_number() OVER (PARTITION BY cand ORDER BY truck, k) AS j
    FROM (SELECT * FROM made QUALIFY row_number() OVER (PARTITION BY cand, truck ORDER BY slot DESC, pos DESC) = 1) m, range(1, 3) t(k) WHERE m.pos + k <= 3),
  unseen AS (SELECT f.cand, a.loc, f.rest[a.spot] AS kg, row_number() OVER (PARTITION BY f.cand ORDER BY a.loc) AS j
    FROM finals f, (SELECT loc, row_number() OVER (ORDER BY loc) AS spot FROM areas) a
    WHERE f.rest[a.spot] > 0 AND NOT EXISTS (SELECT 1 FROM made m WHERE m.cand = f.cand AND m.loc = a.loc)),
  late AS (SELECT o.cand, o.truck, o.slot, o.pos + o.k AS pos, u.loc, o.depot, o.room, u.kg,
      coalesce(sum(u.kg) OVER (PARTITION BY o.cand, o.truck ORDER BY o.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM opened o JOIN unseen u ON u.cand = o.cand AND u.j = o.j)"""


@query(
    "r5_repaired_plans",
    f"""WITH RECURSIVE {REPAIR_SQL}
      SELECT cand, truck::BIGINT AS truck, slot::BIGINT AS slot, pos::INT AS pos, loc::BIGINT AS loc, kg::BIGINT AS kg, depot::BIGINT AS depot FROM made
      UNION ALL SELECT cand, truck, slot, pos, loc, greatest(0, least(kg, room - ahead))::BIGINT, depot FROM late""",
)
def repaired_plans(spark: SparkSession, sf: str) -> DataFrame:
    children = S.crossed(V.stops(spark, sf), _population(spark, sf), V.TRUCKS)
    return S.repaired(children, V.areas(spark, sf), V.plan_trucks(spark, sf), V.TRUCKS)


@query(
    "r6_mutated_plans",
    f"""WITH {V.STOPS_SQL}, {V.SLOTS_SQL}, day AS (SELECT list_sort(list(slot)) AS day FROM slots),
      t AS (SELECT DISTINCT cand, truck, slot FROM stops),
      tk AS (SELECT cand, truck, list_sort(list(slot)) AS taken FROM t GROUP BY 1, 2),
      o AS (SELECT t.*, taken, row_number() OVER (PARTITION BY cand ORDER BY
          ('0x' || substr(md5('mutate-order|' || cand || '|' || truck || '|' || slot), 1, 8))::BIGINT, truck, slot) - 1 AS place
        FROM t JOIN tk USING (cand, truck)),
      g AS (SELECT * FROM o WHERE ('0x' || substr(md5('mutate-gate|' || cand), 1, 8))::BIGINT < {int(0.2 * 2**32)}),
      p AS (SELECT x.cand, x.place // 2 AS pair, x.truck AS t1, x.slot AS s1, x.taken AS k1, y.truck AS t2, y.slot AS s2,
          y.taken AS k2 FROM g x JOIN g y ON x.cand = y.cand AND y.place = x.place + 1 WHERE x.place % 2 = 0),
      w AS (SELECT *, NOT list_contains(k1, s2) AND NOT list_contains(k2, s1) AS swap,
          list_filter(day, lambda s: NOT list_contains(k1, s)) AS free FROM p, day),
      asked AS (
        SELECT cand, pair, 2 AS needs, t1 AS truck, s1 AS slot, t2 AS to_truck, s1 AS to_slot FROM w WHERE swap
        UNION ALL SELECT cand, pair, 2, t2, s2, t1, s2 FROM w WHERE swap
        UNION ALL SELECT cand, pair, 1, t1, s1, t1,
          free[('0x' || substr(md5('mutate-free|' || cand || '|' || t1 || '|' || s1), 1, 8))::BIGINT % len(free) + 1]
          FROM w WHERE NOT swap AND len(free) > 0),
      won AS (SELECT *, row_number() OVER (PARTITION BY cand, to_truck, to_slot ORDER BY pair) = 1 AS won FROM asked),
      granted AS (SELECT * FROM won QUALIFY count(*) FILTER (won) OVER (PARTITION BY cand, pair) = needs)
      SELECT s.cand, coalesce(to_truck, s.truck)::INT AS truck, coalesce(to_slot, s.slot)::INT AS slot, pos::INT AS pos, loc, kg, depot
      FROM stops s LEFT JOIN granted g ON g.cand = s.cand AND g.truck = s.truck AND g.slot = s.slot""",
)
def mutated_plans(spark: SparkSession, sf: str) -> DataFrame:
    return S.mutated(V.stops(spark, sf), V.slots(spark, sf))


# --- candidates that cannot be driven -------------------------------------------------------

SHORT_DAY_SQL = f"""{V.STOPS_SQL}, {V.SLOTS_SQL}, {V.MATRIX_SQL},
day AS (SELECT slot FROM slots WHERE slot < 19),
old AS (SELECT cand, truck, slot, row_number() OVER (PARTITION BY cand, truck ORDER BY slot) - 1 AS round,
  count(*) OVER (PARTITION BY cand, truck) AS n FROM (SELECT DISTINCT cand, truck, slot FROM stops)),
ranked AS (SELECT cand, truck, n, d.slot, row_number() OVER (PARTITION BY cand, truck
    ORDER BY ('0x' || substr(md5('short|' || cand || '|' || truck || '|' || d.slot), 1, 8))::BIGINT, d.slot) AS rn
  FROM (SELECT DISTINCT cand, truck, n FROM old), day d),
drawn AS (SELECT cand, truck, slot, row_number() OVER (PARTITION BY cand, truck ORDER BY slot) - 1 AS round
  FROM ranked WHERE rn <= n AND n <= (SELECT count(*) FROM day)),
plan AS (SELECT s.cand, s.truck, o.round, d.slot, s.pos, s.loc, s.kg, s.depot
  FROM stops s JOIN old o USING (cand, truck, slot) LEFT JOIN drawn d ON d.cand = s.cand AND d.truck = s.truck AND d.round = o.round),
plan_legs AS (SELECT cand, truck, round, slot, coalesce(lag(loc) OVER w, depot) AS a, loc AS b FROM plan
    WINDOW w AS (PARTITION BY cand, truck, round ORDER BY pos)
  UNION ALL SELECT cand, truck, round, any_value(slot), arg_max(loc, pos), any_value(depot) FROM plan GROUP BY cand, truck, round),
plan_costs AS (SELECT cand, CASE WHEN count(*) FILTER (percent IS NULL) = 0
    THEN (sum(coalesce(minutes, 30) * percent) + (30 - count(DISTINCT truck)) * 100000)::BIGINT END AS cost
  FROM plan_legs LEFT JOIN matrix USING (a, b) LEFT JOIN slots USING (slot) GROUP BY cand)"""


def _short_day(spark: SparkSession, sf: str) -> DataFrame:
    """The candidate plans on a day whose last hour is closed; busy trucks find too few slots."""
    stops = V.stops(spark, sf)
    trips = stops.select(*T.TRIP).distinct()
    turns = trips.groupBy("cand", "truck").agg(F.sort_array(F.collect_list("slot")).alias("old"))
    day = L.day_slots(V.slots(spark, sf).filter("slot < 19"))
    chosen = L.drawn_slots("short", F.col("_day"), F.size("old"), F.col("cand"), F.col("truck"))
    places = turns.withColumn("_day", day).withColumn("new", chosen).select("cand", "truck", "new", F.posexplode("old").alias("round", "slot"))
    moved = stops.join(places, T.TRIP).withColumn("slot", F.get("new", F.col("round"))).drop("new")
    return moved.withColumn("round", F.col("round").cast("bigint"))


def _short_day_costs(spark: SparkSession, sf: str) -> DataFrame:
    legs = T.closed_legs(_short_day(spark, sf))
    costed = T.leg_costs(legs, V.travel_minutes(spark, sf), V.slots(spark, sf), "percent", MATRIX_ROWS, DEFAULT_MINUTES)
    return T.plan_costs(costed, V.TRUCKS, PENALTY)


@query("r2_overbooked_costs", f"WITH {SHORT_DAY_SQL} SELECT cand, cost, cost IS NOT NULL AS feasible FROM plan_costs")
def overbooked_costs(spark: SparkSession, sf: str) -> DataFrame:
    return T.with_feasible(_short_day_costs(spark, sf))


@query(
    "r3_overbooked_tournament",
    f"""WITH {SHORT_DAY_SQL}, {POPULATION_SQL},
      e AS (SELECT cand AS place, ('0x' || substr(md5('select-' || i || '|' || cand), 1, 8))::BIGINT % n AS cand
        FROM plan_costs, pop, range(0, 3) r(i)),
      r AS (SELECT place, cand, cost, row_number() OVER (PARTITION BY place ORDER BY cost NULLS LAST, cand) AS rn
        FROM e JOIN plan_costs USING (cand))
      SELECT place, cand, cost FROM r WHERE rn = 1""",
)
def overbooked_tournament(spark: SparkSession, sf: str) -> DataFrame:
    """Every place has a winner; one that cannot be driven wins only if all its draws are such."""
    return S.tournament(_short_day_costs(spark, sf), _population(spark, sf))


@query(
    "r8_overbooked_audit",
    f"""WITH {SHORT_DAY_SQL}, {V.AREAS_SQL},
      p AS (SELECT cand, loc, sum(kg) AS kg FROM plan GROUP BY 1, 2),
      q AS (SELECT cand, sum(least(p.kg, k.kg)) AS collected FROM p JOIN areas k USING (loc) GROUP BY 1),
      t AS (SELECT cand, truck, round, sum(kg) AS load FROM plan GROUP BY 1, 2, 3),
      u AS (SELECT cand, truck, count(*) FILTER (load > 10000 + 2000 * (truck % 5)) AS over, count(*) AS trips FROM t GROUP BY 1, 2),
      v AS (SELECT cand, sum(over) AS over, count(*) FILTER (trips > (SELECT count(*) FROM day)) AS booked FROM u GROUP BY 1)
      SELECT cand, ((SELECT sum(kg) FROM areas) - collected)::BIGINT AS uncollected_kg, over::BIGINT AS overloaded_trips,
        booked::BIGINT AS overbooked_trucks, 0::BIGINT AS unknown_stops FROM q JOIN v USING (cand)""",
)
def overbooked_audit(spark: SparkSession, sf: str) -> DataFrame:
    return T.audit(_short_day(spark, sf), V.areas(spark, sf), V.plan_trucks(spark, sf), 9, V.LOCATIONS, V.TRUCKS)


REGION_START_SQL = POPULATION_START_SQL.replace(V.FLEET_SQL, V.REGION_FLEET_SQL)


@query(
    "r1_overbooked_population",
    f"""WITH {REGION_START_SQL} SELECT cand, truck, round::BIGINT AS round, slot, pos::INT AS pos, loc, kg::BIGINT AS kg,
        depot FROM population""",
)
def overbooked_population(spark: SparkSession, sf: str) -> DataFrame:
    """Five trucks for everything: no truck has slots enough, and no stop is lost."""
    out = _first_population(spark, sf, V.region_fleet(spark, sf))
    return out.withColumn("round", F.col("round").cast("bigint"))


@query("r9_search_generations")
def search_generations(spark: SparkSession, sf: str) -> DataFrame:
    """Five generations of select, cross, repair and mutate over a plan per customer."""
    fleet = V.fleet(spark, sf, "r9-fleet")  # drawn order: working trucks lie on both sides of a crossing
    start = written(_first_population(spark, sf, fleet), "population")
    population = V.table(spark, sf, "customer").select(F.count("*").alias("n"))
    trucks = written(fleet, "fleet")
    count = trucks.count()
    matrix = written(V.travel_minutes(spark, sf), "matrix")
    slots = written(V.slots(spark, sf), "slots")

    def cost_of(stops: DataFrame) -> DataFrame:
        legs = T.closed_legs(spread(stops, "cand"))  # trips, trucks and candidates then need no further shuffle
        costed = T.leg_costs(legs, matrix, slots, "percent", MATRIX_ROWS, DEFAULT_MINUTES)
        return T.plan_costs(costed, count, PENALTY)

    _, log = S.run(start, cost_of, population, V.areas(spark, sf), trucks, slots, count, GENERATIONS)
    return log


def best_initial_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: cheapest plan of the first population, as the published table."""
    stops = written(_first_population(spark, sf), "population")
    best = T.best_plan(_first_costs(spark, sf, stops))
    chosen = stops.join(best.select("cand"), "cand", "left_semi")
    routes = T.named_routes(chosen, V.names(spark, sf), V.LOCATIONS)
    return T.plan_view(routes, slot_text(F.col("slot"))).orderBy("Truck", "Departure Time")


QUERIES["n1_best_plan_view"] = best_initial_plan
ORACLE["n1_best_plan_view"] = f"""WITH {POPULATION_START_SQL}, legs AS (
    SELECT cand, truck, slot, coalesce(lag(loc) OVER w, depot) AS a, loc AS b FROM population
      WINDOW w AS (PARTITION BY cand, truck, slot ORDER BY pos)
    UNION ALL SELECT cand, truck, slot, arg_max(loc, pos), any_value(depot) FROM population GROUP BY cand, truck, slot),
  costs AS (SELECT cand, sum(coalesce(minutes, 30) * percent)
      + ((SELECT count(*) FROM supplier) - count(DISTINCT truck)) * 100000 AS cost
    FROM legs LEFT JOIN matrix USING (a, b) JOIN slots USING (slot) GROUP BY cand),
  best AS (SELECT cand FROM costs ORDER BY cost, cand LIMIT 1), {V.NAMES_SQL}
  SELECT cand, truck + 1 AS "Truck", {SLOT_TEXT_SQL} AS "Departure Time", any_value(d.name) || ' -> '
      || string_agg(n.name, ' -> ' ORDER BY pos) || ' -> ' || any_value(d.name) AS "Locations"
  FROM population JOIN best USING (cand) JOIN names n USING (loc) JOIN names d ON d.loc = population.depot
  GROUP BY cand, truck, slot"""
