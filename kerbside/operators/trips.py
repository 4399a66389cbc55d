"""Trips of a plan: legs, costs, schedules, views and checks.

A plan is a table of stops ``(cand, truck, slot, pos, loc, kg, depot)``, with a
``round`` where trips may lack a slot.  A trip is ``(cand, truck, slot)`` and the
round, if there is one; it starts and ends at its depot and visits a location
once, so windows over a trip or a candidate see few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.functions.running import small_side
from kerbside.functions.scalars import first_word, route_text

TRIP = ["cand", "truck", "slot"]
IDLE_PENALTY = 1000
STOPS_PER_TRIP = 3


def trip_key(stops: DataFrame) -> list[str]:
    """Columns that tell trips apart; without a slot only the round does."""
    return [*TRIP, *(c for c in ("round",) if c in stops.columns)]


def closed_legs(stops: DataFrame, trip: Sequence[str] | None = None) -> DataFrame:
    """Consecutive legs ``(trip, seq, a, b)`` from the depot around and back."""
    trip = trip_key(stops) if trip is None else trip
    order = W.partitionBy(*trip).orderBy("pos")
    before = F.coalesce(F.lag("loc").over(order), F.col("depot"))
    last = F.lead("loc").over(order).isNull()
    rows = stops.select(*trip, "pos", "loc", "depot", before.alias("_before"), last.alias("_last"))
    inward = F.struct(F.col("pos").alias("seq"), F.col("_before").alias("a"), F.col("loc").alias("b"))
    homeward = F.struct((F.col("pos") + 1).alias("seq"), F.col("loc").alias("a"), F.col("depot").alias("b"))
    return rows.select(*trip, F.inline(F.when(F.col("_last"), F.array(inward, homeward)).otherwise(F.array(inward))))


def leg_costs(
    legs: DataFrame, matrix: DataFrame, slots: DataFrame, factor: str = "modifier",
    matrix_rows: int | None = None, default_minutes: int | None = None, slot_rows: int | None = 24,
) -> DataFrame:
    """Add ``cost``: the leg's minutes times its slot's slow-down.

    ``matrix_rows`` bounds the matrix (locations squared) when known; the slots
    of one day are at most 24.  ``default_minutes`` stands in for a missing pair.
    A leg without a slot of the day costs NULL.
    """
    timed = legs.join(small_side(matrix, matrix_rows), ["a", "b"], "left")
    minutes = F.col("minutes")
    if default_minutes is not None:
        minutes = F.coalesce(minutes, F.lit(default_minutes))
    scaled = timed.join(small_side(slots.select("slot", factor), slot_rows), "slot", "left")
    return scaled.withColumn("cost", minutes * F.col(factor)).drop("minutes", factor)


def plan_costs(costed: DataFrame, trucks: int, idle_penalty: int = IDLE_PENALTY) -> DataFrame:
    """Total cost per candidate with the penalty of its idle trucks.

    A candidate with a trip that has no slot cannot be driven: its cost is NULL.
    """
    per_truck = costed.groupBy("cand", "truck").agg(F.sum("cost").alias("cost"), F.count_if(F.col("cost").isNull()).alias("lost"))
    total = F.sum("cost") + (trucks - F.count("*")) * F.lit(idle_penalty)
    return per_truck.groupBy("cand").agg(F.when(F.sum("lost") == 0, total).alias("cost"))


def with_feasible(costs: DataFrame) -> DataFrame:
    """Whether a candidate can be driven, beside its cost."""
    return costs.withColumn("feasible", F.col("cost").isNotNull())


def best_plan(costs: DataFrame, n: int = 1) -> DataFrame:
    """The cheapest candidates; those that cannot be driven come last."""
    return costs.orderBy(F.asc_nulls_last("cost"), "cand").limit(n)


def trips_where(
    stops: DataFrame, truck: int | None = None, slot: object = None, depot: int | None = None
) -> DataFrame:
    """Stops of one truck, departure slot or depot; path drawing starts from these,
    so only the legs asked for are walked."""
    for column, value in (("truck", truck), ("slot", slot), ("depot", depot)):
        if value is not None:
            stops = stops.filter(F.col(column) == value)
    return stops


def free_slots(stops: DataFrame, slots: DataFrame) -> DataFrame:
    """Slots ``(cand, truck, slot)`` a truck in use does not leave in."""
    day = slots.agg(F.sort_array(F.collect_set("slot"))).scalar()
    taken = stops.groupBy("cand", "truck").agg(F.collect_set("slot").alias("taken"))
    return taken.withColumn("_day", day).select(
        "cand", "truck", F.explode(F.array_except("_day", "taken")).alias("slot")
    )


def unvisited(stops: DataFrame, locations: DataFrame) -> DataFrame:
    """Locations ``(cand, loc)`` no trip of the candidate visits."""
    everywhere = locations.agg(F.sort_array(F.collect_set("loc"))).scalar()
    seen = stops.groupBy("cand").agg(F.collect_set("loc").alias("seen"))
    return seen.withColumn("_all", everywhere).select(
        "cand", F.explode(F.array_except("_all", "seen")).alias("loc")
    )


def named_routes(stops: DataFrame, names: DataFrame, name_rows: int | None = None) -> DataFrame:
    """Trips with their route as text, depot first and last."""
    loc_names = small_side(names.select("loc", "name"), name_rows)
    depot_names = small_side(names.select(F.col("loc").alias("depot"), F.col("name").alias("depot_name")), name_rows)
    trips = (
        stops.join(loc_names, "loc")
        .groupBy(*TRIP, "depot")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("visits"))
        .join(depot_names, "depot")
    )
    home = F.array("depot_name")
    route = F.concat(home, F.transform("visits", lambda v: v["name"]), home)
    return trips.select(*TRIP, route_text(route).alias("route"))


def plan_view(routes: DataFrame, label: Column) -> DataFrame:
    """The published table: truck number from 1, departure time, route text."""
    return routes.select(
        "cand",
        (F.col("truck") + 1).alias("Truck"),
        label.alias("Departure Time"),
        F.col("route").alias("Locations"),
    )


def of_truck(view: DataFrame, truck: int) -> DataFrame:
    return view.filter(F.col("Truck") == truck)


def of_time(view: DataFrame, slot: str) -> DataFrame:
    return view.filter(F.col("Departure Time") == slot)


def of_depot(view: DataFrame, depot: str) -> DataFrame:
    """Trips whose route text starts with the depot's name as its first word."""
    return view.filter(first_word(F.col("Locations")) == depot)


def truck_choices(trucks: DataFrame) -> DataFrame:
    """All trucks, idle ones included, in order."""
    return trucks.select((F.col("truck") + 1).alias("Truck")).distinct().orderBy("Truck")


def time_choices(view: DataFrame) -> DataFrame:
    return view.select("Departure Time").distinct().orderBy("Departure Time")


def schedules(stops: DataFrame) -> DataFrame:
    """Trips of each truck in departure order as ``(cand, truck, trips)``."""
    trips = stops.groupBy(*TRIP).agg(F.sort_array(F.collect_list(F.struct("pos", "loc"))).alias("visits"))
    item = F.struct("slot", F.transform("visits", lambda v: v["loc"]).alias("locs"))
    return trips.groupBy("cand", "truck").agg(F.sort_array(F.collect_list(item)).alias("trips"))


def numbered_trips(trips: DataFrame, start: Column) -> DataFrame:
    """Number a truck's trips from 1 and give each the hour after the one before."""
    order = W.partitionBy("cand", "truck").orderBy("slot")
    rows = trips.withColumn("trip_no", F.row_number().over(order))
    return rows.withColumn("leaves", start + F.make_interval(hours=F.col("trip_no") - 1))


def audit(
    stops: DataFrame, locations: DataFrame, trucks: DataFrame, slots: int,
    location_rows: int | None = None, truck_rows: int | None = None,
) -> DataFrame:
    """Per candidate: kilograms left behind, overloaded trips, trucks with more
    trips than slots, and stops at unknown locations."""
    known = small_side(locations.select("loc", F.col("kg").alias("waste")), location_rows)
    total = locations.select(F.sum("kg")).scalar()
    by_place = stops.groupBy("cand", "loc").agg(F.sum("kg").alias("kg"), F.count("*").alias("visits")).join(known, "loc", "left")
    places = by_place.groupBy("cand").agg(
        F.sum(F.when(F.col("waste").isNotNull(), F.least("kg", "waste"))).alias("collected"),
        F.sum(F.when(F.col("waste").isNull(), F.col("visits")).otherwise(0)).alias("unknown_stops"),
    )
    by_trip = stops.groupBy(*trip_key(stops)).agg(F.sum("kg").alias("load"))
    loaded = by_trip.join(small_side(trucks.select("truck", "capacity"), truck_rows), "truck")
    by_truck = loaded.groupBy("cand", "truck").agg(
        F.count_if(F.col("load") > F.col("capacity")).alias("over"), F.count("*").alias("trips")
    )
    loads = by_truck.groupBy("cand").agg(
        F.sum("over").alias("overloaded_trips"), F.count_if(F.col("trips") > slots).alias("overbooked_trucks")
    )
    return places.join(loads, "cand").select(
        "cand",
        (total - F.coalesce("collected", F.lit(0))).alias("uncollected_kg"),
        "overloaded_trips", "overbooked_trucks", "unknown_stops",
    )
