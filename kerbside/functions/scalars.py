"""Column functions used across the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bound (exclusive) of each travel-time band and its multiplier.
TRAFFIC_BANDS = [(350.0, 1.5), (325.0, 1.25), (300.0, 1.1), (275.0, 1.05)]
FREE_FLOW = 1.0

# Ordered levels of the vehicle condition columns.
CONDITION_LEVELS = {
    "Tire_Condition": ["Worn Out", "Good", "New"],
    "Brake_Condition": ["Worn Out", "Good", "New"],
    "Owner_Type": ["First", "Second", "Third"],
    "Maintenance_History": ["Poor", "Average", "Good"],
}

DEFAULT_KPH = 40
LOCAL_ZONE = "Asia/Singapore"
SLOT_FORMAT = "yyyy-MM-dd HH:mm:ss"
ROUTE_JOINER = " -> "


def traffic_multiplier(total: Column) -> Column:
    """Slow-down factor of a travel-time total; missing and NaN count as free flow."""
    value = total.cast("double")
    out = F.when(value.isNull() | F.isnan(value), FREE_FLOW)
    for bound, factor in TRAFFIC_BANDS:
        out = out.when(value > bound, factor)
    return out.otherwise(FREE_FLOW)


def slot_label(ts: Column) -> Column:
    return F.date_format(ts, SLOT_FORMAT)


def local_time(ts: Column) -> Column:
    return F.from_utc_timestamp(ts, LOCAL_ZONE)


def route_text(names: Column) -> Column:
    return F.concat_ws(ROUTE_JOINER, names)


def first_word(text: Column) -> Column:
    return F.split(text, " ")[0]


def day_month_year(text: Column) -> Column:
    return F.to_date(text, "d/M/yyyy")


def days_since(day: Column, as_of: Column) -> Column:
    return F.datediff(as_of, day)


def days_until(day: Column, as_of: Column) -> Column:
    """Whole days left, counting the running day as already spent."""
    return F.datediff(day, as_of) - 1


def level_code(value: Column, levels: Sequence[str]) -> Column:
    """Position in ``levels``; -1 for values outside it and for NULL."""
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in levels]), value) - 1, F.lit(-1)).cast(
        "int"
    )


def level_flags(name: str, value: Column, levels: Sequence[str]) -> list[Column]:
    """One boolean per level except the alphabetically first."""
    return [
        F.coalesce(value == level, F.lit(False)).alias(f"{name}_{level}") for level in sorted(levels)[1:]
    ]


def speed_limit(tags: Column) -> Column:
    """Lowest listed limit in km/h, or the default when none is given."""
    return F.coalesce(F.array_min(F.transform(tags, lambda t: t.cast("int"))), F.lit(DEFAULT_KPH))


def edge_minutes(length: Column, kph: Column) -> Column:
    metres_per_second = kph * 1000 / 3600
    return F.when(length == 0, F.lit(0.0)).otherwise(length / metres_per_second / 60)


def scaled(value: Column, low: Column, high: Column) -> Column:
    """Min-max scaling without clipping; a constant column maps to 0."""
    return F.when(high == low, F.lit(0.0)).otherwise((value - low) / (high - low))


def unscaled_all(values: Column, low: Column, high: Column) -> Column:
    return F.transform(values, lambda v: v * (high - low) + low)


def truck_capacity(index: Column) -> Column:
    """10000, 12000, ... 18000 kg repeating by truck index."""
    return (10000 + 2000 * F.pmod(index, F.lit(5))).cast("bigint")
