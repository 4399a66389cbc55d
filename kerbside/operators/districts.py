"""Waste sheet, districts and the collection nodes they map to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.running import small_side
from kerbside.sources.files import DISTRICT_AREA, SHEET_AREA, SHEET_KG, SHEET_SUBZONE


def area_totals(sheet: DataFrame) -> DataFrame:
    """Subtotal rows without the national total, which bears no area's name; first and last sheet columns only."""
    totals = sheet.filter((F.col(SHEET_SUBZONE) == "Total") & (F.col(SHEET_AREA) != "Total"))
    return totals.select(SHEET_AREA, SHEET_KG)


def with_waste(districts: DataFrame, totals: DataFrame, areas: int | None = None) -> DataFrame:
    """Left join on the area name; ``areas`` bounds the totals when known."""
    matched = districts[DISTRICT_AREA] == totals[SHEET_AREA]
    return districts.join(small_side(totals, areas), matched, "left").drop(SHEET_AREA)


def not_empty(districts: DataFrame) -> DataFrame:
    """Drop districts with zero waste; unmatched ones stay, as NULL is not zero."""
    return districts.filter(~F.col(SHEET_KG).eqNullSafe(F.lit(0.0)))


def excluding(districts: DataFrame, areas: Sequence[str]) -> DataFrame:
    return districts.filter(~F.col(DISTRICT_AREA).isin(list(areas)))


def node_names(snapped: DataFrame) -> DataFrame:
    """Name of each collection node: the last district that snapped to it."""
    return snapped.groupBy("node").agg(F.max_by(DISTRICT_AREA, "ordinal").alias(DISTRICT_AREA))


def node_waste(snapped: DataFrame, rule: str = "first") -> DataFrame:
    """Waste of each node: its name's first district row, or the sum of its districts."""
    if rule == "sum":
        return snapped.groupBy("node").agg(
            F.max_by(DISTRICT_AREA, "ordinal").alias(DISTRICT_AREA), F.sum("kg").alias("kg")
        )
    first = snapped.groupBy(DISTRICT_AREA).agg(F.min_by("kg", "ordinal").alias("kg"))
    return node_names(snapped).join(first, DISTRICT_AREA)
