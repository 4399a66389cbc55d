"""Vehicle features, the train/test split and the scored fleet table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.draws import draw
from kerbside.functions.scalars import (
    CONDITION_LEVELS,
    day_month_year,
    days_since,
    days_until,
    level_code,
    level_flags,
)

# Columns, levels and names of the encoded vehicle table.
DATE_COLUMNS = ["Last_Service_Date", "Warranty_Expiry_Date"]
UNUSED_COLUMNS = DATE_COLUMNS + ["Vehicle_Model", "Fuel_Type"]
SINCE_SERVICE, WARRANTY_LEFT = "Days_since_last_service", "Warranty Days remaining"
TRANSMISSIONS = ["Automatic", "Manual"]
MANUAL = "Transmission_Type_Manual"
FEATURES = [
    "Mileage", "Maintenance_History", "Reported_Issues", "Vehicle_Age", "Engine_Size", "Odometer_Reading",
    "Owner_Type", "Insurance_Premium", "Service_History", "Accident_History", "Fuel_Efficiency",
    "Tire_Condition", "Brake_Condition", SINCE_SERVICE, WARRANTY_LEFT, MANUAL,
]
SCALED_FEATURES = [
    "Mileage", "Engine_Size", "Odometer_Reading", "Insurance_Premium", "Fuel_Efficiency",
    SINCE_SERVICE, WARRANTY_LEFT,
]
TEST_PERCENT, SPLIT_SEED = 33, "42"


def parsed_dates(vehicles: DataFrame) -> DataFrame:
    return vehicles.withColumns({c: day_month_year(F.col(c)) for c in DATE_COLUMNS})


def with_day_counts(dated: DataFrame, as_of: str) -> DataFrame:
    today = F.lit(as_of).cast("date")
    return dated.withColumns(
        {
            SINCE_SERVICE: days_since(F.col("Last_Service_Date"), today),
            WARRANTY_LEFT: days_until(F.col("Warranty_Expiry_Date"), today),
        }
    )


def without_unused(vehicles: DataFrame) -> DataFrame:
    return vehicles.drop(*UNUSED_COLUMNS)


def with_level_codes(vehicles: DataFrame) -> DataFrame:
    return vehicles.withColumns({c: level_code(F.col(c), v) for c, v in CONDITION_LEVELS.items()})


def with_transmission_flag(vehicles: DataFrame) -> DataFrame:
    """Dummy columns over the fixed level list, so every batch has the same columns."""
    flags = level_flags("Transmission_Type", F.col("Transmission_Type"), TRANSMISSIONS)
    return vehicles.select("*", *flags).drop("Transmission_Type")


def encoded(vehicles: DataFrame, as_of: str) -> DataFrame:
    """Raw vehicle rows to model features; one projection, no shuffle."""
    dated = with_day_counts(parsed_dates(vehicles), as_of)
    return with_transmission_flag(with_level_codes(without_unused(dated)))


def text_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c, t in df.dtypes if t == "string"])


def number_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c, t in df.dtypes if t in ("int", "bigint", "float", "double")])


def is_test_row(row_id: Column) -> Column:
    """Stable split by row id; adding rows never moves old ones."""
    return draw(SPLIT_SEED, row_id) % 100 < TEST_PERCENT


def scored_fleet(features: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Id, features and verdict in the order the fleet table is published."""
    return features.select("Truck_ID", *FEATURES, F.col(prediction).cast("int").alias("Need_Maintenance"))
