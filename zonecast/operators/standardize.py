"""Standardising raw inputs: names, types and timestamps (P1-P10 composed).

Both functions are pure projections: one narrow stage, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from zonecast.functions.columns import (cast_to_schema, drop_columns, lowercase_columns,
                                        recode_borough, rename_columns, tolerant_cast)
from zonecast.functions.timecols import RIDERSHIP_TS_FORMAT, convert_time

# Ridership feed columns not used downstream.
RIDERSHIP_DROP = ("station_complex", "payment_method", "transfers", "routes",
                  "georeference")

# Trip columns dropped once the calendar parts exist (only the
# zone ids and passenger count are aggregated further).
TRIP_DROP = ("pu_time", "do_time", "fare_amount", "tip_amount", "total_amount",
             "trip_distance", "vendorid", "ratecodeid", "store_and_fwd_flag",
             "payment_type", "extra", "mta_tax", "congestion_surcharge",
             "improvement_surcharge", "tolls_amount", "airport_fee")

# Trip columns whose type the common schema sets, whatever the
# landed month's footer says (counts and codes as int, the flag as boolean).
TRIP_TYPE_OVERRIDES = {"passenger_count": IntegerType(), "ratecodeid": IntegerType(),
                       "payment_type": IntegerType(), "store_and_fwd_flag": BooleanType()}

# Landing names of the trip timestamps (after lower-casing).
TRIP_RENAMES = {"tpep_pickup_datetime": "pu_time", "tpep_dropoff_datetime": "do_time"}


def standardize_ridership(raw: DataFrame, ts_format: str = RIDERSHIP_TS_FORMAT) -> DataFrame:
    """Raw ridership text -> typed rows: lower-case names, drop unused
    columns, tolerant casts (malformed -> NULL), rename, parse the timestamp,
    recode borough codes to names."""
    df = drop_columns(lowercase_columns(raw), RIDERSHIP_DROP)
    df = df.withColumns({
        "ridership": tolerant_cast("ridership", "int"),
        "latitude": tolerant_cast("latitude", "double"),
        "longitude": tolerant_cast("longitude", "double"),
    })
    df = rename_columns(df, {"transit_timestamp": "timestamp",
                             "station_complex_id": "station_id"})
    return recode_borough(convert_time(df, "timestamp", ts_format))


def trip_template(footer: StructType) -> StructType:
    """The common trip schema from one landed month's footer: lower-cased
    names, with the override types applied by name."""
    return StructType([
        StructField(f.name.lower(), TRIP_TYPE_OVERRIDES.get(f.name.lower(), f.dataType), True)
        for f in footer.fields])


def standardize_trips(month: DataFrame, template: StructType) -> DataFrame:
    """One landed month -> the common trip schema: lower-case names, cast
    **by name** to the template (drifted types converge, missing columns
    become typed NULLs, reordered months stay correct), rename the two
    timestamps."""
    df = cast_to_schema(lowercase_columns(month), template)
    return rename_columns(df, TRIP_RENAMES)
