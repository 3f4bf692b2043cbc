"""Schemas and the few column names everything else agrees on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIPLE = ["space_id", "zone_device_id", "zone_device_control_id"]
FLAGS = ["is_online", "is_scenario"]
READING = [*TRIPLE, "ts", *FLAGS, "value"]

# Device types and the control tag that makes a device of that type relevant.
METER_TYPES = ["elemeter", "watermeter"]
CO2_TYPE = "airpurifiercontrol"
CAMERA_TYPE = "camera"
METER_TAG = 1020
CAMERA_TAG = 1010
CO2_TAG = 1050

# Field names of the device messages.
RAW_READING = (
    "spaceId bigint, zoneDeviceId bigint, zoneDeviceControlId bigint, ts timestamp, "
    "isOnline boolean, value string, isScenario boolean"
)
SNAKE_NAMES = {
    "spaceId": "space_id",
    "zoneDeviceId": "zone_device_id",
    "zoneDeviceControlId": "zone_device_control_id",
    "isOnline": "is_online",
    "isScenario": "is_scenario",
}
METER_MESSAGE = (
    "space_id bigint, zone_device_id bigint, zone_device_control_id bigint, ts string, "
    "is_online boolean, value double, is_scenario boolean"
)
CAMERA_MESSAGE = "space_id bigint, ts string, is_online boolean, value int, is_scenario boolean"

HISTORY_READING = (
    "space_id bigint, zone_device_id bigint, zone_device_control_id bigint, ts timestamp, "
    "is_online boolean, is_scenario boolean, value double"
)
HOURLY_METER = (
    "space_id bigint, zone_device_id bigint, zone_device_control_id bigint, date_time_key timestamp, "
    "is_online boolean, is_scenario boolean, value double"
)
REGISTRY_ROW = (
    "_id string, space_id bigint, zone_device_id bigint, zone_device_control_id bigint, "
    "zone_device_control_tag int, device_type string, table string, unit string"
)
LAST_KNOWN = (
    "space_id bigint, zone_device_id bigint, zone_device_control_id bigint, ts timestamp, "
    "value string, load int"
)
HISTORY_RESPONSE =f"data struct<reads: array<struct<{RAW_READING.replace(' ', ': ').replace(',:', ',')}>>>"

# The 34 columns of the wide export, in output order.
WIDE_EXPORT = [
    "space_id", "zone_device_id", "zone_device_control_id", "event_datetime", "is_online",
    "current_value", "average_value", "year", "month", "day", "hour", "minute", "second",
    "zone_id", "control_id", "zone_device_control_tag", "zone_device_control_code",
    "zone_device_code", "control_value_type_c", "zone_code", "project_id", "space_code",
    "space_type_c", "project_code", "is_community", "is_scenario", "accumulate_value",
    "last_value", "frequency", "date_key", "date_time_key", "created_at", "device_id",
    "device_type",
]


def to_session_ts(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become session-zone timestamps (watermarks need those)."""
    return _cast_all(df, T.TimestampNTZType, "timestamp")


def to_ntz(df: DataFrame) -> DataFrame:
    """Session-zone timestamps become zone-less ones, for output that other engines compare."""
    return _cast_all(df, T.TimestampType, "timestamp_ntz")


def _cast_all(df: DataFrame, source: type, target: str) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, source)]
    return df.withColumns({n: F.col(n).cast(target) for n in names}) if names else df
