"""Telling what sent a reading and where the reading goes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.scalars import as_double, as_int, device_key
from wattline.functions.timecols import format_time
from wattline.operators.lookup import lookup_join
from wattline.schemas import (
    CAMERA_TAG,
    CAMERA_TYPE,
    CO2_TAG,
    CO2_TYPE,
    FLAGS,
    METER_TAG,
    METER_TYPES,
    SNAKE_NAMES,
    TRIPLE,
)

# Topic per kind of device; callers pass their own names.
TOPICS = {
    "meter": "device-ele-water-data",
    "camera": "device-camera-data",
    "co2": "device-air-co2-data",
}
# Registry table per kind of device, and the table of devices turned down.
REGISTRY_TABLES = {"meter": "DEVICE_ELE_WATER", "co2": "DEVICE_AIR_CO2", "camera": "DEVICE_CAMERA"}
INVALID_TABLE = "INVALID_DEVICE"


def flatten(parsed: DataFrame, struct: str = "data") -> DataFrame:
    """Expand the parsed message and use snake-case names.

    ``inline`` in place of ``struct.*`` keeps later filters above the parser; pushed below it they
    would parse every message once more per filtered field.
    """
    return parsed.select(F.inline(F.array(struct))).withColumnsRenamed(SNAKE_NAMES)


def live(readings: DataFrame) -> DataFrame:
    """Online readings that no scenario made; null flags do not count."""
    return readings.filter(~F.col("is_scenario") & F.col("is_online"))


def kind_of(device_type: Column) -> Column:
    """meter, co2 or camera; null for any other type."""
    return (
        F.when(device_type.isin(METER_TYPES), "meter")
        .when(device_type == CO2_TYPE, "co2")
        .when(device_type == CAMERA_TYPE, "camera")
    )


def is_meter(device_type: Column, tag: Column) -> Column:
    return device_type.isin(METER_TYPES) & (tag == METER_TAG)


def is_relevant(device_type: Column, tag: Column) -> Column:
    """The device types that count, each only with its own control tag."""
    return (
        is_meter(device_type, tag)
        | ((device_type == CAMERA_TYPE) & (tag == CAMERA_TAG))
        | ((device_type == CO2_TYPE) & (tag == CO2_TAG))
    )


def relevant_devices(master: DataFrame) -> DataFrame:
    return master.filter(is_relevant(F.col("device_type_c"), F.col("zone_device_control_tag")))


def enrich(readings: DataFrame, registry: DataFrame) -> DataFrame:
    """Every reading with its registered type and tag, null when the device is not registered."""
    dim = registry.select(*TRIPLE, "device_type", "zone_device_control_tag")
    return lookup_join(readings, dim, TRIPLE)


def known(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("device_type").isNotNull())


def unknown(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("device_type").isNull())


def not_yet_invalid(readings: DataFrame, invalid: DataFrame) -> DataFrame:
    """Readings of devices that are not already listed as invalid."""
    return lookup_join(readings, invalid.select(*TRIPLE).distinct(), TRIPLE, "left_anti")


def resolve(readings: DataFrame, master: DataFrame) -> DataFrame:
    """Every reading with the type and tag of the master table; null when it has no such device."""
    dim = relevant_devices(master).select(
        *TRIPLE, "device_type_c", F.col("zone_device_control_tag").alias("zone_device_control")
    )
    return lookup_join(readings, dim, TRIPLE)


def device_directory(registry: DataFrame, invalid: DataFrame, master: DataFrame) -> DataFrame:
    """All three device tables as one row per device, so that a reading needs a single join."""
    none = F.lit(None)
    tables = [
        registry.select(
            *TRIPLE,
            "device_type",
            F.lit(False).alias("listed_invalid"),
            none.cast("string").alias("device_type_c"),
            none.cast("int").alias("master_tag"),
        ),
        invalid.select(
            *TRIPLE,
            none.cast("string").alias("device_type"),
            F.lit(True).alias("listed_invalid"),
            none.cast("string").alias("device_type_c"),
            none.cast("int").alias("master_tag"),
        ),
        relevant_devices(master).select(
            *TRIPLE,
            none.cast("string").alias("device_type"),
            F.lit(False).alias("listed_invalid"),
            "device_type_c",
            F.col("zone_device_control_tag").cast("int").alias("master_tag"),
        ),
    ]
    merged = reduce(DataFrame.unionByName, tables)
    return merged.groupBy(*TRIPLE).agg(
        *(F.max(c).alias(c) for c in ["device_type", "listed_invalid", "device_type_c", "master_tag"])
    )


def classify(
    readings: DataFrame, registry: DataFrame, invalid: DataFrame, master: DataFrame
) -> DataFrame:
    """One pass over the readings that gives each its ``route``.

    ``known`` devices are registered; ``newly_known`` ones are found in the master table;
    ``listed_invalid`` ones were turned down before; ``invalid`` ones are turned down now.
    ``kind`` is meter, co2 or camera for the first two and null otherwise (a registered device of
    another type is known but goes nowhere).
    """
    return classify_by(readings, device_directory(registry, invalid, master))


def classify_by(readings: DataFrame, directory: DataFrame) -> DataFrame:
    """:func:`classify` with a directory that is at hand."""
    joined = lookup_join(readings, directory, TRIPLE)
    route = (
        F.when(F.col("device_type").isNotNull(), "known")
        .when(F.col("listed_invalid"), "listed_invalid")
        .when(F.col("device_type_c").isNotNull(), "newly_known")
        .otherwise("invalid")
    )
    found = F.when(F.col("route") == "known", F.col("device_type")).when(
        F.col("route") == "newly_known", F.col("device_type_c")
    )
    return (
        joined.withColumn("route", route)
        .withColumn("found_type", found)
        .select(
            *TRIPLE,
            "ts",
            *FLAGS,
            "value",
            "route",
            F.col("found_type").alias("device_type"),
            F.when(F.col("route") == "newly_known", F.col("master_tag")).alias("device_tag"),
            kind_of(F.col("found_type")).alias("kind"),
        )
    )


def typed_values(routed: DataFrame) -> DataFrame:
    """The reading as a double for meters and CO2 sensors, as an integer for cameras."""
    return routed.withColumns(
        {
            "value_double": F.when(F.col("kind").isin("meter", "co2"), as_double(F.col("value"))),
            "value_int": F.when(F.col("kind") == "camera", as_int(F.col("value"))),
        }
    )


def messages(
    routed: DataFrame, topics: dict[str, str] = TOPICS, batch_id: int | None = None
) -> DataFrame:
    """Topic, key and JSON value of every routed reading whose value has the type its kind needs.

    ``batch_id`` goes into the message, so that readers know a batch that was published twice.
    """
    stamp = format_time(F.col("ts"))
    body = [*TRIPLE, stamp.alias("ts"), "is_online"]
    tail = ["is_scenario"] if batch_id is None else ["is_scenario", F.lit(batch_id).alias("batch")]
    number = F.to_json(F.struct(*body, F.col("value_double").alias("value"), *tail))
    count = F.to_json(F.struct(*body, F.col("value_int").alias("value"), *tail))
    topic = F.create_map(*(F.lit(x) for pair in topics.items() for x in pair))[F.col("kind")]
    return (
        typed_values(routed)
        .filter(F.coalesce(F.col("value_double"), F.col("value_int").cast("double")).isNotNull())
        .select(
            topic.alias("topic"),
            stamp.alias("key"),
            F.when(F.col("kind") == "camera", count).otherwise(number).alias("value"),
        )
    )


def registry_rows(routed: DataFrame) -> DataFrame:
    """Devices to write back, once each, with the table they belong to and their key."""
    target = F.create_map(*(F.lit(x) for pair in REGISTRY_TABLES.items() for x in pair))
    return (
        routed.filter(F.col("route").isin("newly_known", "invalid"))
        .groupBy(*TRIPLE)
        .agg(
            F.max("device_type").alias("device_type"),
            F.max("device_tag").alias("zone_device_control_tag"),
            F.max("kind").alias("kind"),
        )
        .select(
            F.coalesce(target[F.col("kind")], F.lit(INVALID_TABLE)).alias("table"),
            device_key().alias("key"),
            *TRIPLE,
            "zone_device_control_tag",
            "device_type",
        )
    )
