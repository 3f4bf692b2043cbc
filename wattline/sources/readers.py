"""Readers. Formats, paths and options (and so all hosts and secrets) come from the caller."""

from __future__ import annotations

from datetime import date
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattline.functions.scalars import has_dash
from wattline.schemas import RAW_READING, REGISTRY_ROW, TRIPLE


def topic_options(
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str = "latest",
    max_per_trigger: int | None = None,
    **more: str,
) -> dict[str, str]:
    """Options of a message source. Offsets are kept in the query's checkpoint, never committed
    back; ``more`` takes security and time-out settings as they are."""
    out = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        **more,
    }
    if group is not None:
        out["groupIdPrefix"] = group
    if max_per_trigger is not None:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return out


def read_messages(
    spark: SparkSession, fmt: str = "kafka", options: dict[str, str] | None = None
) -> DataFrame:
    """Stream of raw messages in ``value``."""
    return spark.readStream.format(fmt).options(**(options or {})).load()


def read_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    schema: str = RAW_READING,
    value: str = "value",
) -> DataFrame:
    """Subscribe to JSON messages and parse them to ``data``; texts that do not parse are null."""
    raw = read_messages(spark, fmt, options)
    return raw.select(parse_message(F.col(value), schema).alias("data"))


def parse_message(value: Column, schema: str = RAW_READING) -> Column:
    return F.from_json(value.cast("string"), schema)


def parse_ragged(raw: DataFrame, value: str = "value") -> DataFrame:
    """Messages whose fields may be missing or of another type than declared: ``data`` as
    :func:`parse_message` gives it, and ``refused``, the text where that cannot be read.

    The text is parsed once to a VARIANT, and each field is taken out of it by itself; numbers that come
    as text, or text as numbers, are converted. Refused are texts that are not JSON objects, and those
    without device or time.
    """
    schema = StructType.fromDDL(RAW_READING)
    text = F.col(value).cast("string")
    parsed = raw.withColumn("_message", F.try_parse_json(text))

    def field(name: str, kind: str) -> Column:
        if kind == "timestamp":
            return F.try_variant_get("_message", f"$.{name}", "string").try_cast("timestamp")
        return F.try_variant_get("_message", f"$.{name}", kind)

    data = F.struct(*(field(f.name, f.dataType.simpleString()).alias(f.name) for f in schema))
    needed = [f.name for f in schema if f.name not in ("isOnline", "value", "isScenario")]
    whole = parsed.withColumn("data", data)
    readable = F.lit(True)
    for name in needed:
        readable = readable & F.col(f"data.{name}").isNotNull()
    return whole.select(
        F.when(readable, F.col("data")).alias("data"), F.when(~readable, F.coalesce(text, F.lit(""))).alias("refused")
    )


def published_once(messages: DataFrame, schema: str, lateness: str = "10 minutes") -> DataFrame:
    """A topic read back without the repeats of batches that were published more than once.

    ``messages`` is a stream with the message text in ``value``; ``schema`` declares its fields, among
    them the device, ``ts`` and ``batch``. A repeat comes within the lateness, so the keys seen are
    forgotten with the watermark.
    """
    parsed = messages.withColumn("_read", F.from_json(F.col("value").cast("string"), schema))
    timed = parsed.withColumn("_at", F.col("_read.ts").try_cast("timestamp")).filter("_at is not null")
    keyed = timed.withColumns({f"_{c}": F.col(f"_read.{c}") for c in (*TRIPLE, "batch")})
    once = keyed.withWatermark("_at", lateness).dropDuplicatesWithinWatermark(
        [*(f"_{c}" for c in TRIPLE), "_batch", "_at", "value"]
    )
    return once.select(*messages.columns)


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """The number of rows of a Parquet table from the statistics in its files; no column is read.

    The count is pushed into the Parquet reader, for which a session of its own turns the settings on.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))


def scan(
    spark: SparkSession,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    schema: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Table scan; with ``schema`` declared, else the schema the source states."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def stored_or_empty(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A table, or no rows of ``schema`` when nothing has been written to it yet."""
    try:
        return scan(spark, fmt, options, path=path)
    except AnalysisException as failed:
        if failed.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def registry_scan(
    spark: SparkSession,
    root: str,
    tables: str = "DEVICE_*",
    fmt: str = "parquet",
    id_column: str = "_id",
    keyed_only: bool = True,
    missing_ok: bool = False,
) -> DataFrame:
    """Registry tables whose folder name matches a glob; by default only rows whose id has a dash.

    Ids may be stored as text, hence the casts. With ``missing_ok`` a registry into which nothing has
    been written yet has no rows; otherwise it is an error.
    """
    root = root.rstrip("/")
    options = {"basePath": root}
    if missing_ok:
        found = stored_or_empty(spark, f"{root}/{tables}", REGISTRY_ROW, fmt, options)
    else:
        found = scan(spark, fmt, options, path=f"{root}/{tables}")
    if keyed_only:
        found = found.filter(has_dash(F.col(id_column)))
    return found.withColumns({c: F.col(c).cast("bigint") for c in TRIPLE})


def distinct_devices(registry: DataFrame) -> DataFrame:
    return registry.select(*TRIPLE).distinct()


def time_range(
    df: DataFrame, column: str, start: Any, end: Any, date_column: str | None = None
) -> DataFrame:
    """Half-open range. The bounds take the type of the column, so the filter reaches the scan.

    ``date_column`` names a column with the date of ``column``, as tables partitioned by date have;
    the range then also prunes partitions.
    """
    kind = df.schema[column].dataType
    end = F.lit(end).cast(kind)
    picked = since(df, column, start, date_column).filter(F.col(column) < end)
    if date_column is None:
        return picked
    return picked.filter(F.col(date_column).cast("date") <= F.to_date(end))


def since(df: DataFrame, column: str, start: Any, date_column: str | None = None) -> DataFrame:
    """Rows from a time on; ``date_column`` as for :func:`time_range`."""
    start = F.lit(start).cast(df.schema[column].dataType)
    picked = df.filter(F.col(column) >= start)
    if date_column is None:
        return picked
    return picked.filter(F.col(date_column).cast("date") >= F.to_date(start))


def dated_scan(
    spark: SparkSession,
    path: str,
    as_of: date,
    days_back: int = 1,
    columns: list[str] | None = None,
    fmt: str = "parquet",
    date_column: str = "date_key",
) -> DataFrame:
    """The partition of one day of a table partitioned by date; other days are not listed."""
    day = F.date_sub(F.lit(as_of), days_back)
    picked = spark.read.format(fmt).load(path).filter(F.col(date_column).cast("date") == day)
    return picked.select(*columns) if columns else picked


def jdbc_options(
    table: str,
    options: dict[str, str],
    partition_column: str | None = None,
    lower: Any = None,
    upper: Any = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read; with a partition column the table is read by several tasks."""
    out = {"fetchsize": str(fetch_size), **options, "dbtable": table}
    if partition_column is None:
        return out
    if None in (lower, upper, partitions):
        raise ValueError("a partitioned read needs lower, upper and partitions")
    return {
        **out,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def jdbc_scan(spark: SparkSession, table: str, options: dict[str, str], **bounds: Any) -> DataFrame:
    """JDBC table; filters and columns chosen later are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(table, options, **bounds)).load()
