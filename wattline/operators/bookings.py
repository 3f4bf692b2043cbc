"""Bookings, their extension periods, and the hours they cover.

The reporting window is 31 dates for the usual 30 days. Extensions are clipped to it and folded
to one row per booking (a day bitmap and a day count) *before* any join, and the 24 hours per day
are only generated at the end, from rows that are already distinct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.timecols import dates_between, hours_of_day, shift
from wattline.operators.lookup import fits_broadcast, lookup_join, settle

# Which bookings count.
BOOKING_TYPE = "tenant"
BOOKING_STATES = ["completed", "active", "rerenting"]
CANCELED = "canceled"
ROOM = "room"
MIN_STAY_DAYS = 15
MAX_EXTENSION_DAYS = 15
START_SHIFT_HOURS = 8
END_SHIFT_HOURS = 0

_BITS = 62


@dataclass(frozen=True)
class Period:
    """The reporting window: ``days`` + 1 dates that end the day before ``as_of``."""

    as_of: str
    days: int = 30

    @property
    def last(self) -> Column:
        return F.date_sub(F.lit(self.as_of).cast("date"), 1)

    @property
    def first(self) -> Column:
        return F.date_sub(self.last, self.days)

    @property
    def second(self) -> Column:
        return F.date_add(self.first, 1)

    @property
    def words(self) -> range:
        """Indices of the bitmap words that hold one bit per date."""
        return range(self.days // _BITS + 1)


def bits_per_word() -> int:
    """Dates that one bitmap word holds."""
    return _BITS


def _midnight(df: DataFrame, column: str, day: Column) -> Column:
    """Start of a day in the type of a column, so that a comparison with it reaches the scan."""
    return day.cast(df.schema[column].dataType)


def local_bounds(df: DataFrame, start: str, end: str) -> DataFrame:
    """Shift a stored start and end by the fixed hours."""
    return df.withColumns(
        {
            f"local_{start}": shift(F.col(start), hours=START_SHIFT_HOURS),
            f"local_{end}": shift(F.col(end), hours=END_SHIFT_HOURS),
        }
    )


def current_bookings(bookings: DataFrame, period: Period, order_id: int | None = None) -> DataFrame:
    """Tenant bookings of more than 15 days that cover the whole reporting window."""
    picked = bookings.filter(
        (F.col("order_type_c") == BOOKING_TYPE)
        & F.col("status_c").isin(BOOKING_STATES)
        & (F.datediff("check_out_date", "check_in_date") > MIN_STAY_DAYS)
        & (F.col("check_out_date") >= _midnight(bookings, "check_out_date", period.last))
        & (F.col("check_in_date") < _midnight(bookings, "check_in_date", period.second))
    )
    if order_id is not None:
        picked = picked.filter(F.col("id") == order_id)
    return local_bounds(
        picked.withColumnRenamed("id", "order_id"), "check_in_date", "check_out_date"
    ).withColumns({"current_date": period.last, "last_month_date": period.first})


def live_extensions(extensions: DataFrame, period: Period) -> DataFrame:
    """Extensions that are not canceled and were created since the window began."""
    picked = extensions.filter(
        (F.col("status_c") != CANCELED)
        & (F.col("created_at") >= _midnight(extensions, "created_at", period.first))
    )
    return local_bounds(picked, "start_date", "end_date")


def actual_space(history_space: Column, space: Column) -> Column:
    """The space of the history row when it has one, else the booking's own."""
    return F.coalesce(F.nullif(history_space, F.lit("")), space.cast("string")).cast("bigint")


def with_actual_space(bookings: DataFrame, history: DataFrame) -> DataFrame:
    """Every booking once per different space in its history; ``copies`` counts its history rows.

    Repeated history rows become a count before the join, so a booking with very many of them
    stays one row per space.
    """
    spaces = (
        history.select("order_id", F.col("space_id").cast("string").alias("history_space_id"))
        .groupBy("order_id", "history_space_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return (
        bookings.join(spaces, "order_id", "left")
        .withColumn("space_id", actual_space(F.col("history_space_id"), F.col("space_id")))
        .withColumn("copies", F.coalesce("copies", F.lit(1)))
        .drop("history_space_id")
    )


def booking_days(bookings: DataFrame, repeat_start: bool = False) -> DataFrame:
    """One row per booking and date of the window."""
    days = dates_between(F.col("last_month_date"), F.col("current_date"), repeat_start)
    return bookings.withColumn("date", F.explode(days))


def extension_days(extensions: DataFrame, repeat_start: bool = False) -> DataFrame:
    """One row per extension and date it covers."""
    days = dates_between(F.col("local_start_date"), F.col("local_end_date"), repeat_start)
    return extensions.select("id", "order_id", F.explode(days).alias("date"))


def clip_extensions(extensions: DataFrame, period: Period) -> DataFrame:
    """The dates of each extension that lie in the window, as ``clip_first`` and ``clip_last``."""
    return extensions.withColumns(
        {
            "clip_first": F.greatest(F.to_date("local_start_date"), period.first),
            "clip_last": F.least(F.to_date("local_end_date"), period.last),
        }
    )


def extension_day_counts(
    extensions: DataFrame, period: Period, repeat_start: bool = False
) -> DataFrame:
    """Per booking and date of the window the number of extension rows on that date."""
    if repeat_start:
        listed = extension_days(extensions, True).filter(F.col("date").between(period.first, period.last))
    else:
        listed = clip_extensions(extensions, period).select(
            "order_id", F.explode(dates_between(F.col("clip_first"), F.col("clip_last"))).alias("date")
        )
    return listed.groupBy("order_id", "date").agg(F.count(F.lit(1)).alias("extension_rows"))


def days_on_extension(
    days: DataFrame, extensions: DataFrame, period: Period, repeat_start: bool = False
) -> DataFrame:
    """Booking days with ``on_rerent``; a day met by n extension rows counts n ``copies``."""
    counts = extension_day_counts(extensions, period, repeat_start)
    return (
        days.join(counts, ["order_id", "date"], "left")
        .withColumn("on_rerent", F.col("extension_rows").isNotNull())
        .withColumn("copies", F.col("copies") * F.coalesce("extension_rows", F.lit(1)))
        .drop("extension_rows")
    )


def extension_totals(days: DataFrame) -> DataFrame:
    """Per booking the number of its rows on an extension day."""
    return (
        days.filter("on_rerent")
        .groupBy("order_id")
        .agg(F.sum("copies").cast("bigint").alias("rerent_count"))
    )


def below_extension_limit(days: DataFrame, totals: DataFrame) -> DataFrame:
    """Days of bookings with fewer than 15 extension rows."""
    return (
        days.join(totals, "order_id", "left")
        .filter(F.col("rerent_count").isNull() | (F.col("rerent_count") < MAX_EXTENSION_DAYS))
        .drop("rerent_count")
    )


def with_user_and_room(bookings: DataFrame, users: DataFrame, spaces: DataFrame) -> DataFrame:
    """Add the user's name and the room code, null where unknown."""
    names = users.select(F.col("id").alias("user_id"), F.col("display_name").alias("user_name"))
    rooms = spaces.select(F.col("id").alias("space_id"), F.col("code").alias("room"))
    return lookup_join(lookup_join(bookings, names, ["user_id"]), rooms, ["space_id"])


def rooms_only(spaces: DataFrame) -> DataFrame:
    return spaces.filter(F.col("type_c") == ROOM).select(
        F.col("id").alias("space_id"), F.col("type_c").alias("room_type"), F.col("code").alias("room")
    )


def booking_hours(days: DataFrame) -> DataFrame:
    """24 rows per booking day, 13:00 up to 12:00 of the next date."""
    return days.withColumn("date_time_key", F.explode(hours_of_day(F.col("date"))))


def extension_summary(
    extensions: DataFrame, period: Period, repeat_start: bool = False
) -> DataFrame:
    """One row per booking: a bitmap of its extension dates in the window and their row count.

    Normally both come from the two ends of an extension, so no date is generated, and both fold on
    the map side. With ``repeat_start`` the lists are generated; the window's own list then names
    its first date twice as well, so rows on that date count double.
    """

    def low_bits(day: Column, extra: int, word: int) -> Column:
        """Bits of the dates before ``day`` + ``extra`` that fall into a word."""
        n = F.datediff(day, period.first) + extra - word * _BITS
        return _bit(F.least(F.greatest(n, F.lit(0)), F.lit(_BITS))) - F.lit(1)

    if repeat_start:
        rows = extension_days(extensions, True).filter(
            F.col("date").between(period.first, period.last)
        )
        position = F.datediff("date", period.first)
        words = {
            f"days_{w}": F.when(
                position.between(w * _BITS, (w + 1) * _BITS - 1), _bit(position - w * _BITS)
            ).otherwise(F.lit(0).cast("bigint"))
            for w in period.words
        }
        weight = F.when(position == 0, 2).otherwise(1)
    else:
        rows = clip_extensions(extensions, period).filter("clip_first <= clip_last")
        words = {
            f"days_{w}": low_bits(F.col("clip_last"), 1, w).bitwiseXOR(
                low_bits(F.col("clip_first"), 0, w)
            )
            for w in period.words
        }
        weight = F.datediff("clip_last", "clip_first") + 1
    return rows.groupBy("order_id").agg(
        *(F.bit_or(word).alias(name) for name, word in words.items()),
        F.sum(weight.cast("bigint")).alias("day_rows"),
    )


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position)


def only_ids_of(df: DataFrame, bookings: DataFrame, column: str, id_column: str) -> DataFrame:
    """Rows of a large table that the (broadcast) bookings refer to, picked while scanning it."""
    ids = bookings.select(F.col(id_column).alias(column))
    return df.join(F.broadcast(ids), column, "left_semi")


def booked_windows(
    bookings: DataFrame,
    history: DataFrame,
    extensions: DataFrame,
    users: DataFrame,
    spaces: DataFrame,
    period: Period,
    order_id: int | None = None,
    repeat_start: bool = False,
) -> DataFrame:
    """Per kept booking and space one distinct row with names, room and its extension bitmap.

    A booking is dropped when its rows on extension days, over all its history rows, reach 15.
    The current bookings are settled once. When they measure small, the other tables are cut down
    to them by a broadcast semi join, so that none of those is shuffled whole.
    """
    current = settle(current_bookings(bookings, period, order_id))
    extensions = live_extensions(extensions, period)
    if fits_broadcast(current.select("order_id", "user_id")):
        history = only_ids_of(history, current, "order_id", "order_id")
        extensions = only_ids_of(extensions, current, "order_id", "order_id")
        users = only_ids_of(users, current, "id", "user_id")
    base = with_actual_space(current, history)
    # Both sides have few rows per booking: one per different space, and one.
    joined = base.join(extension_summary(extensions, period, repeat_start), "order_id", "left")
    rows_of_booking = F.sum(F.col("copies") * F.coalesce("day_rows", F.lit(0))).over(
        Window.partitionBy("order_id")
    )
    kept = joined.withColumn("rerent_count", rows_of_booking).filter(
        F.col("rerent_count") < MAX_EXTENSION_DAYS
    )
    return (
        with_user_and_room(kept, users, spaces)
        .select(
            "order_id", "order_number", "user_name", "room", "space_id", "status_c",
            "last_month_date", "current_date", *(f"days_{w}" for w in period.words),
        )
        .distinct()
    )


def spread(windows: DataFrame) -> DataFrame:
    """Booking windows over all shuffle partitions, before their days and hours are generated.

    Windows are few and small, so adaptive execution puts them into one or a few partitions, whose
    tasks would then make every hour. It keeps a number of partitions that is given.
    """
    n = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return windows.repartition(n, "order_id", "space_id")


def on_extension(date: Column, period: Period) -> Column:
    """Whether the bitmap of a booking window has the bit of a date."""
    position = F.datediff(date, period.first)
    word = F.lit(0).cast("bigint")
    for w in reversed(period.words):
        word = F.when(
            position < (w + 1) * _BITS, F.coalesce(F.col(f"days_{w}"), F.lit(0))
        ).otherwise(word)
    bit = F.call_function("shiftright", word, F.pmod(position, F.lit(_BITS)))
    return bit.bitwiseAND(F.lit(1)) == 1


def days_of(windows: DataFrame, period: Period) -> DataFrame:
    """Per booking window and date: ``on_rerent`` in place of the bitmap."""
    return (
        booking_days(windows)
        .withColumn("on_rerent", on_extension(F.col("date"), period))
        .drop("last_month_date", "current_date", *(f"days_{w}" for w in period.words))
    )
