"""Number, key, JSON and map expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline.schemas import TRIPLE


def device_key(*columns: str) -> Column:
    """The device triple as ``a-b-c``."""
    return F.concat_ws("-", *(F.col(c).cast("string") for c in (columns or TRIPLE)))


def split_device_key(key: Column) -> list[Column]:
    """The three numbers of an ``a-b-c`` key."""
    parts = F.split(key, "-")
    return [parts[i].cast("bigint").alias(name) for i, name in enumerate(TRIPLE)]


def as_int(text: Column) -> Column:
    """The integer a text spells, else null. No blanks and no decimal point."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def as_double(text: Column) -> Column:
    return text.try_cast("double")


def is_int(text: Column) -> Column:
    return F.coalesce(as_int(text).isNotNull(), F.lit(False))


def is_double(text: Column) -> Column:
    return as_double(text).isNotNull()


def smaller(left: Column, right: Column) -> Column:
    return F.least(left, right)


def exact(value: Column) -> Column:
    """A double as a decimal, so that sums and differences carry no binary noise."""
    return value.cast("decimal(38,9)")


def exact_sum(value: Column) -> Column:
    return F.sum(exact(value)).cast("double")


def exact_difference(later: Column, earlier: Column) -> Column:
    return (exact(later) - exact(earlier)).cast("double")


def merge_counts(left: Column, right: Column) -> Column:
    """Two maps with the values of equal keys added."""
    return F.map_zip_with(
        left, right, lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))
    )


def has_dash(text: Column) -> Column:
    return text.contains("-")
