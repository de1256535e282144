"""Column expressions of the Parquet physical view."""

from pyspark.sql import Column
from pyspark.sql import functions as F

JULIAN_DAY_OF_EPOCH = 2440588
MICROS_PER_DAY = 86_400_000_000


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def physical_list(value, element=None, group="list", item="element") -> Column:
    """Array to ``struct<list: array<struct<element>>>``; null stays null, empty stays empty."""
    value = _col(value)
    element = element or (lambda x: x)
    return F.when(
        value.isNotNull(),
        F.struct(F.transform(value, lambda x: F.struct(element(x).alias(item))).alias(group)),
    )


def physical_map(
    value, key=None, item=None, group="key_value", key_name="key", value_name="value"
) -> Column:
    """Map to ``struct<key_value: array<struct<key, value>>>``."""
    value = _col(value)
    key, item = key or (lambda x: x), item or (lambda x: x)
    return F.when(
        value.isNotNull(),
        F.struct(
            F.transform(
                F.map_entries(value),
                lambda e: F.struct(
                    key(e["key"]).alias(key_name), item(e["value"]).alias(value_name)
                ),
            ).alias(group)
        ),
    )


def _little_endian(hex_text: Column) -> Column:
    pairs = F.regexp_extract_all(hex_text, F.lit("(..)"), F.lit(1))
    return F.unhex(F.array_join(F.reverse(pairs), ""))


def int96_bytes(value) -> Column:
    """The 12 stored bytes of an INT96 value that Spark has read as a timestamp.

    Eight bytes of nanoseconds in the day and four of the Julian day, both little
    endian. Spark keeps microseconds, so finer digits are lost.
    """
    micros = F.unix_micros(_col(value))
    in_day = F.pmod(micros, F.lit(MICROS_PER_DAY))
    day = F.lit(JULIAN_DAY_OF_EPOCH) + F.round((micros - in_day) / F.lit(MICROS_PER_DAY))
    return F.concat(
        _little_endian(F.lpad(F.hex(in_day * F.lit(1000)), 16, "0")),
        _little_endian(F.lpad(F.hex(day.cast("int")), 8, "0")),
    )
