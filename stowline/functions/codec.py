"""Record size and the big-endian record layout, as column expressions.

Layout of one record: offset (8 bytes), timestamp in ms (8), key length (4),
value length (4), header count (4), key, value, then per header its key length
(4), key, value length (4), value. A null key or value has length -1.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the record layout.
RECORD_OVERHEAD = 28
HEADER_OVERHEAD = 8
SEGMENT_VERSION = 0
SEGMENT_OVERHEAD = 4
SEGMENT_CAPACITY = 5 * 1024 * 1024

HEADERS_TYPE = "array<struct<key:string,value:binary>>"


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def _length(value: Column) -> Column:
    return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")


def record_size(key="key", value="value", headers="headers") -> Column:
    """Encoded bytes of one record; null key, value, headers count as empty."""
    in_headers = F.aggregate(
        _col(headers),
        F.lit(0).cast("long"),
        lambda total, h: total
        + F.lit(HEADER_OVERHEAD)
        + _length(h["key"])
        + _length(h["value"]),
    )
    return (
        F.lit(RECORD_OVERHEAD).cast("long")
        + _length(_col(key))
        + _length(_col(value))
        + F.coalesce(in_headers, F.lit(0).cast("long"))
    )


def _long_hex(value: Column) -> Column:
    return F.lpad(F.hex(value.cast("long")), 16, "0")


def _int_hex(value: Column) -> Column:
    # hex() of a negative int has 16 digits; the low 8 are its 4-byte form
    return F.right(F.lpad(F.hex(value), 8, "0"), F.lit(8))


def _length_hex(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("FFFFFFFF")).otherwise(_int_hex(F.octet_length(value)))


def _header_hex(header: Column) -> Column:
    return F.concat(
        _int_hex(F.octet_length(header["key"])),
        F.hex(F.encode(header["key"], "UTF-8")),
        _length_hex(header["value"]),
        F.coalesce(F.hex(header["value"]), F.lit("")),
    )


def encode_record(
    offset="offset", timestamp="timestamp", key="key", value="value", headers="headers"
) -> Column:
    """One record as bytes. A null timestamp is an error, as it has no encoding."""
    timestamp, key, value, headers = _col(timestamp), _col(key), _col(value), _col(headers)
    millis = F.coalesce(
        F.unix_millis(timestamp), F.raise_error(F.lit("record has no timestamp")).cast("long")
    )
    count = F.coalesce(F.size(F.coalesce(headers, F.array().cast(HEADERS_TYPE))), F.lit(0))
    fixed = F.concat(
        _long_hex(_col(offset)), _long_hex(millis), _length_hex(key), _length_hex(value),
        _int_hex(count),
    )
    header_hex = F.coalesce(F.array_join(F.transform(headers, _header_hex), ""), F.lit(""))
    empty = F.lit(b"")
    return F.concat(
        F.unhex(fixed), F.coalesce(key, empty), F.coalesce(value, empty), F.unhex(header_hex)
    )


def encode_headers(df: DataFrame, *names: str) -> Column:
    """Header array from the named columns of ``df``, in that order.

    Text is kept, binary becomes base64, nested values JSON, other types their
    text form; null stays null.
    """

    def as_text(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.BinaryType):
            return F.base64(column)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(column)
        return column.cast("string")

    return F.array(
        *[
            F.struct(
                F.lit(name).alias("key"),
                F.encode(as_text(df.schema[name]), "UTF-8").alias("value"),
            )
            for name in names
        ]
    ).cast(HEADERS_TYPE)
