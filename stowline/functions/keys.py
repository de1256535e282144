"""Object keys: ``{prefix}{topic}/{partition}/{start}-{end}``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layout of an object key and the characters a prefix may use.
OBJECT_KEY_PATTERN = r"^.*?([^/]+)/([0-9]+)/([0-9]+)-([0-9]+)$"
PREFIX_PATTERN = r"\A[-a-zA-Z0-9_./]*\z"
OFFSET_FORMAT = "%019d"


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def _trimmed(value: Column) -> Column:
    # every control character and the space, at both ends
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")


def normalize_prefix(prefix) -> Column:
    """Blank or null becomes empty; anything else is trimmed and ends in one added ``/``."""
    trimmed = _trimmed(_col(prefix))
    return F.when((trimmed == "") | trimmed.endswith("/"), trimmed).otherwise(
        F.concat(trimmed, F.lit("/"))
    )


def valid_prefix(prefix) -> Column:
    """True when the prefix holds only letters, digits and ``_ - . /``."""
    return _col(prefix).rlike(PREFIX_PATTERN)


def sortable_long(value) -> Column:
    """19 digits, zero-padded, so that text order is numeric order."""
    return F.format_string(OFFSET_FORMAT, _col(value).cast("long"))


def object_key(prefix, topic, partition, start_offset, end_offset) -> Column:
    return F.concat(
        normalize_prefix(prefix),
        _col(topic),
        F.lit("/"),
        _col(partition).cast("string"),
        F.lit("/"),
        sortable_long(start_offset),
        F.lit("-"),
        sortable_long(end_offset),
    )


def object_key_text(prefix: str, topic: str, partition: int, start: int, end: int) -> str:
    """The same key for one object, inside a task."""
    prefix = prefix.strip("".join(map(chr, range(33))))
    if prefix and not prefix.endswith("/"):
        prefix += "/"
    return f"{prefix}{topic}/{partition}/{OFFSET_FORMAT % start}-{OFFSET_FORMAT % end}"


def parse_object_key(key) -> Column:
    """Struct of topic, partition, start_offset, end_offset; all null when the key does not fit."""
    key = _col(key)

    def part(i: int, to: str) -> Column:
        return F.when(
            key.rlike(OBJECT_KEY_PATTERN), F.regexp_extract(key, OBJECT_KEY_PATTERN, i).try_cast(to)
        )

    return F.struct(
        part(1, "string").alias("topic"),
        part(2, "int").alias("partition"),
        part(3, "long").alias("start_offset"),
        part(4, "long").alias("end_offset"),
    )


def target_topic(topic_prefix, topic) -> Column:
    """``prefix-topic``, or the topic alone under a blank prefix."""
    topic_prefix, topic = _col(topic_prefix), _col(topic)
    return F.when(_trimmed(topic_prefix) == "", topic).otherwise(
        F.concat(topic_prefix, F.lit("-"), topic)
    )
