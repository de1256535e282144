"""Segments as objects under their own keys."""

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from stowline.functions.keys import object_key_text
from stowline.operators.segments import assembler, encoded_by_segment, group_keys
from stowline.sources.storage import join_path, put_object, qualify

FORMAT, SINK_FORMAT = "stowline_segments", "stowline_segment_sink"


@dataclass
class Written(WriterCommitMessage):
    objects: int


class SegmentWriter(DataSourceArrowWriter):
    """Puts objects: one per row, or assembled from the encoded records of its partition.

    A key fixes the object's bytes, so a repeated task or batch overwrites with the
    same content and no commit step on the driver is needed.
    """

    def __init__(self, base: str, prefix: str, keys: list[str] | None):
        self.base = base
        self.prefix = prefix
        self.keys = keys

    def write(self, iterator):
        count = 0
        for batch in assembler(self.keys)(iterator) if self.keys else iterator:
            for key, payload in zip(self._names(batch), batch.column("payload")):
                put_object(join_path(self.base, key), payload.as_buffer())
                count += 1
        return Written(count)

    def _names(self, batch):
        if not self.keys:
            return batch.column("object_key").to_pylist()
        parts = ("topic", "partition", "start_offset", "end_offset")
        rows = zip(*(batch.column(c).to_pylist() for c in parts))
        return [object_key_text(self.prefix, *row) for row in rows]


def writer_of(options) -> SegmentWriter:
    keys = options.get("assemble")
    return SegmentWriter(options["path"], options.get("prefix", ""), keys and json.loads(keys))


class SegmentSink(DataSource):
    """Format ``stowline_segment_sink``: writes objects."""

    @classmethod
    def name(cls):
        return SINK_FORMAT

    def writer(self, schema, overwrite):
        return writer_of(self.options)


def _writer(df: DataFrame, path: str):
    spark = df.sparkSession
    spark.dataSource.register(SegmentSink)
    return df.write.format(SINK_FORMAT).mode("append").option("path", qualify(spark, path))


def write_segments(segments: DataFrame, path: str) -> None:
    """Put each segment at ``path`` under its object key, replacing an object of that key."""
    _writer(segments.select("object_key", "payload"), path).save()


def write_assigned(
    assigned: DataFrame, path: str, prefix: str = "", epoch_col: str | None = None
) -> None:
    """Assemble and put the segments of assigned records in one step.

    The same objects as ``write_segments(assemble_segments(...))``, without passing
    the payload through Spark once more.
    """
    keys = json.dumps(group_keys(epoch_col))
    rows = encoded_by_segment(assigned, epoch_col)
    _writer(rows, path).option("prefix", prefix).option("assemble", keys).save()
