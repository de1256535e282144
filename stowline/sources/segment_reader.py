"""The archive as a batch source: ``spark.read.format("stowline_segments")`` with pushed filters."""

import re
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import DataFrameReader, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from stowline.functions.codec import HEADERS_TYPE
from stowline.functions.keys import OBJECT_KEY_PATTERN
from stowline.operators.records import RECORD_COLUMNS
from stowline.sinks.segments import FORMAT, SegmentWriter, writer_of
from stowline.sources.segments import SegmentError, decoded_batches, joined_batches, read_object
from stowline.sources.storage import join_path, locate, qualify

#: Bytes of objects that one task reads, at least one object.
SPLIT_BYTES = 64 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
_SCHEMA = (
    "topic string, partition int, offset long, timestamp timestamp, key binary, value binary, "
    f"headers {HEADERS_TYPE}"
)


@dataclass
class Wanted:
    """What the filters leave: closed bounds of offset and partition, and the values named."""

    low: dict = field(default_factory=dict)
    high: dict = field(default_factory=dict)
    values: dict = field(default_factory=dict)

    def take(self, filter) -> None:
        """Narrow by one filter; others are passed over, as Spark looks at every row again."""
        name = filter.attribute[0] if len(getattr(filter, "attribute", ())) == 1 else None
        if name not in ("topic", "partition", "offset"):
            return
        if isinstance(filter, (EqualTo, EqualNullSafe, In)):
            values = set(filter.value if isinstance(filter, In) else [filter.value])
            self.values[name] = values & self.values.get(name, values)
        elif name == "topic" or getattr(filter, "value", None) is None:
            return
        elif isinstance(filter, (GreaterThan, GreaterThanOrEqual)):
            least = filter.value + isinstance(filter, GreaterThan)
            self.low[name] = max(least, self.low.get(name, least))
        elif isinstance(filter, (LessThan, LessThanOrEqual)):
            most = filter.value - isinstance(filter, LessThan)
            self.high[name] = min(most, self.high.get(name, most))

    def holds(self, name: str, first, last) -> bool:
        """Whether a value from ``first`` to ``last`` can pass."""
        if name in self.values:
            return any(v is not None and first <= v <= last for v in self.values[name])
        return max(first, self.low.get(name, first)) <= min(last, self.high.get(name, last))


@dataclass
class Objects(InputPartition):
    """Objects that one task reads."""

    paths: list


class SegmentReader(DataSourceReader):
    """Opens only objects whose key can hold wanted records.

    A topic filter leaves the folders of other topics unlisted, offset and partition filters
    leave objects outside unopened. Objects are dealt in order of their keys, until a task
    has ``splitbytes`` of them.
    """

    def __init__(self, options):
        self.path = options["path"]
        self.prefix = options.get("prefix", "").strip("/")
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.wanted = Wanted()

    def pushFilters(self, filters):
        for filter in filters:
            self.wanted.take(filter)
        return filters

    def _folders(self, system, root: str) -> list[str]:
        if "topic" in self.wanted.values:
            named = [f"{root}/{t}" for t in sorted(v for v in self.wanted.values["topic"] if v)]
            return [i.path for i in system.get_file_info(named) if i.type == fs.FileType.Directory] if named else []
        return [root]

    def _objects(self):
        """(key, bytes) of the wanted objects, in order."""
        uri = join_path(self.path, self.prefix) if self.prefix else self.path
        system, root = locate(uri)
        root = root.rstrip("/")
        start = uri[: uri.rindex(root)]
        pattern = re.compile(OBJECT_KEY_PATTERN)
        for folder in self._folders(system, root):
            for info in system.get_file_info(fs.FileSelector(folder, recursive=True)):
                match = pattern.match(info.path) if info.type == fs.FileType.File else None
                if match is None or re.search(r"/[_.]", info.path[len(root) :]):
                    continue
                topic, partition = match[1], int(match[2])
                ranges = (("topic", topic, topic), ("partition", partition, partition), ("offset", int(match[3]), int(match[4])))
                if all(self.wanted.holds(*r) for r in ranges):
                    yield start + info.path, info.size

    def partitions(self):
        tasks, filled = [[]], 0
        for path, size in sorted(self._objects()):
            if tasks[-1] and filled + size > self.split:
                tasks.append([])
                filled = 0
            tasks[-1].append(path)
            filled += size
        return [Objects(paths) for paths in tasks]

    def read(self, partition):
        def records():
            for path in partition.paths:
                match = re.match(OBJECT_KEY_PATTERN, path)
                try:
                    yield from decoded_batches((path, match[1], int(match[2])), read_object(path))
                except SegmentError as error:
                    raise SegmentError(f"{path}: {error}") from error

        for batch in joined_batches(records()):
            yield batch.select(RECORD_COLUMNS)


class SegmentObjects(DataSource):
    """Format ``stowline_segments``: records when read, objects when written."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return _SCHEMA

    def reader(self, schema):
        return SegmentReader(self.options)

    def writer(self, schema, overwrite) -> SegmentWriter:
        return writer_of(self.options)


def read_segments(spark: SparkSession, path: str, prefix: str = "") -> DataFrameReader:
    """A reader of the archive under ``path``; ``load()`` gives its records.

    Conditions on ``topic``, ``partition`` and ``offset`` of the loaded rows reach the
    source, which then opens only objects that overlap them. This needs, and turns on, the
    session's ``spark.sql.python.filterPushdown.enabled``. The objects that remain are
    listed where the query is planned; ``scan_segments`` lists in tasks.
    """
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(SegmentObjects)
    return spark.read.format(FORMAT).option("path", qualify(spark, path)).option("prefix", prefix)
