"""Parquet files by their physical types: annotations other than text are ignored."""

import logging
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stowline.functions.physical import int96_bytes, physical_list, physical_map
from stowline.scratch import new_folder
from stowline.sources.footers import Field, merged, open_footer, read_kind, read_message
from stowline.sources.listing import list_files, plain_uri
from stowline.sources.storage import check_on_error, is_file, qualify

# The Spark type each stored type is read as.
SPARK_TYPES = {
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "int96": T.TimestampType(),
    "fixed_len_byte_array": T.BinaryType(),
}

# Spark's file streams pass over files older than this behind the newest; none is that old
OLDEST_FILE = "36500d"

log = logging.getLogger(__name__)

# so many named files are looked at by the driver, more of them and folders by tasks
FEW_FILES = 16

# above this many files, row counts are joined by a shuffle instead of a broadcast
BROADCAST_FILES = 50_000


@dataclass
class View:
    """How Spark reads a field, and how the result is reshaped; None keeps it as it is."""

    type: T.DataType
    reshape: Callable[[Column], Column] | None = None

    def apply(self, column: Column) -> Column:
        return self.reshape(column) if self.reshape else column


def _view(node: Field) -> View:
    """View of a field, as an array if it is repeated."""
    one = _single(node)
    if not node.repeated:
        return one
    reshape = one.reshape and (lambda c: F.transform(c, one.reshape))
    return View(T.ArrayType(one.type), reshape)


def _signed(value: Column, bits: int, to: str) -> Column:
    """Stored signed number of an unsigned column.

    Spark refuses to read dictionary pages of these columns by their stored type.
    """
    full = F.lit(str(2**bits)).cast("decimal(21,0)")
    value = value.cast("decimal(20,0)")
    return F.when(value * 2 >= full, value - full).otherwise(value).cast(to)


def _single(node: Field) -> View:
    if node.physical == "int96":
        return View(T.TimestampType(), int96_bytes)
    if node.logical == "Int(bitWidth=32, isSigned=false)":
        return View(T.LongType(), lambda c: _signed(c, 32, "int"))
    if node.logical == "Int(bitWidth=64, isSigned=false)":
        return View(T.DecimalType(20, 0), lambda c: _signed(c, 64, "long"))
    if node.physical:
        text = node.physical == "binary" and node.annotation == "String"
        return View(T.StringType() if text else SPARK_TYPES[node.physical])
    child = node.children[0] if len(node.children) == 1 else None
    if child is not None and child.repeated:
        if node.annotation == "List":
            return _list(node, child)
        if node.annotation == "Map" and len(child.children) == 2:
            return _map(child)
    return _struct(node)


def _struct(node: Field) -> View:
    views = [(c.name, _view(c)) for c in node.children]
    shape = T.StructType([T.StructField(n, v.type) for n, v in views])
    if not any(v.reshape for _, v in views):
        return View(shape)
    return View(
        shape,
        lambda c: F.when(
            c.isNotNull(), F.struct(*[v.apply(c.getField(n)).alias(n) for n, v in views])
        ),
    )


def _list(node: Field, repeated: Field) -> View:
    wrapped = (
        repeated.physical is None
        and len(repeated.children) == 1
        and repeated.name not in ("array", f"{node.name}_tuple")
    )
    if wrapped:
        item = repeated.children[0]
        element = _view(item)
        return View(
            T.ArrayType(element.type),
            lambda c: physical_list(c, element.apply, repeated.name, item.name),
        )
    # older layout: the repeated field is the element itself
    element = _view(repeated)
    return View(
        element.type,
        lambda c: F.when(c.isNotNull(), F.struct(element.apply(c).alias(repeated.name))),
    )


def _map(entry: Field) -> View:
    (key_field, value_field) = entry.children
    key, value = _view(key_field), _view(value_field)
    return View(
        T.MapType(key.type, value.type),
        lambda c: physical_map(
            c, key.apply, value.apply, entry.name, key_field.name, value_field.name
        ),
    )


def _kinds(on_error: str):
    """Arrow function from paths to what their footers tell: ``kind`` of schema and ``rows``."""

    def read(batches):
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                try:
                    found.append((path, *read_kind(path)))
                except (OSError, ValueError):
                    if on_error == "fail":
                        raise
                    log.exception("skipped %s", path)
            yield pa.RecordBatch.from_pylist([dict(zip(_FOOTERS.names, f)) for f in found], _FOOTERS)

    return read


_FOOTERS = pa.schema([("path", pa.string()), ("kind", pa.string()), ("rows", pa.int64())])
_FOOTER_COLUMNS = "path string, kind string, rows long"


def _named(spark: SparkSession, path: str | list[str]) -> list[str] | None:
    """URIs if a few files are named, whose footers the driver can read itself."""
    paths = [plain_uri(qualify(spark, p)) for p in (path if isinstance(path, list) else [path])]
    return paths if len(paths) <= FEW_FILES and all(is_file(p) for p in paths) else None


def read_footers(
    spark: SparkSession, path: str | list[str], recursive: bool = True, on_error: str = "fail"
) -> DataFrame:
    """A row per file that is not empty: ``path``, ``kind`` of its schema and ``rows``."""
    read = _kinds(check_on_error(on_error))
    named = _named(spark, path)
    if named is not None:
        (batch,) = read([pa.RecordBatch.from_arrays([pa.array(named, pa.string())], ["path"])])
        return spark.createDataFrame([tuple(r.values()) for r in batch.to_pylist()], _FOOTER_COLUMNS)
    files = list_files(spark, path, recursive).where(F.col("length") > 0).select("path")
    return _spread(files).mapInArrow(read, _FOOTER_COLUMNS)


def one_of_each(footers: DataFrame) -> list[tuple[str, str]]:
    """(kind, path) of one file of every kind of schema, by path."""
    found = footers.groupBy("kind").agg(F.min("path").alias("path")).orderBy("path")
    return [(r.kind, r.path) for r in found.collect()]


def fold(trees: list[tuple[str, Field]]) -> Field:
    """One schema that holds the columns of all; ``trees`` are files with theirs."""
    first, whole = trees[0]
    for number, (file, tree) in enumerate(trees[1:], 1):
        tree.name = whole.name
        # name the first of the files that this one contradicts
        for before, known in trees[:number]:
            merged(known, tree, (before, file))
        whole = merged(whole, tree, (first, file))
    return whole


def physical_tree(
    spark: SparkSession, path: str | list[str], recursive: bool = True, on_error: str = "fail"
) -> Field:
    """One schema for all files: tasks read footers, the driver one file of each kind."""
    return _tree_of(spark, read_footers(spark, path, recursive, on_error), path)


def _tree_of(spark: SparkSession, footers: DataFrame, path) -> Field:
    kinds = one_of_each(footers)
    if not kinds:
        raise ValueError(f"no file under {path}")
    return fold([(file, read_message(spark, file)) for _, file in kinds])


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def physical_schema(spark: SparkSession, path: str | list[str]) -> T.StructType:
    """Schema to read the files with, holding the columns of all of them."""
    return _struct(physical_tree(spark, path)).type


def _physical(rows: DataFrame, message: Field, *extra: Column) -> DataFrame:
    return rows.select(
        *[_view(c).apply(_quoted(c.name)).alias(c.name) for c in message.children], *extra
    )


def _skipping(reader, on_error: str):
    """Let a reader pass over files that are corrupt or gone."""
    skip = check_on_error(on_error) == "skip"
    return reader.option("ignoreCorruptFiles", skip).option("ignoreMissingFiles", skip)


def scan_parquet_physical(
    spark: SparkSession,
    path: str | list[str],
    with_file: bool = False,
    on_error: str = "fail",
    recursive: bool = True,
    schema: Field | None = None,
) -> DataFrame:
    """Rows by physical type; lists and maps keep their groups, INT96 its 12 bytes.

    The schema holds the columns of all files, null where a file lacks one; files whose
    columns differ in type fail. Folders are read to all levels unless ``recursive`` is off.
    ``with_file`` adds ``filename`` and ``row_index``. ``on_error="skip"`` passes over
    files that are corrupt or gone. INT96 needs the UTC session time
    zone and ``spark.sql.parquet.int96RebaseModeInRead=CORRECTED``. Where ``schema`` is given,
    a ``physical_tree``, no footers are read before the scan.
    """
    message = physical_tree(spark, path, recursive, on_error) if schema is None else schema
    reader = spark.read.option("recursiveFileLookup", recursive).schema(_struct(message).type)
    rows = _skipping(reader, on_error).parquet(*(path if isinstance(path, list) else [path]))
    return _physical(rows, message, *(_file_columns() if with_file else []))


def _file_columns() -> list[Column]:
    # the scan names its file by an encoded URI, the file inventory by a plain one
    path = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return [
        F.regexp_replace(F.url_decode(path), "^file:/+", "file:/").alias("filename"),
        F.col("_metadata.row_index").alias("row_index"),
    ]


def stream_parquet(
    spark: SparkSession,
    directory: str,
    max_files_per_trigger: int | None = None,
    with_file: bool = False,
    on_error: str = "fail",
    recursive: bool = True,
    with_progress: bool = False,
) -> DataFrame:
    """Stream of the rows of Parquet files as they appear; the schema is that of all present files.

    Columns that first appear in later files are left out; ``widening_parquet`` takes them.
    A file is taken once, whatever its age. ``with_progress`` adds ``filename`` and
    ``progress``, exactly 1.0 on a file's last row; tasks take the row counts from the footers.
    """
    message = physical_tree(spark, directory, recursive, on_error)
    reader = _skipping(spark.readStream.schema(_struct(message).type), on_error)
    reader = reader.option("recursiveFileLookup", recursive).option("maxFileAge", OLDEST_FILE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(directory)
    if with_progress:
        return _with_progress(_physical(rows, message, *_file_columns()), keep_index=with_file)
    return _physical(rows, message, *(_file_columns() if with_file else []))


def _with_progress(rows: DataFrame, keep_index: bool) -> DataFrame:
    """Rows with ``progress``, from ``row_index`` and the row counts in the footers."""

    def add(batches):
        counts = {}
        for batch in batches:
            for name in set(batch.column("filename").unique().to_pylist()) - counts.keys():
                with open_footer(name) as file:
                    counts[name] = file.metadata.num_rows
            files = batch.column("filename").dictionary_encode()
            whole = np.array([counts[n] for n in files.dictionary.to_pylist()], np.float64)
            index = batch.column("row_index").to_numpy() + 1
            progress = pa.array(index / whole[files.indices.to_numpy()] if len(index) else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, progress], [*batch.schema.names, "progress"])

    shape = T.StructType([*rows.schema.fields, T.StructField("progress", T.DoubleType())])
    found = rows.mapInArrow(add, shape)
    return found if keep_index else found.drop("row_index")


_INVENTORY = (
    "path string, column_path string, depth int, repetition string, optional boolean, "
    "physical_type string, logical_type string, target_type string"
)


def _described(kind: str, tree: Field) -> list[tuple]:
    return [
        (kind, ".".join(p), len(p), f.repetition, f.repetition != "required", f.physical, f.logical, f.target)
        for p, f in tree.walk()
    ]


def _spread(files: DataFrame) -> DataFrame:
    # a footer is small work whatever the file's size, so go by file count
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism * 4, "path")


def schema_inventory(
    spark: SparkSession, path: str | list[str], recursive: bool = True
) -> DataFrame:
    """One row per file and schema field, with its stored types, repetition and shown type.

    Tasks read the footers; the driver looks at one file of each kind of schema.
    """
    footers = read_footers(spark, path, recursive)
    fields = [row for kind, file in one_of_each(footers) for row in _described(kind, read_message(spark, file))]
    known = spark.createDataFrame(fields, _INVENTORY.replace("path string", "kind string", 1))
    return footers.join(known, "kind").select("path", *[c for c in known.columns if c != "kind"])


def row_counts(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """Rows of each file, from its footer: ``path``, ``rows``."""
    return read_footers(spark, path, recursive).select("path", "rows")


def parquet_progress(
    spark: SparkSession, path: str | list[str], broadcast_files: int = BROADCAST_FILES
) -> DataFrame:
    """Physical rows with ``filename`` and ``progress``, exactly 1.0 on a file's last row.

    The files are listed and their footers read once, for schema and row counts. The counts
    are broadcast while there are at most ``broadcast_files`` files; beyond that rows and
    counts meet by a shuffle on the file.
    """
    footers = read_footers(spark, path)
    if _named(spark, path) is None:
        table = new_folder(spark, "footers")
        footers.write.parquet(table)
        footers = spark.read.parquet(table)
    rows = scan_parquet_physical(spark, path, with_file=True, schema=_tree_of(spark, footers, path))
    counts = footers.select(F.col("path").alias("filename"), "rows")
    if counts.count() <= broadcast_files:
        counts = F.broadcast(counts)
    unknown = F.raise_error(F.concat(F.lit("no row count for "), "filename")).cast("long")
    return (
        rows.join(counts, "filename", "left")
        .withColumn("progress", (F.col("row_index") + 1) / F.coalesce("rows", unknown))
        .drop("rows")
    )
