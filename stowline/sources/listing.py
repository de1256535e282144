"""File inventory, listed by tasks."""

import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stowline.sources.storage import locate, qualify


SCHEMA = "path string, length long, modificationTime timestamp"
_FOUND = f"{SCHEMA}, folder boolean"


def list_files(
    spark: SparkSession,
    path: str | list[str],
    recursive: bool = False,
    ignore_missing: bool = False,
    levels: int = 1,
) -> DataFrame:
    """Regular files under a path: ``path``, ``length``, ``modificationTime``; no content is read.

    One level deep, or all levels with ``recursive``, which patterns like ``a/*/b``
    need. Names starting with ``_`` or ``.`` are hidden, as in every Spark file source,
    unless a list names them.
    With ``ignore_missing`` names of a list that are not there, and files that vanish
    before they are looked at, are left out.

    Folders are listed by tasks and never gathered on the driver: those of each of the first
    ``levels`` below the path are dealt out to all tasks, which then list what lies below. A
    folder's own files are listed by one task. Only patterns are resolved by Spark's own file
    index.
    """
    paths = path if isinstance(path, list) else [path]
    if any(re.search(r"[*?\[{]", p) for p in paths):
        return _matching(spark, path, recursive, ignore_missing)
    roots = [plain_uri(qualify(spark, p)) for p in paths]
    if not ignore_missing and len(roots) == 1:
        info = _look(roots[0], False)  # a wrong name is told at once
        if info.type == fs.FileType.File:
            (row,) = _table([(roots[0], info)]).select(["path", "length", "modificationTime"]).to_pylist()
            return spark.createDataFrame([tuple(row.values())], SCHEMA)
    found = spark.createDataFrame([(r,) for r in roots], "path string")
    found = found.mapInArrow(_lister("here", ignore_missing), _FOUND)
    spread = spark.sparkContext.defaultParallelism
    for level in range(levels if recursive else 0):
        last = level == levels - 1
        found = found.repartition(spread, "path").mapInArrow(_lister("below" if last else "next", ignore_missing), _FOUND)
    return found.where("not folder").drop("folder")


def plain_uri(uri: str) -> str:
    uri = re.sub("^file:/+", "file:/", uri)
    return uri.rstrip("/") if uri.count("/") > 1 else uri


def _look(uri: str, ignore_missing: bool):
    system, inner = locate(uri)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        if ignore_missing:
            return None
        raise FileNotFoundError(uri)
    return info


def _children(uri: str, recursive: bool, ignore_missing: bool):
    """(URI, info) of what lies in a folder and is not hidden."""
    system, inner = locate(uri)
    base = inner.rstrip("/")
    start = uri[: uri.rindex(base)] if base else uri.rstrip("/")
    for info in system.get_file_info(fs.FileSelector(inner, ignore_missing, recursive)):
        if not re.search(r"/[_.]", info.path[len(base) :]):
            yield start + info.path, info


def _table(found) -> pa.RecordBatch:
    made = []
    for item in found:
        if not isinstance(item, dict):
            path, info = item
            folder = info.type == fs.FileType.Directory
            # whole milliseconds, as in Spark's own inventory
            micros = (info.mtime_ns or 0) // 1_000_000 * 1000
            item = {"path": path, "length": info.size or 0, "modificationTime": micros, "folder": folder}
        made.append(item)
    return pa.RecordBatch.from_pylist(made, _ARROW)


def _lister(what: str, ignore_missing: bool):
    """Arrow function that replaces folders by what they hold.

    ``here`` takes names of files and folders, ``next`` folders that were found, for one
    level each, and ``below`` those for all levels.
    """

    def rows(batch):
        known = batch.to_pylist()
        for row in known:
            if what == "here":
                info = _look(row["path"], ignore_missing)
                if info is None:
                    continue
                if info.type != fs.FileType.Directory:
                    yield row["path"], info
                    continue
            elif not row["folder"]:
                yield row
                continue
            yield from _children(row["path"], what == "below", ignore_missing)

    def listed(batches):
        held = []
        for batch in batches:
            for item in rows(batch):
                held.append(item)
                if len(held) >= 10_000:
                    yield _table(held)
                    held = []
        if held:
            yield _table(held)

    return listed


_ARROW = pa.schema(
    [("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC")), ("folder", pa.bool_())]
)


def _matching(spark: SparkSession, path, recursive: bool, ignore_missing: bool) -> DataFrame:
    """The same for patterns of names."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("ignoreMissingFiles", ignore_missing)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    if not recursive:
        found = found.where(one_level(spark, path if isinstance(path, list) else [path]))
    return regular_files(found)


def one_level(spark: SparkSession, paths: list[str]) -> Column:
    """True for the given files and the files right in the given directories."""
    roots = [re.sub("^file:/+", "file:/", qualify(spark, p)).rstrip("/") for p in paths]
    parent = F.regexp_replace("path", "/[^/]*$", "")
    return F.col("path").isin(roots) | parent.isin(roots)


def regular_files(files: DataFrame) -> DataFrame:
    """Drop directory markers, whose key ends in ``/``."""
    return files.where(~F.col("path").endswith("/"))
