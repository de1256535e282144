"""Parquet files whose columns grow in number, as a stream."""

import json
from collections.abc import Callable
from dataclasses import asdict

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stowline.sources.footers import Field, from_json, read_message
from stowline.sources.parquet import fold, one_of_each, read_footers, scan_parquet_physical
from stowline.sources.storage import join_path, locate, put_object, qualify
from stowline.streaming.discovery import DISCOVERY_TRIGGER, discover_new_files


class SchemaLog:
    """Versions of a schema in a folder: version n is the columns of the first n kinds of files."""

    def __init__(self, folder: str):
        self.folder = folder

    def versions(self) -> list[dict]:
        """Per version its kind, the file that brought it and that file's schema tree."""
        system, inner = locate(self.folder)
        found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
        names = sorted(i.path for i in found if i.base_name.startswith("version-"))
        rows = []
        for name in names:
            with system.open_input_stream(name) as stream:
                rows.append(json.loads(stream.read()))
        return rows

    def widen(self, spark: SparkSession, paths: list[str]) -> Field:
        """The schema with the columns of some more files, kept as further versions.

        A column of another type than before fails with the names of both files, and nothing
        is kept. The same files again add nothing, so a batch may run twice.
        """
        kept = self.versions()
        known = {row["kind"] for row in kept}
        new = [(kind, file) for kind, file in one_of_each(read_footers(spark, paths)) if kind not in known]
        rows = kept + [{"kind": k, "file": f, "tree": asdict(read_message(spark, f))} for k, f in new]
        whole = fold([(row["file"], from_json(row["tree"])) for row in rows])
        for number, row in list(enumerate(rows, 1))[len(kept) :]:
            put_object(join_path(self.folder, f"version-{number:09d}.json"), json.dumps(row).encode())
        return whole


def widening_parquet(
    spark: SparkSession,
    directory: str,
    flush: Callable[[DataFrame, int], None],
    log: str,
    checkpoint: str,
    max_files_per_trigger: int = 1000,
    recursive: bool = True,
    with_file: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hand the rows of new Parquet files to ``flush``, with all columns known by then.

    Every micro-batch takes at most ``max_files_per_trigger`` new files, reads their footers
    and widens the schema in the folder ``log`` of this query. So a column that first appears
    in a later file arrives with that file; rows of earlier batches were handed over without
    it. A column that changes its type stops the query before the batch is handed over.
    Otherwise as ``stream_parquet``.
    """
    kept = SchemaLog(qualify(spark, log).rstrip("/"))

    def take(batch: DataFrame, epoch: int) -> None:
        paths = sorted(r.path for r in batch.where("length > 0").select("path").collect())
        if paths:
            tree = kept.widen(batch.sparkSession, paths)
            flush(scan_parquet_physical(batch.sparkSession, paths, with_file, schema=tree), epoch)

    files = discover_new_files(spark, directory, max_files_per_trigger, recursive)
    writer = files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or DISCOVERY_TRIGGER)).start()
