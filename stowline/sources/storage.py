"""Opening single files and objects from inside a task, through Arrow's file systems."""

import os
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

_systems = {}


def _file_system(root: str):
    if root not in _systems:
        _systems[root] = fs.FileSystem.from_uri(root)
    return _systems[root]


def qualify(spark: SparkSession, path: str) -> str:
    """The path as a full URI, on the cluster's default file system if it names none."""
    scheme, colon, _ = path.partition(":")
    if colon and "/" not in scheme:
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if default.startswith("file:"):
        return "file:" + os.path.abspath(path)
    if not path.startswith("/"):
        home = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem
        path = home.get(spark.sparkContext._jsc.hadoopConfiguration()).getHomeDirectory().toUri().getPath() + "/" + path
    return default.rstrip("/") + path


def is_file(uri: str) -> bool:
    system, path = locate(uri)
    return system.get_file_info(path).type == fs.FileType.File


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI as Spark prints it (``file:/a b``, ``s3a://bucket/key``)."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, path = rest.removeprefix("//").partition("/")
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    system, base = _file_system(f"{scheme}://{authority}")
    return system, f"{base.rstrip('/')}/{path}"


def join_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def put_object(uri: str, payload) -> None:
    """Put a whole object; readers never see half of it."""
    system, path = locate(uri)
    if system.type_name in ("local", "hdfs"):
        folder, name = path.rsplit("/", 1)
        system.create_dir(folder, recursive=True)
        partial = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with system.open_output_stream(partial) as stream:
            stream.write(payload)
        if system.type_name == "hdfs" and system.get_file_info(path).is_file:
            system.delete_file(path)  # a rename does not replace there
        system.move(partial, path)
    else:  # object stores put atomically
        with system.open_output_stream(path) as stream:
            stream.write(payload)


def choose_input(files: list[str] | None, directory: str | None) -> list[str]:
    """Paths to load: explicit files or one directory, not both and not neither."""
    if (files is None) == (directory is None):
        raise ValueError("give either files or directory, and not both")
    if files is None:
        return [directory]
    if not files or not all(isinstance(f, str) and f for f in files):
        raise ValueError("files must be a list of names that are not empty")
    return list(files)


def drop_folder(uri: str) -> None:
    """Delete a folder made for one job, if it is there."""
    system, path = locate(uri)
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)


def check_on_error(on_error: str, *more: str) -> str:
    if on_error not in ("fail", "skip", *more):
        raise ValueError(f"on_error must be one of {', '.join(('fail', 'skip', *more))}")
    return on_error
