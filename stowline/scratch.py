"""Folders for intermediate tables."""

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

from stowline.sources.storage import join_path


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="stowline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a local one where that is unset and all runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return folder or unshared_folder(spark.sparkContext.master)


def unshared_folder(master: str) -> str:
    """A temporary folder of this machine, for masters that run everything on it."""
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a shared folder: the master is {master}")
    return _local_folder()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder; nothing is created yet."""
    return join_path(shared_folder(spark), f"stowline-{name}-{uuid.uuid4().hex}")
