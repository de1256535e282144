"""Files that appear in a directory."""

from pyspark.sql import DataFrame, SparkSession

from stowline.sources.listing import one_level, regular_files

# Fixed value: the usual interval of looking for new files.
DISCOVERY_TRIGGER = {"processingTime": "60 minutes"}

# Spark's file streams pass over files older than this behind the newest; none is that old
OLDEST_FILE = "36500d"


def discover_new_files(
    spark: SparkSession,
    directory: str,
    max_files_per_trigger: int | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Stream of the inventory rows of a directory; each file is reported once,
    whatever its age.

    Start it with ``trigger(**DISCOVERY_TRIGGER)`` or any other interval.
    """
    reader = spark.readStream.format("binaryFile").option("maxFileAge", OLDEST_FILE).schema(
        "path string, modificationTime timestamp, length long, content binary"
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    found = (
        reader.option("recursiveFileLookup", True)
        .load(directory)
        .select("path", "length", "modificationTime")
    )
    return regular_files(found if recursive else found.where(one_level(spark, [directory])))
