import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("stowline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.int96RebaseModeInRead", "CORRECTED")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RECORD_SCHEMA = (
    "topic string, partition int, offset long, timestamp timestamp, key binary, "
    "value binary, headers array<struct<key:string,value:binary>>"
)


@pytest.fixture(scope="session")
def make_records(spark):
    """Records from tuples (topic, partition, offset, millis, key, value, headers)."""
    from pyspark.sql import functions as F

    def make(rows):
        schema = RECORD_SCHEMA.replace("timestamp timestamp", "millis long")
        df = spark.createDataFrame(rows, schema)
        return df.withColumn("timestamp", F.timestamp_millis("millis")).select(
            "topic", "partition", "offset", "timestamp", "key", "value", "headers"
        )

    return make


@pytest.fixture(scope="session")
def write_groups(spark):
    """Write Parquet rows of a schema given as text, through the example writer of the JVM."""

    def write(path, schema, rows, codec="UNCOMPRESSED", version="PARQUET_1_0", row_group=None):
        jvm = spark.sparkContext._jvm
        parse = jvm.org.apache.parquet.schema.MessageTypeParser.parseMessageType
        message = parse(schema)
        hadoop = jvm.org.apache.parquet.hadoop
        builder = (
            hadoop.example.ExampleParquetWriter.builder(jvm.org.apache.hadoop.fs.Path(path))
            .withType(message)
            .withCompressionCodec(
                getattr(hadoop.metadata.CompressionCodecName, codec)
            )
            .withWriterVersion(
                getattr(jvm.org.apache.parquet.column.ParquetProperties.WriterVersion, version)
            )
        )
        if row_group:
            builder = builder.withRowGroupSize(row_group)
        writer = builder.build()
        simple = jvm.org.apache.parquet.example.data.simple
        wrap = {
            "INT64": lambda v: simple.LongValue(v),
            "INT32": lambda v: simple.IntegerValue(v),
            "BOOLEAN": lambda v: simple.BooleanValue(v),
            "FLOAT": lambda v: simple.FloatValue(v),
            "DOUBLE": lambda v: simple.DoubleValue(v),
        }

        def fill(group, values):
            for name, value in values.items():
                field = group.getType().getType(name)
                for one in value if isinstance(value, list) else [value]:
                    if one is None:
                        continue
                    if isinstance(one, dict):
                        fill(group.addGroup(name), one)
                        continue
                    kind = field.asPrimitiveType().getPrimitiveTypeName().toString()
                    if kind in wrap:
                        group.add(group.getType().getFieldIndex(name), wrap[kind](one))
                    else:
                        data = one.encode() if isinstance(one, str) else one
                        data = jvm.org.apache.parquet.io.api.Binary.fromConstantByteArray(
                            bytearray(data)
                        )
                        if kind == "INT96":
                            group.add(group.getType().getFieldIndex(name), simple.Int96Value(data))
                        else:
                            group.add(name, data)

        for row in rows:
            group = jvm.org.apache.parquet.example.data.simple.SimpleGroup(message)
            fill(group, row)
            writer.write(group)
        writer.close()

    return write
