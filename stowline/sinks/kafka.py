"""Publishing file records to topics. Needs Spark's Kafka connector on the classpath."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stowline.operators.records import to_kafka_rows


def publish(source_records: DataFrame, servers: str) -> None:
    """Send a batch of source records to their topics."""
    to_kafka_rows(source_records).write.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).option("includeHeaders", "true").save()


def publish_stream(
    source_records: DataFrame, servers: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Send a stream of source records to their topics."""
    return (
        to_kafka_rows(source_records)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("includeHeaders", "true")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
