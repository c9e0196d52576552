"""Streaming sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemill.session import fresh_path


def to_json_value(df: DataFrame, topic: str | None = None) -> DataFrame:
    """Rows as JSON ``value`` records (S16); with a ``topic`` column name the topic follows the row."""
    body = [c for c in df.columns if c != topic]
    value = F.to_json(F.struct(*body)).alias("value")
    return df.select(F.col(topic).alias("topic"), value) if topic else df.select(value)


def kafka_writer(df: DataFrame, servers: str, checkpoint: str, topic: str | None = None) -> DataStreamWriter:
    """Acknowledged, idempotent Kafka writes; rows bring their own topic unless one is given."""
    writer = (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("kafka.acks", "all").option("kafka.enable.idempotence", "true")
              .option("checkpointLocation", checkpoint))
    return writer.option("topic", topic) if topic else writer


def files_writer(df: DataFrame, path: str, checkpoint: str, by: str | None = None,
                 fmt: str = "parquet") -> DataStreamWriter:
    """Exactly-once file sink; ``by`` routes rows to a directory per value (S17 for files, S20)."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy(by) if by else writer


def batch_writer(path: str, fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """Micro-batches of JSON lines (S19): each batch owns a directory named by its id, so a retry overwrites its
    own output and nothing else."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")
    return run


def drain(writer: DataStreamWriter) -> None:
    """Process everything available now and stop."""
    query: StreamingQuery = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def run_to_table(df: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a streaming result to completion into a parquet table of the shared folder and return that table."""
    spark = df.sparkSession
    out, checkpoint = fresh_path(spark, label), fresh_path(spark, f"{label}-ckpt")
    if mode == "append":
        drain(files_writer(df, out, checkpoint).outputMode("append"))
    else:
        drain(df.writeStream.foreachBatch(batch_writer(out, "parquet"))
              .option("checkpointLocation", checkpoint).outputMode(mode))
    return spark.read.schema(df.schema).parquet(out if mode == "append" else f"{out}/*")
