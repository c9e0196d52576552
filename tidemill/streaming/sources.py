"""Streaming sources and the record shapes of logs and change records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Record layouts.
ENVELOPE = ("op string, before map<string,string>, after map<string,string>, "
            "source map<string,string>, ts_ms bigint")
LOG = ("common struct<mid:string,uid:string,vc:string,ch:string,ar:string,is_new:string>, "
       "page struct<page_id:string,last_page_id:string,item:string,item_type:string,during_time:bigint>, "
       "start map<string,string>, err map<string,string>, "
       "displays array<map<string,string>>, actions array<map<string,string>>, ts bigint, _corrupt string")


def kafka_json(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Value-only records of a topic from the earliest offset (S6); needs the connector jar on the class path."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", "earliest").load())
    return not_null(raw.select(F.col("value").cast("string").alias("value")))


def json_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same record stream from text files."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return not_null(reader.load(path))


def not_null(df: DataFrame) -> DataFrame:
    """Null records are passed by the source and dropped here."""
    return df.where(F.col("value").isNotNull())


def change_log(lines: DataFrame) -> DataFrame:
    """Change records from JSON lines (S8) with their event time."""
    rec = F.from_json("value", ENVELOPE)
    return (lines.select(rec.alias("r")).select("r.*")
            .withColumn("event_time", F.timestamp_millis("ts_ms")))


def of_table(changes: DataFrame, table: str, *conditions: Column) -> DataFrame:
    """Records of one source table that satisfy every condition."""
    out = changes.where(F.col("source")["table"] == table)
    for c in conditions:
        out = out.where(c)
    return out


def before(name: str) -> Column:
    return F.col("before")[name]


def after(name: str) -> Column:
    return F.col("after")[name]


def moved(field: str, old: str | None, new: str) -> Column:
    """State transition (P6): from ``old`` (any known value when None) to ``new``."""
    was = before(field).isNotNull() if old is None else before(field) == old
    return was & (after(field) == new)


def live_payload() -> Column:
    """The payload that counts (X24): ``before`` of a delete, else ``after``."""
    return F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))


def keep_columns(payload: Column, allowed: Column) -> Column:
    """Payload restricted to a comma list of columns."""
    names = F.split(allowed, ",")
    return F.map_filter(payload, lambda k, v: F.array_contains(names, k))


def parsed_log(lines: DataFrame) -> DataFrame:
    """JSON log lines with their parse result; ``_corrupt`` holds a line that is no JSON."""
    rec = F.from_json("value", LOG, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return lines.select("value", rec.alias("r")).select("value", "r.*")
