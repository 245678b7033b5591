"""Message sink/source: JSON-lines files, one message per line.

The queue between producer and collector is a directory of JSON files
(written by ``write``/``writeStream``, read by ``read``/``readStream``).
Payload and metadata stay JSON *text* inside the message, exactly as
published, so decoding can apply strict type rules later.

Messages repeat their keys and much of their contents, so the files are
compressed.  Such a file is read by one task, so a file holds a bounded
number of messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemetry_engine.schemas import MESSAGE_SCHEMA

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
MAX_MESSAGES_PER_FILE = 500_000


def write_messages(messages: DataFrame, path: str, mode: str = "append") -> None:
    cols = [f.name for f in MESSAGE_SCHEMA.fields]
    extra = [c for c in messages.columns if c not in cols]
    (
        messages.select(*cols, *extra)
        .write.mode(mode)
        .option("timestampNTZFormat", TS_FORMAT)   # default would drop below ms
        .option("compression", "gzip")
        .option("maxRecordsPerFile", MAX_MESSAGES_PER_FILE)
        .json(path)
    )


def read_messages(spark: SparkSession, path: str, extra_schema: str | None = None) -> DataFrame:
    """Batch read; ``extra_schema`` is a DDL string for columns beyond the message."""
    schema = MESSAGE_SCHEMA.simpleString()[len("struct<"):-1].replace(":", " ")
    ddl = schema + (f", {extra_schema}" if extra_schema else "")
    return spark.read.schema(ddl).option("timestampNTZFormat", TS_FORMAT).json(path)


def stream_messages(spark: SparkSession, path: str, extra_schema: str | None = None, max_files: int | None = None) -> DataFrame:
    schema = MESSAGE_SCHEMA.simpleString()[len("struct<"):-1].replace(":", " ")
    ddl = schema + (f", {extra_schema}" if extra_schema else "")
    r = spark.readStream.schema(ddl).option("timestampNTZFormat", TS_FORMAT)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)

