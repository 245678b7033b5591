"""Derived tables materialised once per input, in the shared folder.

The engine's stores (telemetry table, metrics CSV files) are derived from
the driver's tables by Spark jobs and written under
``<spark.checkpoint.dir>/telemetry_engine/``.  A derived table is keyed by
the path and size/mtime of its source, so it is rebuilt whenever the source
changes and reused otherwise.  Writes go to a fresh directory and become
visible through their ``_SUCCESS`` marker only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_engine import adapters
from telemetry_engine.session import shared_dir
from telemetry_engine.sources import fs
from telemetry_engine.sources.csv_metrics import write_csv_lines
from telemetry_engine.sources.messages_io import read_messages, write_messages
from telemetry_engine.sources.store import append_telemetry, read_telemetry


# Bump when the layout or content rules of a derived table change.
LAYOUT_VERSION = 8


def derived_path(spark: SparkSession, sf_dir: str, name: str, sources: list[str]) -> str:
    sig = "|".join(
        [str(LAYOUT_VERSION), sf_dir.rstrip("/")]
        + [fs.signature(spark, f"{sf_dir.rstrip('/')}/{s}.parquet") for s in sources]
    )
    h = hashlib.sha1(sig.encode()).hexdigest()[:16]
    return f"{shared_dir(spark)}/telemetry_engine/derived/{name}-{h}"


def telemetry_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry store built from ``events`` (partitioned + sorted parquet)."""
    path = derived_path(spark, sf_dir, "telemetry", ["events"])
    if not fs.exists(spark, f"{path}/_SUCCESS"):
        t = adapters.telemetry_from_events(adapters.load(spark, sf_dir, "events"))
        append_telemetry(t, path, mode="overwrite")
    return read_telemetry(spark, path)


# File layout of the derived metrics CSV: a reordered header with one
# column the reader must ignore.
CSV_FILE_HEADER = [
    "uuid", "metric_name", "value", "timestamp", "gpu_id", "device", "modelName",
    "Hostname", "namespace", "pod", "container", "labels_raw", "rack",
]


def _quoted(c) -> F.Column:
    return F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))


# A second layout: two columns swapped, one left out.
CSV_SWAPPED_HEADER = ["metric_name", "uuid", *CSV_FILE_HEADER[2:-1]]


def metrics_csv_lines(events: DataFrame, customer: DataFrame, nation: DataFrame, header: list[str] | None = None,
                      line_feeds: bool = False) -> DataFrame:
    """Raw CSV lines for every event, with data-driven defects.

    click & value < 1      -> blank uuid            (missing_required)
    error & value >= 300   -> last three fields cut (field_count)
    view & value >= 300    -> one extra field        (field_count)
    purchase & value >= 300-> quoted model name containing a comma
    click & value >= 1     -> space before the quoted labels
    every row              -> value written with a leading space

    With ``line_feeds``, further: purchase & value < 300 and error & value >= 300
    hold a line feed inside the quoted model name; the model names of signups
    hold a quote that opens nothing.
    """
    r = adapters.csv_records_from_events(events, customer, nation)
    line_feeds = F.lit(line_feeds)
    v = F.col("value").cast("double")
    mt = F.col("metric_name")
    field = {
        "uuid": F.when((mt == "click") & (v < 1), F.lit("")).otherwise(F.col("uuid")),
        "value": F.concat(F.lit(" "), F.col("value")),
        "modelName": F.when(
            (mt == "purchase") & (v >= 300), _quoted(F.concat(F.col("modelName"), F.lit(", rev B")))
        ).when(line_feeds & (((mt == "purchase") & (v < 300)) | ((mt == "error") & (v >= 300))),
               _quoted(F.concat(F.col("modelName"), F.lit("\nrev C"))))
        .when(line_feeds & (mt == "signup"), F.concat(F.col("modelName"), F.lit(' 5" bay'))).otherwise(F.col("modelName")),
        "labels_raw": F.concat(F.when((mt == "click") & (v >= 1), F.lit("  ")).otherwise(F.lit("")), _quoted(F.col("labels_raw"))),
        "rack": F.concat(F.lit("r"), F.col("gpu_id")),
    }
    cols = [field.get(c, F.col(c)) for c in header or CSV_FILE_HEADER]
    full = F.concat_ws(",", *cols)
    short = F.concat_ws(",", *cols[:-3])
    line = (
        F.when((mt == "error") & (v >= 300), short)
        .when((mt == "view") & (v >= 300), F.concat(full, F.lit(",spare")))
        .otherwise(full)
    )
    return r.select(line.alias("line"))


def metrics_csv_dir(spark: SparkSession, sf_dir: str) -> str:
    """Metrics CSV files derived from events/customer/nation: a glob over folders, one per header layout.

    The files of the third begin with a blank line and hold line feeds inside
    quotes; one more file holds nothing but blank lines.
    """
    path = derived_path(spark, sf_dir, "metrics_csv", ["events", "customer", "nation"])
    if not fs.exists(spark, f"{path}/_SUCCESS"):
        events, customer, nation = (adapters.load(spark, sf_dir, t) for t in ("events", "customer", "nation"))
        for k, header in enumerate((CSV_FILE_HEADER, CSV_SWAPPED_HEADER, CSV_FILE_HEADER)):
            lines = metrics_csv_lines(events.where(F.col("event_id") % 3 == k), customer, nation, header, line_feeds=k == 2)
            write_csv_lines(lines, f"{path}/layout{k}", ("\n" if k == 2 else "") + ",".join(header), mode="overwrite")
        fs.write_text(spark, f"{path}/layout3/blank.csv", "\n \n")
        fs.write_text(spark, f"{path}/_SUCCESS", "")
    return f"{path}/layout*"


def messages_dir(spark: SparkSession, sf_dir: str) -> str:
    """Message store (JSON lines) published from events, with defects."""
    path = derived_path(spark, sf_dir, "messages", ["events", "customer", "nation"])
    if not fs.exists(spark, f"{path}/_SUCCESS"):
        msgs = adapters.messages_from_events(
            adapters.load(spark, sf_dir, "events"),
            adapters.load(spark, sf_dir, "customer"),
            adapters.load(spark, sf_dir, "nation"),
        )
        write_messages(msgs, path, mode="overwrite")
    return path


def messages_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_messages(spark, messages_dir(spark, sf_dir), extra_schema="seq bigint")


ARRIVAL_FILES = 12
RUN_HOURS = 24


def delivery_log_dir(spark: SparkSession, sf_dir: str) -> str:
    """Delivery-event log derived from events, as parquet files that each span the whole time (a stream source)."""
    log = lambda: adapters.delivery_log_from_events(adapters.load(spark, sf_dir, "events"))
    return _arrivals(spark, sf_dir, "delivery_log", log)


def telemetry_arrivals_dir(spark: SparkSession, sf_dir: str) -> str:
    """Telemetry points in an order of arrival that is not that of their time (a stream source)."""
    points = lambda: adapters.telemetry_from_events(adapters.load(spark, sf_dir, "events"))
    return _arrivals(spark, sf_dir, "telemetry_arrivals", points)


def _arrivals(spark: SparkSession, sf_dir: str, name: str, rows) -> str:
    path = derived_path(spark, sf_dir, name, ["events"])
    if not fs.exists(spark, f"{path}/_SUCCESS"):
        rows().repartition(ARRIVAL_FILES, "seq").write.mode("overwrite").parquet(path)
    return path


def run_dir(spark: SparkSession, name: str) -> str:
    """Fresh output folder for one run; its result reads from it, so it is removed by a later run, after a day."""
    import uuid

    base = f"{shared_dir(spark)}/telemetry_engine/runs"
    for old in fs.older_than(spark, base, RUN_HOURS):
        fs.delete(spark, old)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
