"""Ingest and collector streams (Structured Streaming, foreachBatch sinks).

Ingest:    metrics CSV files -> stamped, encoded messages (JSON lines) + quarantine + stats.
Collector: message files -> decode/validate -> telemetry + registry + quarantine + stats.

Exactly-once output without a transactional table format: every micro-batch
writes into directories named by its epoch id with ``overwrite`` and puts its
commit marker last (see ``epochs``).  A replayed epoch therefore rewrites the
same directories instead of appending twice.  Each micro-batch is stamped once
on the driver (one batch time and batch id for every row of the pass).
"""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from telemetry_engine.operators.ingest import batch_stamp
from telemetry_engine.operators.messages import (
    decode_messages, encode_messages, message_devices, telemetry_of,
)
from telemetry_engine.schemas import DEVICE_COLUMNS
from telemetry_engine.sources import fs
from telemetry_engine.sources.csv_metrics import (
    file_layouts, good_rows, missing_column, read_metrics_csv, rejected_rows, stream_metrics_files, without_lines,
)
from telemetry_engine.sources.messages_io import stream_messages, write_messages
from telemetry_engine.sources.store import with_event_date
from telemetry_engine.streaming.epochs import commit, epoch_dir, is_committed, read_epochs
from telemetry_engine.streaming.registry_runs import (
    RUNS_PER_LEVEL, SCHEMA, add_run, latest_devices, live_runs, read_runs,
)

log = logging.getLogger(__name__)

REPORT_SECONDS = 10
STORE_ATTEMPTS = 3
QUARANTINE_ONLY = ["id", "topic", "payload", "headers", "message_timestamp"]


def _trigger(writer, available_now: bool, processing_time: str | None):
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer


def start_ingest(
    spark: SparkSession,
    csv_path: str,
    out_dir: str,
    instance_id: str = "streamer-0",
    available_now: bool = True,
    processing_time: str | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """CSV files -> ``out_dir/messages`` (+ ``quarantine``, ``stats``), each file by its own header.

    A file whose header lacks a required column, or that has no line but blank
    ones, is counted in ``files_rejected`` and named in ``rejected_files``; it does
    not stop the stream.  (Files of no bytes are not listed by the source.)
    ``available_now`` drains what is there (one pass); ``processing_time``
    (e.g. '5 seconds') keeps polling for new files.
    """
    src = stream_metrics_files(spark, csv_path, max_files)

    def process(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        ts, bid = batch_stamp()
        names = [r["path"] for r in batch.collect()]  # at most ``max_files`` names
        layouts = file_layouts(session, names) if names else {}
        faults = {f: f"header lacks {missing_column(x.names)}" for f, x in layouts.items() if missing_column(x.names)}
        faults |= {f: "no header line" for f in without_lines(names, layouts)}
        bad = sorted(faults)
        good = {f: x for f, x in layouts.items() if f not in faults}
        if good:
            b = read_metrics_csv(session, sorted(good), layouts=good).persist()
            try:
                msgs = encode_messages(good_rows(b), batch_ts=ts, batch_id=bid, instance_id=F.lit(instance_id))
                write_messages(msgs, epoch_dir(f"{out_dir}/messages", epoch_id), mode="overwrite")
                rejected_rows(b).write.mode("overwrite").parquet(epoch_dir(f"{out_dir}/quarantine", epoch_id))
                stats = b.agg(
                    F.count(F.lit(1)).alias("rows_total"),
                    F.count_if(F.col("reject_reason").isNull()).alias("rows_sent"),
                    F.count_if(F.col("reject_reason").isNotNull()).alias("rows_rejected"),
                )
                _write_stats(stats.withColumns({"files_rejected": F.lit(len(bad)).cast("bigint"), "batch_id": bid}), out_dir, epoch_id)
            finally:
                b.unpersist()
        elif bad:
            zero = F.lit(0).cast("bigint")
            _write_stats(session.range(1).select(
                zero.alias("rows_total"), zero.alias("rows_sent"), zero.alias("rows_rejected"),
                F.lit(len(bad)).cast("bigint").alias("files_rejected"), bid.alias("batch_id")), out_dir, epoch_id)
        if bad:
            rows = [(f, faults[f]) for f in bad]
            (session.createDataFrame(rows, "source_file string, reject_reason string").coalesce(1)
             .write.mode("overwrite").parquet(epoch_dir(f"{out_dir}/rejected_files", epoch_id)))
        commit(session, out_dir, epoch_id)

    w = src.writeStream.foreachBatch(process).option("checkpointLocation", f"{out_dir}/_checkpoints/ingest")
    return _trigger(w, available_now, processing_time).start()


def _write_stats(stats: DataFrame, out_dir: str, epoch_id: int) -> None:
    stats.coalesce(1).write.mode("overwrite").parquet(epoch_dir(f"{out_dir}/stats", epoch_id))


def collector_metrics(decoded: DataFrame) -> DataFrame:
    """Attach the decoding counters as observed metrics named 'collector'."""
    ok = F.col("reject_reason").isNull()
    return decoded.observe("collector", F.count(F.lit(1)).alias("processed"), F.count_if(~ok).alias("rejected"))


def start_collector(
    spark: SparkSession,
    messages_path: str,
    out_dir: str,
    extra_schema: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files: int | None = None,
    report_seconds: float = REPORT_SECONDS,
    runs_per_level: int = RUNS_PER_LEVEL,
) -> StreamingQuery:
    """Message files -> ``out_dir/telemetry``, ``registry``, ``quarantine``, ``stats``.

    Telemetry is written first.  Then the epoch's latest row per device is
    added to the registry (``registry_runs``).  A failing write is tried again,
    then the rows are set aside in ``devices_pending`` for the next epoch and
    counted as errors; telemetry is not held up.  ``stats`` counts what was
    written, after it was written.  Progress is logged every ``report_seconds``.
    """
    src = stream_messages(spark, messages_path, extra_schema=extra_schema, max_files=max_files)
    decoded = collector_metrics(decode_messages(_spread(src, max_files)))

    def process(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        b = _needed(batch).persist()
        try:
            # same layout as the telemetry table: AQE-sized tasks per date (no
            # file per task and date), rows sorted by device inside each file
            t = (
                with_event_date(telemetry_of(b))
                .hint("rebalance", "event_date")
                .sortWithinPartitions("event_date", "gpu_uuid", "timestamp")
            )
            at = epoch_dir(f"{out_dir}/telemetry", epoch_id)
            t.write.mode("overwrite").partitionBy("event_date").parquet(at)
            stored = session.read.schema(t.schema).parquet(at).count()  # from the files' footers
            b.where(F.col("reject_reason").isNotNull()).write.mode("overwrite").parquet(
                epoch_dir(f"{out_dir}/quarantine", epoch_id)
            )
            folded = _store_devices(session, message_devices(_device_messages(b)), out_dir, epoch_id, runs_per_level)
            processed, rejected = b.agg(F.count(F.lit(1)), F.count_if(F.col("reject_reason").isNotNull())).first()
            valid = processed - rejected
            counts = {"processed": processed, "errors": rejected + (0 if folded else valid),
                      "gpus_stored": valid if folded else 0, "telemetry_stored": stored}
            _write_stats(session.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in counts.items()]),
                         out_dir, epoch_id)
            commit(session, out_dir, epoch_id)
        finally:
            b.unpersist()

    reporter = ObservedMetricsReporter(seconds=report_seconds)
    spark.streams.addListener(reporter)
    w = decoded.writeStream.foreachBatch(process).option("checkpointLocation", f"{out_dir}/_checkpoints/collector")
    query = _trigger(w, available_now, processing_time).start()
    reporter.watch(spark, str(query.id))
    return query


def _spread(messages: DataFrame, max_files: int | None) -> DataFrame:
    """Deal the messages of an epoch out to all cores where it has fewer files: a file is read by one task."""
    cores = messages.sparkSession.sparkContext.defaultParallelism
    return messages.repartition(cores, "id", "payload") if max_files and max_files < cores else messages


def _needed(decoded: DataFrame) -> DataFrame:
    """Without the parts of valid messages that no table takes: a rejected message is kept whole, in ``quarantine``."""
    rejected = F.col("reject_reason").isNotNull()
    return decoded.withColumns({c: F.when(rejected, F.col(c)) for c in QUARANTINE_ONLY})


def _device_messages(decoded: DataFrame) -> DataFrame:
    """The valid messages, each metadata of a device once and with its greatest ``seq``: the rest add no other device row."""
    key = ["gpu_uuid", "metadata", "reject_reason"]
    valid = decoded.where(F.col("reject_reason").isNull())
    if "seq" not in decoded.columns:
        return valid.select(*key).distinct()
    return valid.groupBy(*key).agg(F.max(F.col("seq").cast("bigint")).alias("seq"))


def _store_devices(session: SparkSession, updates: DataFrame, out_dir: str, epoch_id: int, per_level: int) -> bool:
    """Add the epoch's devices, and those that earlier epochs set aside, to the registry as a run.

    It starts from the newest committed epoch before this one, so a replayed
    epoch adds the same rows to the same runs.
    """
    order = F.col("seq") if "seq" in updates.columns else F.lit(epoch_id)
    own = latest_devices(updates.select(*DEVICE_COLUMNS, order.cast("bigint").alias("ord")))
    base, aside = f"{out_dir}/registry", f"{out_dir}/devices_pending"
    for attempt in range(1, STORE_ATTEMPTS + 1):
        try:
            rows = own
            last = max((e for e, _ in live_runs(session, base, before=epoch_id)), default=-1)
            for name in fs.list_subdirs(session, aside):
                e = int(name.removeprefix("epoch="))
                if last < e < epoch_id and is_committed(session, out_dir, e):
                    rows = rows.unionByName(session.read.schema(SCHEMA).parquet(epoch_dir(aside, e)))
            add_run(session, base, epoch_id, rows, per_level)
            return True
        except Exception:  # noqa: BLE001 - non-fatal by contract
            log.exception("devices of epoch %s not stored (attempt %s)", epoch_id, attempt)
    try:
        own.write.mode("overwrite").parquet(epoch_dir(aside, epoch_id))
    except Exception:  # noqa: BLE001
        log.exception("devices of epoch %s not set aside", epoch_id)
    return False


def read_collected_registry(spark: SparkSession, out_dir: str) -> DataFrame:
    """The registry as of the newest committed epoch that wrote to it."""
    return read_runs(spark, f"{out_dir}/registry")


def stream_totals(spark: SparkSession, out_dir: str, columns: list[str]) -> DataFrame:
    """Sums of the committed epochs' stats, however many there are."""
    return read_epochs(spark, f"{out_dir}/stats").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in columns])


class ObservedMetricsReporter(StreamingQueryListener):
    """Accumulates one query's observed counters and logs them every ``seconds``.

    It removes itself when its query ends.  Totals that have to be exact come
    from the epochs' stats (``stream_totals``), which also outlive the process.
    """

    def __init__(self, name: str = "collector", seconds: float = REPORT_SECONDS):
        self.name, self.seconds = name, seconds
        self.totals: dict[str, dict[str, int]] = {}
        self.reports = 0
        self._last = time.monotonic()
        self._spark: SparkSession | None = None
        self._query: str | None = None

    def watch(self, spark: SparkSession, query_id: str) -> None:
        self._spark, self._query = spark, query_id

    def onQueryStarted(self, event) -> None:  # noqa: N802 - listener API
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = (event.progress.observedMetrics or {}).get(self.name)
        if row is None:
            return
        acc = self.totals.setdefault(str(event.progress.id), {})
        for k, v in row.asDict().items():
            acc[k] = acc.get(k, 0) + int(v or 0)
        self._report(str(event.progress.id))

    def _report(self, query_id: str, always: bool = False) -> None:
        if always or time.monotonic() - self._last >= self.seconds:
            self._last = time.monotonic()
            self.reports += 1
            log.info("%s stats for %s: %s", self.name, query_id, self.totals.get(query_id))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if self._query == str(event.id):
            self._report(self._query, always=True)
            self._spark.streams.removeListener(self)
