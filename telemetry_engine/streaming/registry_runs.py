"""The registry of a stream as runs: an epoch writes its own devices, not the registry.

Layout: ``<base>/epoch=<n>`` is the run that epoch ``n`` wrote, one row per
device, sorted by uuid, with the list of the runs that make up the registry as
of that epoch (``_runs``: one line ``<epoch> <level>`` a run, oldest first).

A new run has level 0.  Where ``per_level - 1`` runs of its level precede it,
the epoch writes them and its own rows as one run of the next level instead.  So
a row is written again once a level, what an epoch writes follows the updates
(times the logarithm of the number of epochs), and a reader merges fewer than
``per_level`` runs a level.  Which row of a device wins depends on the rows alone
(greatest ``ord``, then the contents), so runs can be merged in any grouping.

Replay: an epoch starts from the list of the newest committed epoch before it
and overwrites its own directory.  Merged runs stay for ``KEEP_HOURS``, for
readers that opened an earlier list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_engine.operators.registry import latest_per_key
from telemetry_engine.schemas import DEVICE_COLUMNS
from telemetry_engine.sources import fs
from telemetry_engine.sources.store import MAX_RECORDS_PER_FILE
from telemetry_engine.streaming.epochs import epoch_dir, is_committed

RUNS_PER_LEVEL = 8
KEEP_HOURS = 24
SCHEMA = ", ".join(f"{c} string" for c in DEVICE_COLUMNS) + ", ord bigint"

Run = tuple[int, int]  # epoch, level


def latest_devices(rows: DataFrame) -> DataFrame:
    """The row of the greatest ``ord`` per uuid; ties fall back to the contents."""
    order = [F.col("ord").desc_nulls_last()] + [F.col(c).desc() for c in DEVICE_COLUMNS[1:]]
    return latest_per_key(rows, "uuid", order)


def live_runs(spark: SparkSession, base: str, before: int | None = None) -> list[Run]:
    """The runs that make up the registry as of the newest committed epoch (before ``before``, if given)."""
    out_dir = base.rsplit("/", 1)[0]
    there = [int(n[6:]) for n in fs.list_names(spark, base) if n.startswith("epoch=")]
    for e in sorted((e for e in there if before is None or e < before), reverse=True):
        runs = f"{epoch_dir(base, e)}/_runs"
        if is_committed(spark, out_dir, e) and fs.exists(spark, runs):
            return [(int(epoch), int(level)) for epoch, level in map(str.split, fs.read_text(spark, runs).splitlines())]
    return []


def plan_run(live: list[Run], per_level: int = RUNS_PER_LEVEL) -> tuple[list[Run], list[Run], int]:
    """(runs that stay, runs to merge into the new one, level of the new one)."""
    kept, level = list(live), 0
    while len(kept) >= per_level - 1 and all(x == level for _, x in kept[len(kept) - per_level + 1:]):
        kept, level = kept[:len(kept) - per_level + 1], level + 1
    return kept, live[len(kept):], level


def add_run(spark: SparkSession, base: str, epoch_id: int, rows: DataFrame, per_level: int = RUNS_PER_LEVEL) -> None:
    """Write the epoch's run: ``rows`` (devices with ``ord``) and the runs that are due to be merged."""
    if per_level < 2:
        raise ValueError("per_level must be at least 2")
    live = live_runs(spark, base, before=epoch_id)
    kept, merged, level = plan_run(live, per_level)
    if merged:
        rows = rows.unionByName(_read(spark, base, merged))
    at = epoch_dir(base, epoch_id)
    (latest_devices(rows).sortWithinPartitions("uuid").write.mode("overwrite")
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(at))
    fs.write_text(spark, f"{at}/_runs", "\n".join(f"{e} {x}" for e, x in [*kept, (epoch_id, level)]))
    if merged:
        fs.write_text(spark, f"{base}/_merged/{epoch_id:010d}", "\n".join(str(e) for e, _ in merged))
        remove_merged(spark, base, live, epoch_id)


def remove_merged(spark: SparkSession, base: str, live: list[Run], epoch_id: int, hours: float = KEEP_HOURS) -> None:
    """Remove the runs that epochs before this one merged, ``hours`` after that.

    ``live`` are the runs as of the newest committed epoch; none of them is removed.
    """
    needed = {e for e, _ in live}
    for note in fs.older_than(spark, f"{base}/_merged", hours, files=True):
        if int(note.rsplit("/", 1)[-1]) < epoch_id:
            for e in map(int, fs.read_text(spark, note).split()):
                if e not in needed:
                    fs.delete(spark, epoch_dir(base, e))
            fs.delete(spark, note)


def _read(spark: SparkSession, base: str, runs: list[Run]) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(*[epoch_dir(base, e) for e, _ in runs])


def read_runs(spark: SparkSession, base: str) -> DataFrame:
    """The registry: the latest row per device over its runs.

    A condition on ``uuid`` reaches the scan of every run; one run needs no merge.
    """
    runs = live_runs(spark, base)
    if not runs:
        return spark.createDataFrame([], SCHEMA).select(*DEVICE_COLUMNS)
    rows = _read(spark, base, runs)
    return (rows if len(runs) == 1 else latest_devices(rows)).select(*DEVICE_COLUMNS)
