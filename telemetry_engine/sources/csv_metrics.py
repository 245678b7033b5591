"""Metrics CSV source (header-resolved, permissive, with a reject reason).

Columns are found by header *name*: any order, extra columns ignored, names
trimmed, the last of a repeated name wins.  Eight columns are required.  Every
file is bound by its own header, its first line that is not blank: one Spark job
finds the headers and the files with line feeds inside quotes, files are grouped
by header, each group is scanned with its own binding, and the groups are
unioned by name.  Files with such line feeds are read by ``csv_records``, still
in many tasks; all others by the CSV reader.  Files without any line that is not
blank hold no rows.

Bad rows never fail the scan: a row whose field count differs from its file's
header, or whose uuid / metric_name is empty, comes back with
``reject_reason`` set, so one pass yields good rows and a quarantine with the
same schema.  A record whose last quote is missing is ``open_quote``; all that
follows in its file belongs to it.  Space before a field, quoted or not, does not belong to it.
"""

from __future__ import annotations

import csv
import io
import re
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_engine.functions.scalars import trim_whitespace
from telemetry_engine.schemas import CSV_COLUMNS, CSV_REQUIRED
from telemetry_engine.sources.csv_records import OPEN_LINE, ends_open, is_blank, records

CORRUPT = "_corrupt_record"


def parse_header(line: str) -> list[str]:
    names = next(csv.reader(io.StringIO(line, newline=""), skipinitialspace=True), [])
    if not names or names == [""]:
        raise ValueError("the header line names no column")
    return [n.strip() for n in names]


class Layout(NamedTuple):
    names: tuple[str, ...]
    line_feeds: bool  # some quoted field holds a line feed


def file_layouts(spark: SparkSession, path: str | list[str]) -> dict[str, Layout]:
    """Trimmed header names of every file under ``path`` that has a line, and how it must be read: one Spark job.

    The driver receives one line a file.
    """
    line = (spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
            .withColumn("n", F.monotonically_increasing_id()))
    at = F.when(~is_blank(F.col("value")), F.struct("file_block_start", "n"))
    rows = (line.groupBy("file_path").agg(F.min_by("value", at).alias("header"), F.max(ends_open(F.col("value"))).alias("open"))
            .where(F.col("header").isNotNull()).collect())
    # the metadata hold the path URL-encoded
    heads = {unquote(r["file_path"]): r["header"] for r in rows}
    # a header that itself holds a line feed is the file's first record
    broken = sorted(f for f, h in heads.items() if ends_open_text(h))
    if broken:
        heads |= {unquote(r["source_file"]): r["record"] for r in records(spark, broken).where("header").collect()}
    return {f: Layout(tuple(parse_header(heads[f])), r["open"]) for r in rows for f in [unquote(r["file_path"])]}


def ends_open_text(line: str) -> bool:
    """The header line ends inside a quoted field: it needs the line after it."""
    return re.match(OPEN_LINE.replace(r"\z", r"\Z"), line) is not None


def file_headers(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Trimmed header names of every file with data under ``path``."""
    return {f: list(x.names) for f, x in file_layouts(spark, path).items()}


def without_lines(names: list[str], layouts: dict[str, Layout]) -> list[str]:
    """Files of ``names`` that have no layout; names are compared without scheme and host."""
    path = lambda f: re.sub(r"\A[A-Za-z0-9+.-]+:(//[^/]*)?", "", f)
    known = {path(f) for f in layouts}
    return [f for f in names if path(f) not in known]


def header_schema(header: list[str]) -> tuple[T.StructType, dict[str, str]]:
    """Positional all-text schema for ``header`` plus name -> field mapping."""
    seen: dict[str, int] = {}
    for i, n in enumerate(header):
        seen[n] = i  # last occurrence wins
    unique = len(seen) == len(header) and CORRUPT not in seen
    fields = list(header) if unique else [f"_c{i}" for i in range(len(header))]
    schema = T.StructType(
        [T.StructField(f, T.StringType()) for f in fields] + [T.StructField(CORRUPT, T.StringType())]
    )
    return schema, {n: fields[i] for n, i in seen.items()}


def missing_column(header: list[str]) -> str | None:
    return next((c for c in CSV_REQUIRED if c not in header), None)


def read_metrics_csv(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    header: list[str] | None = None,
    layouts: dict[str, Layout] | None = None,
) -> DataFrame:
    """Scan metrics CSV -> the 12 text columns, ``source_file``, ``reject_reason``.

    Without ``header`` each file is bound by its own (``layouts``: those already
    known).  ``multi_line=True`` gives each file to one task of the CSV reader.
    """
    if header is not None:
        return _scan(spark, path, header, multi_line)
    groups: dict[Layout, list[str]] = {}
    for f, layout in sorted((file_layouts(spark, path) if layouts is None else layouts).items()):
        groups.setdefault(layout._replace(line_feeds=layout.line_feeds and not multi_line), []).append(f)
    if not groups:
        raise ValueError(f"no header line under {path}")
    out = None
    for layout, files in groups.items():
        names = list(layout.names)
        one = _scan_records(spark, files, names) if layout.line_feeds else _scan(spark, files, names, multi_line)
        out = one if out is None else out.unionByName(one)
    return out


def _scan(spark: SparkSession, path: str | list[str], header: list[str], multi_line: bool) -> DataFrame:
    missing = missing_column(header)
    if missing:
        raise ValueError(f"missing required column: {missing}")
    schema, field_of = header_schema(header)
    raw = _csv_options(spark.read.schema(schema), multi_line).csv(path)
    return project_metrics(raw, field_of)


def _scan_records(spark: SparkSession, files: list[str], header: list[str]) -> DataFrame:
    """``_scan`` of files with line feeds inside quotes: their records, parsed one by one."""
    missing = missing_column(header)
    if missing:
        raise ValueError(f"missing required column: {missing}")
    schema, field_of = header_schema(header)
    ddl = ", ".join("`" + f.replace("`", "``") + "` string" for f in schema.fieldNames())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "ignoreLeadingWhiteSpace": "true", "escape": '"'}
    rows = records(spark, files).where(~F.col("header"))
    parsed = rows.select(F.col("source_file").alias("_source"), F.col("open").alias("_open"),
                         F.inline(F.array(F.from_csv("record", ddl, options))))
    return project_metrics(parsed, field_of, F.col("_source"), F.col("_open"))


def stream_metrics_files(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """A stream of the names of files that appear under ``path`` (their content is not read).

    ``read_metrics_csv`` of a micro-batch's names binds each file by its header.
    """
    return (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("maxFilesPerTrigger", max_files)
            .load(path).select("path"))


BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def _csv_options(reader, multi_line: bool):
    return (
        reader.option("header", True)
        .option("enforceSchema", True)          # bind by position to this header
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreLeadingWhiteSpace", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        # with pruning the parser only checks the selected columns, and a short
        # row would pass whenever its missing fields are not selected
        .option("columnPruning", False)
    )


def project_metrics(raw: DataFrame, field_of: dict[str, str], source: Column | None = None, left_open: Column | None = None) -> DataFrame:
    """Raw header-bound rows -> 12 trimmed text columns, source_file, reject_reason."""
    cols = [
        trim_whitespace(F.coalesce(F.col(f"`{field_of[c]}`"), F.lit(""))).alias(c) if c in field_of else F.lit("").alias(c)
        for c in CSV_COLUMNS
    ]
    out = raw.select(*cols, F.col(CORRUPT), (F.col("_metadata.file_path") if source is None else source).alias("source_file"),
                     (F.lit(False) if left_open is None else left_open).alias("_left_open"))
    reason = F.when(F.col("_left_open"), F.lit("open_quote")).when(F.col(CORRUPT).isNotNull(), F.lit("field_count")).when(
        (F.col("uuid") == "") | (F.col("metric_name") == ""), F.lit("missing_required")
    )
    return out.withColumn("reject_reason", reason).drop(CORRUPT, "_left_open")


def good_rows(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_rows(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col("reject_reason").isNotNull())


def write_csv_lines(lines: DataFrame, path: str, header: str, mode: str = "error") -> None:
    """Write pre-rendered CSV records (column ``line``) verbatim, every file under ``header``.

    Used to produce files with deliberately malformed rows; records and
    ``header`` may hold line feeds.
    """

    def with_header(batches):
        yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])
        for b in batches:
            yield pa.RecordBatch.from_arrays(b.columns, ["value"])

    lines.select("line").mapInArrow(with_header, "value string").write.mode(mode).text(path)
