"""Helpers shared by the operators: tables, work folders, vectorised text hashing."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_engine.session import shared_dir
from telemetry_engine.sources import fs


_SHIPPED: set[str] = set()
WORK_HOURS = 7 * 24  # no run takes that long


def ship(spark: SparkSession) -> None:
    """See to it that the tasks can import this package.

    Nothing is done where its folder is on PYTHONPATH or the working folder (as
    with ``--py-files`` or the repository as working folder); else a zip of
    the package is handed to Spark once per application, which sends it along.
    """
    root = Path(__file__).resolve().parents[2]
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or not (root / "telemetry_engine").is_dir() or any(p and Path(p).resolve() == root for p in known):
        return
    path = Path(tempfile.mkdtemp(prefix="run-")) / "telemetry_engine.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "telemetry_engine").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, also when the name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one (``spark.checkpoint.dir``).

    Results may read from it after the operator has returned, so folders of earlier runs are removed
    once they are ``WORK_HOURS`` old.
    """
    base = f"{shared_dir(spark)}/telemetry_engine/llm"
    for old in fs.older_than(spark, base, WORK_HOURS):
        if re.fullmatch(r"\w+-[0-9a-f]{12}", old.rstrip("/").rsplit("/", 1)[-1]):
            fs.delete(spark, old)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def filtered(df: DataFrame, keep) -> DataFrame:
    """``df`` through ``keep``, which filters its Arrow batches.  Columns go by number: Arrow jobs refuse names with dots."""
    plain = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    return plain.mapInArrow(keep, plain.schema).toDF(*df.columns)


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns that are computed once.

    They come out of a generator (``inline`` of a one-element array), so that
    neither a filter on them nor an expression that uses them several times, a
    lambda above all, makes Catalyst put the whole computation in their place.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def store(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    ship(df.sparkSession)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table of this run that nothing reads any more."""
    f, p = fs._fs_and_path(spark, path)
    f.delete(p, True)


def hash_sample(df: DataFrame, size: int, *by: str) -> DataFrame:
    """At most ``size`` rows, those of the least hash of ``by``: the bounded sample that a classifier is fitted on.

    The rows are counted first, so that about ``2 * size`` of them meet in one
    task, however many tasks read ``df``.
    """
    h = F.xxhash64(*by)
    n = df.count()
    if n > 4 * size:
        df = df.where(F.shiftrightunsigned(h, 1) < int(2 * size / n * (1 << 63)))
    # xxhash64 is signed; the shifted value orders alike with and without the cut above
    return df.orderBy(F.shiftrightunsigned(h, 1), *by).limit(size)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are kept for testing: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


# --- Arrow text columns as byte arrays -----------------------------------------------------

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values end to end, and the n + 1 offsets; null counts as empty."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
        width = np.int64
    else:
        column = column.cast(pa.string())
        width = np.int32
    if column.null_count:
        column = column.fill_null("")
    bufs = column.buffers()
    if len(column) == 0 or bufs[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(bufs[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Consecutive runs of ``values`` as binary values."""
    width = values.itemsize
    if offsets[-1] * width >= 1 << 31:
        raw = memoryview(values.tobytes())
        return pa.array([bytes(raw[a * width:b * width]) for a, b in zip(offsets, offsets[1:])], pa.binary())
    buffers = [None, pa.py_buffer((offsets * width).astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def chunks(offsets: np.ndarray, size: int = 1 << 20):
    """Runs [a, b) of values with about ``size`` bytes each (a longer value stands alone)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, min(b, n)
        a = b


def pieces(batch: pa.RecordBatch, column: int, size: int = 2 << 20):
    """Slices of a batch with about ``size`` bytes of text each, so that the arrays over a text's bytes stay small."""
    if not batch.num_rows:
        return
    _, offsets = utf8(batch.column(column))
    for a, b in chunks(offsets, size):
        yield batch.slice(a, b - a)


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_S33 = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: all input bits reach all output bits."""
    h = h ^ (h >> _S33)
    h = h * _M1
    h = h ^ (h >> _S33)
    h = h * _M2
    return h ^ (h >> _S33)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for lengths up to 4 M."""
    have = _POWERS.get(base)
    if have is not None and len(have) >= n:
        return have[:n]
    size = 1 << max(20, (n - 1).bit_length())
    out = np.empty(size, np.uint64)
    out[0] = 1
    k, step = 1, base
    while k < size:
        out[k:2 * k] = out[:k] * np.uint64(step)
        step = step * step & ((1 << 64) - 1)
        k *= 2
    if size <= 1 << 22:
        _POWERS[base] = out
    return out[:n]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, value number) of maximal runs of bytes for which ``inside`` is true; runs end with their value."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[0] = edge[n] = True
    edge[1:n] = inside[1:] != inside[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    keep = inside[start]
    start, end = start[keep], end[keep]
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs, from one prefix sum of a polynomial."""
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_P, n), out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * _powers(_P_INV, n + 1)[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, value number) of the words of each value; ASCII white space separates words."""
    start, end, doc = spans(data, offsets, ~_SPACE[data])
    return run_hashes(data, start, end), doc


_STEP = [np.uint64(x) for x in (0x9AE16A3B2F90404F, 0xC949D7C7509E6557, 0xFF51AFD7ED558CCD, 0x2545F4914F6CDD1D,
                                0xD6E8FEB86659FD93)]


def shingles(word: np.ndarray, doc: np.ndarray, n_docs: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, value number) of all runs of ``size`` words; a value of fewer words has one shingle of them all."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    k = len(word)
    out_h, out_d = [], []
    if k >= size:
        h = np.zeros(k - size + 1, np.uint64)
        for i in range(size):
            h += word[i:k - size + 1 + i] * _STEP[i % len(_STEP)] + np.uint64(i)
        same = doc[:k - size + 1] == doc[size - 1:]
        out_h.append(mix(h[same]))
        out_d.append(doc[:k - size + 1][same])
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        h = np.zeros(len(short), np.uint64)
        for i in range(size - 1):
            has = count[short] > i
            h[has] += word[first[short[has]] + i] * _STEP[i % len(_STEP)] + np.uint64(i)
        out_h.append(mix(h + count[short].astype(np.uint64)))
        out_d.append(short)
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out_h), np.concatenate(out_d)
