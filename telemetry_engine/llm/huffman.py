"""Token ids as files of canonical length-limited Huffman code.

Counts of all ids give code lengths of at most ``LIMIT`` bits
(package-merge); the lengths alone define the canonical code and are stored
with the blocks.  A block holds whole documents in ascending id order and can
be decoded on its own: it lists its documents, and for every ``LANE`` ids the
bit at which they begin.  A decoder advances all lanes of many blocks
together, one table lookup per id and step.

Layout of a store (``write_ids``): ``codes`` (id, bits) and ``blocks`` (shard,
block, start, doc_ids, doc_tokens, lane_bits, lane_tokens, n_bits, payload),
shard by shard in ascending document order.

Null texts count as empty; a repeated document id keeps all its rows; rows
whose id is null come first.  An empty table gives an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C
from telemetry_engine.llm import tokens as T

LIMIT = 16          # longest code in bits, so that the decoding table fits a cache; more only if the ids need it
LANE = 256          # ids between two bit-offset checkpoints
BLOCK_IDS = 65_536  # a block ends with the document that reaches this
SHARD_IDS = 8_000_000

BLOCK_SCHEMA = ("shard int, block int, start long, doc_ids array<long>, doc_tokens array<int>, lane_bits array<long>, "
                "lane_tokens array<short>, n_bits long, payload binary")


# --- the code ------------------------------------------------------------------------------

def limit_for(counts: np.ndarray) -> int:
    """``LIMIT``, or two bits more than the number of ids needs."""
    return max(LIMIT, (int(np.count_nonzero(counts)) - 1).bit_length() + 2)


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for ids with a positive count (package-merge); 0 elsewhere."""
    lengths = np.zeros(len(counts), np.uint8)
    ids = np.flatnonzero(counts)
    if len(ids) == 0:
        return lengths
    if len(ids) == 1:
        lengths[ids] = 1
        return lengths
    if len(ids) > 1 << limit:
        raise ValueError(f"{len(ids)} ids need codes longer than {limit} bits")
    order = ids[np.argsort(counts[ids], kind="stable")]
    base = counts[order].astype(np.int64)
    n = len(base)
    # level by level: the sorted leaves merged with the pairs of the level below
    is_leaf = []
    weights = base
    for _ in range(limit - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([base, pairs])
        rank = np.argsort(both, kind="stable")
        is_leaf.append(rank < n)
        weights = both[rank]
    # 2n - 2 items of the last level are taken; of each level below, the pairs that those hold
    take = 2 * n - 2
    per_leaf = np.zeros(n, np.int64)
    for leaf in reversed(is_leaf):
        k = int(leaf[:take].sum())
        per_leaf[:k] += 1
        take = 2 * (take - k)
    per_leaf[:take] += 1
    lengths[order] = per_leaf
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: ascending by (length, id)."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.flatnonzero(lengths)
    order = order[np.argsort(lengths[order], kind="stable")]
    code, before = 0, 0
    for i in order.tolist():
        code <<= int(lengths[i]) - before
        before = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For each value of the next ``width`` bits: 32 times the id, plus its code's length."""
    width = max(1, int(lengths.max(initial=0)))
    order = np.flatnonzero(lengths)
    order = order[np.argsort(lengths[order], kind="stable")]
    reach = np.int64(1) << (width - lengths[order].astype(np.int64))
    table = np.ones(1 << width, np.uint32)
    entry = order.astype(np.uint32) * np.uint32(32) + lengths[order]
    table[:int(reach.sum())] = np.repeat(entry, reach)
    return table, width


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray, int]:
    """Payload, the bit at which every ``LANE`` ids begin, number of bits."""
    if len(ids) == 0:
        return b"", np.zeros(0, np.int64), 0
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    begin = end - size
    n_bits = int(end[-1])
    slot = begin >> 5
    # a code spans two 32-bit words at most; as a 64-bit value over both
    value = codes[ids].astype(np.uint64) << (64 - size - (begin & 31)).astype(np.uint64)
    out = np.zeros(n_bits // 32 + 2, np.uint32)
    heads = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
    out[slot[heads]] = np.bitwise_or.reduceat((value >> np.uint64(32)).astype(np.uint32), heads)
    low = (value & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    over = np.flatnonzero(low)
    out[slot[over] + 1] |= low[over]  # at most one code crosses into each word
    return out.astype(">u4").tobytes()[: (n_bits + 7) // 8], begin[::LANE], n_bits


def decode(payload: np.ndarray, lane_bits: np.ndarray, lane_tokens: np.ndarray,
           table: tuple[np.ndarray, int]) -> np.ndarray:
    """Ids of all lanes end to end.  ``lane_bits``: where each lane begins in ``payload``."""
    entries, width = table
    if len(lane_bits) == 0:
        return np.zeros(0, np.uint32)
    data = np.concatenate([payload, np.zeros(4, np.uint8)]).astype(np.uint32)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    order = np.argsort(-lane_tokens.astype(np.int64), kind="stable")
    at = lane_bits[order].astype(np.int64)
    left = lane_tokens[order].astype(np.int64)
    steps = int(left[0])
    alive = np.searchsorted(-left, -np.arange(1, steps + 1), side="right")  # lanes that have a step-th id
    out = np.zeros((steps, len(at)), np.uint32)
    shift, five, low = np.uint32(32 - width), np.uint32(5), np.uint32(31)
    for s in range(steps):
        k = alive[s]
        p = at[:k]
        entry = entries[(window[p >> 3] << (p & 7).astype(np.uint32)) >> shift]
        out[s, :k] = entry >> five
        p += (entry & low).astype(np.int64)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    by_lane = out.T[back]
    return by_lane[np.arange(steps) < lane_tokens.astype(np.int64)[:, None]]


# --- the store -----------------------------------------------------------------------------

def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int | None = 0, id_col: str = "doc_id",
              text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Encode every whole text, count all ids, and write the store at ``path``.

    The texts are tokenised once, into a table of 16- or 32-bit ids in the
    shared folder that is removed at the end.  Documents go to shards by range
    of id; what is shuffled is the finished code of each document.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    vocab = sc.broadcast(vocabulary)
    ids_path = C.work_dir(spark, "ids")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = T.encoder(vocab.value)
        small = max(enc.size, (end_id or 0) + 1) <= 1 << 16
        for b in batches:
            for a in range(0, b.num_rows, 2000):
                part = b.slice(a, 2000)
                flat, off = enc.documents(part.column(1), end_id)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(off), pa.int32()),
                     C.binary(flat.astype("<u2" if small else "<u4"), off),
                     pa.array(np.full(part.num_rows, 2 if small else 4), pa.int32())],
                    ["doc_id", "n_tokens", "ids", "width"])

    picked = docs.select(C.col(id_col).cast("long").alias("doc_id"), C.col(text_col).cast("string").alias("text"))
    ids = C.store(picked.mapInArrow(tokenise, "doc_id long, n_tokens int, ids binary, width int"), ids_path)

    total = ids.agg(F.sum("n_tokens")).first()[0] or 0
    n_shards = max(1, -(-total // shard_ids))
    bounds = _range_bounds(ids, n_shards)
    counts, shard_sizes = _count(ids, bounds)
    lengths = code_lengths(counts, limit_for(counts))
    (spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id int, bits int")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/codes"))

    code = sc.broadcast((canonical(lengths), lengths))
    starts = np.concatenate([[0], np.cumsum(shard_sizes)])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, bits = code.value
        for b in batches:
            rows = [encode(x, codes, bits) for x in _ids_of(b)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_shard_of(b.column(0), bounds), pa.int32()), b.column(0), b.column(1),
                 pa.array([r[0] for r in rows], pa.binary()),
                 pa.array([r[1].astype("<u4").tobytes() for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.int64())],
                ["shard", "doc_id", "n_tokens", "code", "lanes", "n_bits"])

    n_out = len(bounds) + 1
    (ids.select("doc_id", "n_tokens", "ids", "width")
     .mapInArrow(coded, "shard int, doc_id long, n_tokens int, code binary, lanes binary, n_bits long")
     .repartitionById(n_out, F.col("shard"))
     .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "n_tokens", "code")
     .mapInArrow(_blocks(starts), BLOCK_SCHEMA)
     .write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks"))
    C.discard(spark, ids_path)


def _ids_of(b: pa.RecordBatch) -> list[np.ndarray]:
    width = b.column("width")
    return [np.frombuffer(x.as_buffer(), "<u2" if w == 2 else "<u4")
            for x, w in zip(b.column("ids"), width.to_pylist())]


def _range_bounds(ids: DataFrame, n_shards: int) -> np.ndarray:
    """n_shards - 1 ascending document ids that split the rows about evenly."""
    if n_shards <= 1:
        return np.zeros(0, np.int64)
    at = [k / n_shards for k in range(1, n_shards)]
    got = ids.agg(F.percentile_approx("doc_id", at, max(10_000, 20 * n_shards)).alias("b")).first()["b"] or []
    return np.unique(np.asarray(got, np.int64))


def _shard_of(doc_ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    low = np.iinfo(np.int64).min
    return np.searchsorted(bounds, np.asarray(doc_ids.fill_null(low)), side="right").astype(np.int32)


def _count(ids: DataFrame, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every id over all documents, and the number of ids in each shard: one pass."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_id, n_shard = np.zeros(0, np.int64), np.zeros(len(bounds) + 1, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            one = np.bincount(np.concatenate([x.astype(np.int64) for x in _ids_of(b)]), minlength=len(n_id))
            one[: len(n_id)] += n_id
            n_id = one
            np.add.at(n_shard, _shard_of(b.column(0), bounds), np.asarray(b.column(1)).astype(np.int64))
        for kind, n in ((0, n_id), (1, n_shard)):
            k = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(k), pa.int32()), pa.array(k, pa.int32()), pa.array(n[k], pa.int64())],
                ["kind", "key", "n"])

    # at most one row per vocabulary entry and one per shard reach the driver
    got = (ids.select("doc_id", "n_tokens", "ids", "width").mapInArrow(count, "kind int, key int, n long")
           .groupBy("kind", "key").agg(F.sum("n").alias("n")).toPandas())
    by_id, by_shard = got[got["kind"] == 0], got[got["kind"] == 1]
    counts = np.zeros(int(by_id["key"].max()) + 1 if len(by_id) else 0, np.int64)
    counts[by_id["key"]] = by_id["n"]
    sizes = np.zeros(len(bounds) + 1, np.int64)
    sizes[by_shard["key"]] = by_shard["n"]
    return counts, sizes


def _blocks(starts: np.ndarray):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        shard, block, start, n_ids = None, 0, 0, 0

        def flush():
            nonlocal held, block, start, n_ids
            bit, lane_bits, lane_tokens = 0, [], []
            for _, n, code, lanes in held:
                own = np.frombuffer(lanes, "<u4").astype(np.int64)
                lane_bits.append(own + bit)
                lane_tokens.append(np.minimum(LANE, n - LANE * np.arange(len(own))))
                bit += 8 * len(code)
            row = {
                "shard": [shard], "block": [block], "start": [start], "doc_ids": [[h[0] for h in held]],
                "doc_tokens": [[h[1] for h in held]], "lane_bits": [np.concatenate(lane_bits)],
                "lane_tokens": [np.concatenate(lane_tokens).astype(np.int16)], "n_bits": [bit],
                "payload": [b"".join(h[2] for h in held)],
            }
            held, block, start, n_ids = [], block + 1, start + n_ids, 0
            return pa.RecordBatch.from_pydict(row, _BLOCK_ARROW)

        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(5)]
            for s, doc, n, code, lanes in zip(*cols):
                if s != shard:
                    if held:
                        yield flush()
                    shard, block, start = s, 0, int(starts[s])
                held.append((doc, n, code, lanes))
                n_ids += n
                if n_ids >= BLOCK_IDS:
                    yield flush()
        if held:
            yield flush()

    return build


_BLOCK_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_tokens", pa.list_(pa.int32())), ("lane_bits", pa.list_(pa.int64())), ("lane_tokens", pa.list_(pa.int16())),
    ("n_bits", pa.int64()), ("payload", pa.binary()),
])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a store: doc_id, start (ids before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    return _read(spark, path, False)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Like ``read_ids`` with ids_crc32 in place of the ids."""
    return _read(spark, path, True)


def _read(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    rows = spark.read.parquet(f"{path}/codes").collect()  # one row per vocabulary entry at most
    lengths = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.uint8)
    for r in rows:
        lengths[r["id"]] = r["bits"]
    kept = spark.sparkContext.broadcast(lengths)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(kept.value)
        for b in batches:
            for a in range(0, b.num_rows, 32):
                yield _decoded(b.slice(a, 32).to_pylist(), table, digest)

    last = "ids_crc32 long" if digest else "ids binary"
    return (spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
            .select("start", "doc_ids", "doc_tokens", "lane_bits", "lane_tokens", "payload")
            .mapInArrow(read, f"doc_id long, start long, n_tokens long, {last}"))


def _decoded(blocks: list[dict], table, digest: bool) -> pa.RecordBatch:
    base = np.cumsum([0] + [8 * len(x["payload"]) for x in blocks])
    bits = np.concatenate([np.asarray(x["lane_bits"], np.int64) + o for x, o in zip(blocks, base)])
    per_lane = np.concatenate([np.asarray(x["lane_tokens"], np.int64) for x in blocks])
    payload = np.frombuffer(b"".join(x["payload"] for x in blocks), np.uint8)
    ids = decode(payload, bits, per_lane, table).astype("<u4")
    n = np.concatenate([np.asarray(x["doc_tokens"], np.int64) for x in blocks])
    end = np.cumsum(n)
    start = np.concatenate([x["start"] + np.cumsum([0] + x["doc_tokens"][:-1]) for x in blocks])
    raw = memoryview(ids.tobytes())
    cut = [raw[4 * (e - k):4 * e] for e, k in zip(end.tolist(), n.tolist())]
    last = pa.array([zlib.crc32(x) for x in cut], pa.int64()) if digest else pa.array([bytes(x) for x in cut], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([d for x in blocks for d in x["doc_ids"]], pa.int64()), pa.array(start, pa.int64()),
         pa.array(n, pa.int64()), last], ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])
