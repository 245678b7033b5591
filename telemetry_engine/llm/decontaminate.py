"""Benchmark decontamination by greedy string tiling.

Texts are runs of lower-cased words (ASCII letters and digits, and all bytes
above ASCII).  Runs of ``MIN_MATCH`` words that a document shares with a
benchmark item are the seeds that join the two.  For each joined pair, running
Karp-Rabin marks the longest common runs of unmarked words first, then shorter
ones down to ``MIN_MATCH``; marked words never match again.  An item is leaked
when the marked tiles cover at least ``THRESHOLD`` of its words, in whatever
order they occur in the document.

Words outside every seed cannot lie in a match, so only the seeds' stretches of
a document are tiled.  The benchmark is the stated query set: it goes to the
tasks in blocks of at most ``BLOCK_BYTES`` of text, and documents are read once
per block without any shuffle.

An item of fewer than ``MIN_MATCH`` words matches only as a whole.  Null and
empty texts match nothing, on either side; repeated rows and items are reported
as often as they occur; an empty benchmark leaks nowhere.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C

MIN_MATCH = 5
THRESHOLD = 0.5
BLOCK_BYTES = 8 << 20
SCHEMA = ("doc_id long, item_id long, coverage double, item_tokens int, matched_tokens int, "
          "tiles array<struct<doc_start:int,item_start:int,length:int>>")

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_BASE, _MOD = 1_000_003, (1 << 61) - 1
_START = 20  # first search length of the tiling


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hash, text number) of all words of all texts."""
    data, offsets = C.utf8(pc.utf8_lower(texts))
    out_h, out_d = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in C.chunks(offsets):
        part = data[offsets[a]:offsets[b]]
        start, end, doc = C.spans(part, offsets[a:b + 1] - offsets[a], _WORD[part])
        out_h.append(C.run_hashes(part, start, end))
        out_d.append(doc + a)
    return np.concatenate(out_h), np.concatenate(out_d)


def _windows(word: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    n = len(word) - size + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        h = h * np.uint64(0x9E3779B97F4A7C15) + word[k:k + n]
    return C.mix(h)


# --- greedy string tiling ------------------------------------------------------------------

def tiling(pattern: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """Tiles (pattern start, text start, length >= ``least``), longest first (running Karp-Rabin)."""
    marked_p, marked_t = bytearray(len(pattern)), bytearray(len(text))
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(_START, len(pattern)))
    while True:
        longest, found = _scan(pattern, text, marked_p, marked_t, size)
        if longest > 2 * size:  # a very long match: look for its like first
            size = longest
            continue
        for k, p, t in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if any(marked_p[p:p + k]) or any(marked_t[t:t + k]):
                continue  # overlaps a longer one
            marked_p[p:p + k] = marked_t[t:t + k] = b"\1" * k
            tiles.append((p, t, k))
        if found:
            continue  # what an overlap left over
        if size == least:
            return tiles
        size = size // 2 if size > 2 * least else least


def _rolling(seq: list[int], marked: bytearray, size: int) -> Iterator[tuple[int, int]]:
    """(start, Karp-Rabin hash) of every unmarked run of ``size`` values."""
    drop = pow(_BASE, size - 1, _MOD)
    h, run = 0, 0
    for i, x in enumerate(seq):
        if marked[i]:
            h, run = 0, 0
            continue
        if run == size:
            h -= seq[i - size] * drop
        else:
            run += 1
        h = (h * _BASE + x) % _MOD
        if run == size:
            yield i - size + 1, h


def _scan(pattern, text, marked_p, marked_t, size) -> tuple[int, list[tuple[int, int, int]]]:
    """(longest match, matches of unmarked values of at least ``size`` that cannot be longer to the left)."""
    at = defaultdict(list)
    for t, h in _rolling(text, marked_t, size):
        at[h].append(t)
    longest, found = 0, []
    for p, h in _rolling(pattern, marked_p, size):
        for t in at.get(h, ()):
            if p and t and pattern[p - 1] == text[t - 1] and not marked_p[p - 1] and not marked_t[t - 1]:
                continue  # part of the match that begins one earlier
            k = 0
            while (p + k < len(pattern) and t + k < len(text) and pattern[p + k] == text[t + k]
                   and not marked_p[p + k] and not marked_t[t + k]):
                k += 1
            if k >= size:
                found.append((k, p, t))
                if k > 2 * size:
                    return k, found
                longest = max(longest, k)
    return longest, found


# --- seeds ---------------------------------------------------------------------------------

class Block:
    """The seeds of some benchmark items."""

    def __init__(self, ids: list, texts: list, min_match: int = MIN_MATCH):
        word, item = words(pa.array(texts, pa.string()))
        edge = np.searchsorted(item, np.arange(len(ids) + 1))
        self.ids, self.min_match = ids, min_match
        self.items = [word[a:b] for a, b in zip(edge, edge[1:])]
        self.seeds = {}  # run length -> (sorted hashes, their items, first-bits filter)
        by_size = defaultdict(list)
        for k, w in enumerate(self.items):
            if len(w):
                by_size[min(min_match, len(w))].append(k)
        for size, own in by_size.items():
            h = [np.unique(_windows(self.items[k], size)) for k in own]
            owner = np.repeat(own, [len(x) for x in h])
            h = np.concatenate(h)
            order = np.argsort(h, kind="stable")
            bits = np.zeros(1 << 20, bool)
            bits[h >> np.uint64(44)] = True
            self.seeds[size] = (h[order], owner[order], bits)

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """(text number, item number, tiles) of every pair that shares a seed."""
        word, doc = words(texts)
        hits: dict[tuple[int, int], list[np.ndarray]] = defaultdict(list)
        for size, (seeds, owner, bits) in self.seeds.items():
            h = _windows(word, size)
            at = np.flatnonzero(bits[h >> np.uint64(44)])
            at = at[doc[at] == doc[at + size - 1]]
            lo, hi = np.searchsorted(seeds, h[at], "left"), np.searchsorted(seeds, h[at], "right")
            for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                for k in owner[a:b].tolist():
                    hits[int(doc[p]), k].append(p)
        first = np.searchsorted(doc, np.arange(len(texts)))
        for (d, k), at in hits.items():
            size = min(self.min_match, len(self.items[k]))
            near = np.unique((np.asarray(at)[:, None] + np.arange(size)).ravel())
            # stretches of the document side by side, a value that matches nothing between them
            gap = np.flatnonzero(np.diff(near) > 1) + 1
            text = np.insert(word[near].astype(object), gap, -1).tolist()
            place = np.insert(near - first[d], gap, -1)
            tiles = tiling([int(x) for x in self.items[k]], text, size)
            if tiles:
                yield d, k, [(int(place[t]), p, n) for p, t, n in tiles]

    def coverage(self, k: int, tiles: list[tuple[int, int, int]]) -> float:
        return sum(t[2] for t in tiles) / len(self.items[k])


def blocks(benchmark: DataFrame, min_match: int, block_bytes: int, id_col: str, text_col: str) -> Iterator[Block]:
    """The benchmark's items in blocks of about ``block_bytes`` of text (a longer item is one block)."""
    b = benchmark.select(C.col(id_col).cast("long").alias("i"), F.coalesce(C.col(text_col), F.lit("")).alias("t"))
    total = b.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-2 * total // block_bytes))
    for k in range(n):
        part = b.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) if n > 1 else b
        rows = part.collect()
        if rows:
            yield Block([r["i"] for r in rows], [r["t"] for r in rows], min_match)


# --- the operator --------------------------------------------------------------------------

def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_match: int = MIN_MATCH,
          block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """One row per document and leaked item, with the tiles that cover the item (positions in words)."""
    spark = docs.sparkSession
    picked = docs.select(C.col(id_col).cast("long").alias("doc_id"), C.col(text_col).cast("string").alias("text"))
    out = None
    for block in blocks(benchmark, min_match, block_bytes, item_col, item_text_col):
        kept = spark.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch], kept=kept) -> Iterator[pa.RecordBatch]:
            block = kept.value
            for b in (part for whole in batches for part in C.pieces(whole, 1)):
                ids = b.column(0).to_pylist()
                rows = []
                for d, k, tiles in block.matches(b.column(1)):
                    share = block.coverage(k, tiles)
                    if share >= threshold:
                        rows.append((ids[d], block.ids[k], share, len(block.items[k]), sum(t[2] for t in tiles),
                                     [dict(zip(("doc_start", "item_start", "length"), t)) for t in sorted(tiles)]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)],
                                                     schema=_ARROW)

        one = picked.mapInArrow(find, SCHEMA)
        out = one if out is None else out.unionAll(one)
    return out if out is not None else spark.createDataFrame([], SCHEMA)


_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("item_tokens", pa.int32()),
    ("matched_tokens", pa.int32()),
    ("tiles", pa.list_(pa.struct([("doc_start", pa.int32()), ("item_start", pa.int32()), ("length", pa.int32())]))),
])


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_match: int = MIN_MATCH,
          block_bytes: int = BLOCK_BYTES, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, in which no item is leaked."""
    column = docs.columns.index(text_col)
    for block in blocks(benchmark, min_match, block_bytes, item_col, item_text_col):
        kept = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], kept=kept) -> Iterator[pa.RecordBatch]:
            block = kept.value
            for b in (part for whole in batches for part in C.pieces(whole, column)):
                ok = np.ones(b.num_rows, bool)
                for d, k, tiles in block.matches(b.column(column)):
                    ok[d] &= block.coverage(k, tiles) < threshold
                yield b.filter(pa.array(ok))

        docs = C.filtered(docs, keep)
    return docs
