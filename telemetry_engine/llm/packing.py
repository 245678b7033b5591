"""Near-equal packing of documents into training windows (Karmarkar-Karp).

A document of n tokens fills ``n // window`` windows by itself; its remainder
is cut into items of at most ``ITEM_TOKENS`` (windows of a few items balance
far better than pairs).  Items are gathered, up to ``GROUP_ITEMS`` at a time within a
task, and each gathering is partitioned into k windows by multiway
differencing: the two partial partitions whose windows differ most are merged,
the fullest windows of one with the emptiest of the other.  k starts at the
fewest windows that could hold the items and rises while a window exceeds its
capacity.  Where many items are alike, that could go on for long (items of 300
tokens fit six times into 2,048, whatever k is): once k has risen by the
``RISE``-th part and one, the fewest windows are taken, what exceeds a window is
cut off its items and fills the room that others have.  Everything happens where the texts are read, so nothing is
shuffled, and memory holds one gathering.

Null and empty texts are documents of the end id alone; repeated rows are
packed as often as they occur; an empty table has no pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from telemetry_engine.llm import common as C
from telemetry_engine.llm import tokens as T

WINDOW = 2048
ITEM_TOKENS = 512
GROUP_ITEMS = 2048
RISE = 64  # at most some 1.6 % more windows than the fewest, and one
SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long, ids binary")


def differencing(sizes: list[int], k: int) -> list[tuple[int, list[int]]]:
    """Karmarkar-Karp into ``k`` parts: (sum, item numbers) of each non-empty part."""
    # A partial partition: its non-empty parts as (sum, tree of items), ascending; the other k - len parts are empty.
    heap = []
    for i, s in enumerate(sizes):
        heap.append((-s if k > 1 else 0, i, [(s, i)]))
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, tie, b = heapq.heappop(heap)
        both = len(a) + len(b) - k
        if both <= 0:  # the parts of one meet empty parts of the other
            parts = a + b
        else:  # only the smallest of both meet, in opposing order
            parts = a[both:] + b[both:]
            parts.extend((x[0] + y[0], (x[1], y[1])) for x, y in zip(a[:both], b[both - 1::-1]))
        parts.sort(key=_sum)
        low = parts[0][0] if len(parts) == k else 0
        heapq.heappush(heap, (low - parts[-1][0], n + tie, parts))
    return [(s, _leaves(tree)) for s, tree in (heap[0][2] if heap else [])]


def _sum(part):
    return part[0]


def _leaves(tree) -> list[int]:
    out, todo = [], [tree]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            todo.extend(x)
        else:
            out.append(x)
    return out


def windows(sizes: list[int], capacity: int, most: int | None = None) -> list[list[int]] | None:
    """Item numbers of each window; no window exceeds ``capacity`` (every size is at most that).

    None where that takes more than ``most`` windows.
    """
    if not sizes:
        return []
    k = max(1, -(-sum(sizes) // capacity))
    while most is None or k <= most:
        parts = differencing(sizes, k)
        if max(s for s, _ in parts) <= capacity:
            return [items for _, items in parts]
        k += 1
    return None


def pieces(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """(item number, from, to) of the pieces in each window: whole items, or cut ones where those need too many windows."""
    fewest = -(-sum(sizes) // capacity)
    whole = windows(sizes, capacity, fewest + fewest // RISE + 1)
    if whole is not None:
        return [[(i, 0, sizes[i]) for i in items] for items in whole]
    return cut_to_fit([items for _, items in differencing(sizes, fewest)], sizes, capacity)


def cut_to_fit(parts: list[list[int]], sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """As many windows as ``parts``, or as the sum needs: what exceeds one is cut off and fills the room that others have."""
    out, ends = [], []
    for items in parts:
        own, surplus = [], max(0, sum(sizes[i] for i in items) - capacity)
        for i in items:
            cut = min(surplus, sizes[i])
            if cut:
                ends.append((i, sizes[i] - cut, sizes[i]))
                surplus -= cut
            if cut < sizes[i]:
                own.append((i, 0, sizes[i] - cut))
        out.append(own)
    out.extend([] for _ in range(-(-sum(sizes) // capacity) - len(out)))
    for own in out:
        room = capacity - sum(y - x for _, x, y in own)
        while room and ends:
            i, x, y = ends.pop()
            take = min(room, y - x)
            own.append((i, x, x + take))
            room -= take
            if x + take < y:
                ends.append((i, x + take, y))
    return out


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int | None = 1, id_col: str = "doc_id",
         text_col: str = "text", item_tokens: int = ITEM_TOKENS, group_items: int = GROUP_ITEMS) -> DataFrame:
    """One row per piece, with its ids (little-endian unsigned 32-bit) and its place.

    ``sequence_id`` is unique (the task's number and a count); the pieces of a
    sequence lie at ``offset`` without gaps from 0; ``sequence_tokens`` is its fill.
    """
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = T.encoder(vocab.value)
        number = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        items: list[tuple] = []

        def solve():
            nonlocal number
            for w in pieces([len(x[2]) // 4 for x in items], window):
                at = 0
                fill = sum(y - x for _, x, y in w)
                for i, x, y in w:
                    doc, start, ids, n = items[i]
                    rows.append((doc, start + x, y - x, n, number, at, fill, ids[4 * x:4 * y]))
                    at += y - x
                number += 1
            items.clear()

        def out():
            got = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], schema=_ARROW)
            rows.clear()
            return got

        for b in batches:
            for a in range(0, b.num_rows, 2000):
                part = b.slice(a, 2000)
                flat, off = enc.documents(part.column(1), end_id)
                raw = flat.astype("<u4").tobytes()
                for doc, x, y in zip(part.column(0).to_pylist(), off.tolist(), off[1:].tolist()):
                    ids, n = raw[4 * x:4 * y], y - x
                    for s in range(0, n // window * window, window):
                        rows.append((doc, s, window, n, number, 0, window, ids[4 * s:4 * (s + window)]))
                        number += 1
                    for s in range(n // window * window, n, item_tokens):
                        items.append((doc, s, ids[4 * s:4 * (s + item_tokens)], n))
                    if len(items) >= group_items:
                        solve()
                    if len(rows) >= 4096:
                        yield out()
        solve()
        if rows:
            yield out()

    picked = docs.select(C.col(id_col).cast("long").alias("doc_id"), C.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, SCHEMA)


_TYPES = [pa.int64()] * 7 + [pa.binary()]
_ARROW = pa.schema(list(zip(["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens",
                             "ids"], _TYPES)))
