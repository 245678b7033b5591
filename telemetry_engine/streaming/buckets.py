"""Processors of single keys, run for many keys at a time.

With the state API every group costs several round trips to the JVM and an Arrow batch of its own, which for keys
of a few events each is nearly all of the time.  So the streams here group by a hash of the key, and ``Buckets``
calls the processor of single keys for each key of its bucket that has events or a timer that is due.  What that
processor keeps is what it would keep alone; a bucket reads and writes it by the page.  An event goes to the tasks as
one text (``packed``), since every column of a row costs a conversion there.

State of a bucket: pages of some ``PAGE_KEYS`` keys (values and timers), a book (number of pages and keys,
the earliest timer of each page), and the items of lists, which are read only when asked for.  The number of pages
doubles with the keys, so a batch reads and writes the pages its keys lie in, however many there are.
The bucket has one timer: the earliest of its keys.
"""

from __future__ import annotations

import json
from collections import namedtuple
from collections.abc import Iterable, Iterator
from zlib import crc32

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from telemetry_engine.session import pickle_by_value

BUCKETS = 1024  # fixed for the life of a checkpoint
PAGE_KEYS = 500
CLOCK = "clock"  # moves time, is no part of an event


class KeyState:
    """The handle as a processor of single keys sees it: state and timers of the key at hand."""

    def __init__(self, items):
        self.items = items
        self.text, self.values, self.timers = "", {}, []

    def at(self, text: str, kept: list) -> None:
        self.text, (self.values, self.timers) = text, kept

    def getValueState(self, name: str, schema: str) -> _Value:  # noqa: N802 - handle API
        return _Value(self, name)

    def getListState(self, name: str, schema: str) -> _List:  # noqa: N802
        return _List(self, name)

    def registerTimer(self, ms: int) -> None:  # noqa: N802
        if ms not in self.timers:
            self.timers.append(ms)

    def deleteTimer(self, ms: int) -> None:  # noqa: N802
        if ms in self.timers:
            self.timers.remove(ms)


class _Value:
    def __init__(self, state: KeyState, name: str):
        self.state, self.name = state, name

    def get(self) -> tuple | None:
        there = self.state.values.get(self.name)
        return None if there is None else tuple(there)

    def update(self, value: tuple) -> None:
        self.state.values[self.name] = value


class _List:
    """The page holds the number of items; each item is an entry of its own."""

    def __init__(self, state: KeyState, name: str):
        self.state, self.name = state, name

    def _size(self) -> int:
        return self.state.values.get(self.name, 0)

    def _item(self, i: int) -> tuple[str]:
        return (json.dumps([self.state.text, self.name, i]),)

    def get(self) -> Iterator[tuple]:
        return iter([tuple(json.loads(self.state.items.getValue(self._item(i))[0])) for i in range(self._size())])

    def appendValue(self, value: tuple) -> None:  # noqa: N802
        n = self._size()
        self.state.items.updateValue(self._item(n), (json.dumps(value),))
        self.state.values[self.name] = n + 1

    def put(self, values: list[tuple]) -> None:
        self.clear()
        for v in values:
            self.appendValue(v)

    def clear(self) -> None:
        for i in range(self._size()):
            self.state.items.removeKey(self._item(i))
        self.state.values.pop(self.name, None)


class Buckets(StatefulProcessor):
    """``processor`` for every key of a bucket; its events have the names ``fields``, their values are texts or null."""

    def __init__(self, processor: StatefulProcessor, fields: list[str], page_keys: int = PAGE_KEYS):
        self.processor, self.fields, self.page_keys = processor, fields, page_keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.event = handle, namedtuple("Event", self.fields)
        self.book = handle.getValueState("book", "text string")
        self.pages = handle.getMapState("pages", "page long", "text string")
        self.one = KeyState(handle.getMapState("items", "item string", "text string"))
        self.processor.init(self.one)

    def _read_book(self) -> dict:
        st = self.book.get()
        return json.loads(st[0]) if st is not None else {"pages": 1, "keys": 0, "due": [None], "timer": None}

    def _page(self, there: dict[int, dict], page: int) -> dict[str, list]:
        """The page's keys: text -> [values, timers]; read once."""
        if page not in there:
            st = self.pages.getValue((page,))
            there[page] = json.loads(st[0]) if st is not None else {}
        return there[page]

    def handleInputRows(self, key, rows: Iterable[Row], timerValues) -> Iterator[Row]:  # noqa: N802
        events: dict[str, list[str]] = {}
        for r in rows:
            text, _, event = r[1].partition("\n")
            events.setdefault(text, []).append(event)
        book, there, out = self._read_book(), {}, []
        for text, its in events.items():
            page = self._page(there, _page_of(text, book["pages"]))
            if text not in page:
                page[text] = [{}, []]
                book["keys"] += 1
            self.one.at(text, page[text])
            its = [self.event(*x) for x in json.loads(f"[{','.join(its)}]")]
            out.extend(self.processor.handleInputRows(tuple(json.loads(text)), iter(its), timerValues))
        self._keep(book, there, timerValues)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        book, there, out = self._read_book(), {}, []
        book["timer"] = None
        now_ms = timerValues.getCurrentWatermarkInMs()
        for p, due in enumerate(book["due"]):
            if due is not None and due <= now_ms:
                for text, kept in self._page(there, p).items():
                    if any(t <= now_ms for t in kept[1]):
                        kept[1] = [t for t in kept[1] if t > now_ms]
                        self.one.at(text, kept)
                        out.extend(self.processor.handleExpiredTimer(tuple(json.loads(text)), timerValues, expiredTimerInfo))
        self._keep(book, there, timerValues)
        return iter(out)

    def _keep(self, book: dict, there: dict[int, dict], timerValues) -> None:
        pages = book["pages"]
        if book["keys"] > self.page_keys * pages:
            kept = [item for p in range(pages) for item in self._page(there, p).items()]
            while book["keys"] > self.page_keys * pages:
                pages *= 2
            there = {p: {} for p in range(pages)}
            for text, k in kept:
                there[_page_of(text, pages)][text] = k
            book["pages"], book["due"] = pages, [None] * pages
        for p, page in there.items():
            self.pages.updateValue((p,), (json.dumps(page),))
            book["due"][p] = min((t for _, timers in page.values() for t in timers), default=None)
        due = min((t for t in book["due"] if t is not None), default=None)
        # a timer that is due already fires by itself, and sets the next one then
        if due != book["timer"] and (book["timer"] is None or book["timer"] > timerValues.getCurrentWatermarkInMs()):
            if book["timer"] is not None:
                self.handle.deleteTimer(book["timer"])
            if due is not None:
                self.handle.registerTimer(due)
            book["timer"] = due
        self.book.update((json.dumps(book),))

    def close(self) -> None:
        self.processor.close()


def _page_of(text: str, pages: int) -> int:
    return crc32(text.encode()) % pages


def packed(key: list[str], fields: list[str]) -> Column:
    """Key and event as two lines, each a JSON list of texts (JSON has no line feed of its own)."""
    texts = lambda names: F.to_json(F.array(*[F.col(c).cast("string") for c in names]))
    return F.concat(texts(key), F.lit("\n"), texts(fields))


def by_buckets(events: DataFrame, key: list[str], processor: StatefulProcessor, output: str, time_mode: str,
               buckets: int = BUCKETS) -> DataFrame:
    """Streaming DataFrame (append mode) of what ``processor`` emits for the keys (text columns ``key``) of ``events``."""
    pickle_by_value(__name__)
    fields = [c for c in events.columns if c not in [*key, CLOCK]]
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket")
    return (events.select(bucket, packed(key, fields).alias("event")).groupBy("bucket")
            .transformWithState(statefulProcessor=Buckets(processor, fields), outputStructType=output, outputMode="Append",
                                timeMode=time_mode))
