"""Whole texts to token ids, with a ``tokenizers`` vocabulary file.

A byte-level BPE splits a text before it merges.  Where a lone space or line
feed follows a non-space, and where ``.`` or ``,`` follows a letter, one split
ends and another begins whatever stands around them.  The ids of a text are
therefore those of its pieces between such places, end to end, and pieces
repeat: each Python worker keeps the ids of the pieces it has met in a hash
table over numpy arrays, finds all pieces of a batch at once, and gives only
new ones to the tokenizer.  At ``KEPT_PIECES`` the table starts anew.  Other
tokenizers, and texts with other white space or runs of it, are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa

from telemetry_engine.llm import common as C

KEPT_PIECES = 1_500_000
_WORKER: dict[str, "Encoder"] = {}


def read_vocabulary(path: str) -> str:
    """The tokenizer file's text (a fixed size of a few MB); tasks get it by value, so only the driver opens it."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoder(vocabulary: str) -> "Encoder":
    """This worker's encoder for a vocabulary; kept between tasks."""
    key = hashlib.sha1(vocabulary.encode()).hexdigest()
    if key not in _WORKER:
        _WORKER[key] = Encoder(vocabulary)
    return _WORKER[key]


class Encoder:
    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        # a special token's string within a document is ordinary text
        self.tokenizer.encode_special_tokens = True
        conf = json.loads(vocabulary)
        pre = conf.get("pre_tokenizer") or {}
        self.by_piece = (
            pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and not conf.get("normalizer") and not conf.get("truncation") and not conf.get("padding")
            and all(t.get("special") for t in conf.get("added_tokens", []))
        )
        self.size = self.tokenizer.get_vocab_size()
        # ids whose text begins with a space or a line feed
        names = (self.tokenizer.id_to_token(i) or "" for i in range(self.size))
        self.opens = np.array([n[:1] in ("\u0120", "\u010a") for n in names], bool)
        self.table = _Table()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, n + 1 offsets); null counts as empty."""
        data, offsets = C.utf8(texts)
        out, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a, b in C.chunks(offsets):
            ids, n = self._chunk(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            out.append(ids)
            sizes.append(n)
        return np.concatenate(out), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)

    def documents(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Like ``encode``, with ``end_id`` after each text."""
        ids, offsets = self.encode(texts)
        if end_id is None:
            return ids, offsets
        return np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))

    def _chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(offsets) - 1
        whole = _unusual(data, offsets) if self.by_piece else np.ones(n, bool)
        if whole.all():
            return self._whole([data[x:y].tobytes().decode("utf-8", "replace") for x, y in zip(offsets, offsets[1:])])
        if whole.any():  # runs of texts that are alike
            edge = np.flatnonzero(np.diff(whole.astype(np.int8))) + 1
            got = [self._chunk(data[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x])
                   for x, y in zip([0, *edge], [*edge, n])]
            return np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        start = _cuts(data, offsets)
        end = np.append(start[1:], len(data))
        key = C.run_hashes(data, start, end)
        check = _second_hash(data, start, end)
        entry = self.table.find(key, check)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            fresh = missing[np.unique(key[missing], return_index=True)[1]]
            if len(self.table) + len(fresh) > KEPT_PIECES:
                self.table = _Table()
                fresh = np.unique(key, return_index=True)[1]
                missing = np.arange(len(key))
            self.table.add(key[fresh], check[fresh], *self._pieces(data, start[fresh], end[fresh]))
            entry[missing] = self.table.find(key[missing], check[missing])
        ids, sizes = self.table.gather(entry)
        total = np.concatenate([[0], np.cumsum(sizes)])
        at = np.searchsorted(start, offsets)
        return ids, total[at[1:]] - total[at[:-1]]

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [np.asarray(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *got]), np.array([len(g) for g in got], np.int64)

    def _pieces(self, data, start, end) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces end to end, and their numbers."""
        # pieces that open with white space can be read off one text again: only their first ids do so
        opens = ((data[start] == 32) | (data[start] == 10)) & (end - start > 1)
        order = np.argsort(~opens, kind="stable")
        k = int(opens.sum())
        ids, sizes = [], []
        for a in range(0, k, 512):  # the tokenizer is quickest on texts of a few kB
            own = order[a:min(a + 512, k)]
            raw = _bytes_of(data, start[own], end[own])
            got, _ = self._whole([raw.decode("utf-8", "replace")])
            first = np.flatnonzero(self.opens[got])
            if len(first) != len(own) or first[0] != 0:
                got, n = self._whole([data[start[p]:end[p]].tobytes().decode("utf-8", "replace") for p in own])
            else:
                n = np.diff(np.append(first, len(got)))
            ids.append(got)
            sizes.append(n)
        rest = order[k:]
        if len(rest):
            got, n = self._whole([data[start[p]:end[p]].tobytes().decode("utf-8", "replace") for p in rest])
            ids.append(got)
            sizes.append(n)
        ids, sizes = np.concatenate(ids), np.concatenate(sizes)
        # back to the pieces' own order
        back = np.argsort(order, kind="stable")
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return ids[_ranges(begin[back], sizes[back])], sizes[back]


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin[0] .. begin[0] + sizes[0] - 1, begin[1] .. and so on."""
    total = int(sizes.sum())
    shift = begin - np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.arange(total) + np.repeat(shift, sizes)


def _bytes_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    return data[_ranges(start, end - start)].tobytes()


_BREAK = np.zeros(256, bool)
_BREAK[[10, 32]] = True
_ODD = np.zeros(256, bool)
_ODD[[9, 11, 12, 13, 28, 29, 30, 31]] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(65, 91), *range(97, 123)]] = True
_LATIN = np.zeros(256, bool)  # second bytes of the letters that begin with 0xC3
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin."""
    cut = _BREAK[data]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    mark = np.flatnonzero((data == 46) | (data == 44))
    mark = mark[mark > 0]
    letter = _ALPHA[data[mark - 1]] | (_LATIN[data[mark - 1]] & (data[np.maximum(mark - 2, 0)] == 0xC3) & (mark > 1))
    cut[mark[letter]] = True
    return np.flatnonzero(cut)


def _unusual(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with two breaks in a row, or white space other than the space and the line feed."""
    gap = _BREAK[data]
    odd = np.flatnonzero(_ODD[data])
    two = np.flatnonzero(gap[1:] & gap[:-1])
    two = two[~np.isin(two + 1, offsets)] if len(two) else two
    found = [odd, two]
    # white space of two or three bytes
    p = np.flatnonzero(data == 0xC2)
    p = p[p + 1 < len(data)]
    found.append(p[(data[p + 1] == 0x85) | (data[p + 1] == 0xA0)])
    p = np.flatnonzero((data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    p = p[p + 2 < len(data)]
    x = (data[p].astype(np.int64) << 16) | (data[p + 1].astype(np.int64) << 8) | data[p + 2]
    found.append(p[(x == 0xE19A80) | ((x >= 0xE28080) & (x <= 0xE2808A)) | (x == 0xE280A8) | (x == 0xE280A9)
                   | (x == 0xE280AF) | (x == 0xE2819F) | (x == 0xE38080)])
    out = np.zeros(len(offsets) - 1, bool)
    at = np.concatenate(found)
    if len(at):
        out[np.searchsorted(offsets, at, side="right") - 1] = True
    return out


_SECOND, _SECOND_INV = 0x9E3779B1, pow(0x9E3779B1, -1, 1 << 32)
_second_powers: list[np.ndarray] = []


def _second_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 32-bit hash that is independent of ``run_hashes``."""
    n = len(data) + 1
    if not _second_powers or len(_second_powers[0]) < n:
        size = 1 << max(20, n.bit_length())
        up = np.cumprod(np.concatenate([[1], np.full(size - 1, _SECOND)]).astype(np.uint32), dtype=np.uint32)
        down = np.cumprod(np.concatenate([[1], np.full(size - 1, _SECOND_INV)]).astype(np.uint32), dtype=np.uint32)
        _second_powers[:] = [up, down]
    up, down = _second_powers
    prefix = np.zeros(n, np.uint32)
    np.cumsum((data.astype(np.uint32) + np.uint32(7)) * up[:n - 1], out=prefix[1:], dtype=np.uint32)
    return (prefix[end] - prefix[start]) * down[start]


class _Table:
    """Ids of pieces by their two hashes: open addressing over numpy arrays."""

    def __init__(self):
        self.bits, self.count = 16, 0
        self.slots = np.full(1 << 16, -1, np.int32)
        self.key = np.zeros(1 << 15, np.uint64)
        self.check = np.zeros(1 << 15, np.uint32)
        self.begin = np.zeros((1 << 15) + 1, np.int64)
        self.ids = np.zeros(1 << 17, np.uint32)

    def __len__(self):
        return self.count

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Entry numbers, -1 where a piece is new."""
        out = np.full(len(key), -1, np.int64)
        todo = np.arange(len(key))
        slot = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        mask = (1 << self.bits) - 1
        while len(todo):
            e = self.slots[slot]
            safe = np.maximum(e, 0)
            same = (e >= 0) & (self.key[safe] == key[todo]) & (self.check[safe] == check[todo])
            out[todo[same]] = e[same]
            go = (e >= 0) & ~same
            todo, slot = todo[go], (slot[go] + 1) & mask
        return out

    def add(self, key: np.ndarray, check: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """New distinct pieces."""
        n = self.count + len(key)
        if n > len(self.key):
            size = 1 << (n - 1).bit_length()
            self.key, self.check = _longer(self.key, size), _longer(self.check, size)
            self.begin = _longer(self.begin, size + 1)
        used = int(self.begin[self.count])
        if used + len(ids) > len(self.ids):
            self.ids = _longer(self.ids, 1 << (used + len(ids) - 1).bit_length())
        own = slice(self.count, n)
        self.key[own], self.check[own] = key, check
        self.begin[self.count + 1:n + 1] = used + np.cumsum(sizes)
        self.ids[used:used + len(ids)] = ids
        first, self.count = self.count, n
        if 2 * n > 1 << self.bits:
            self.bits = (2 * n).bit_length()
            self.slots = np.full(1 << self.bits, -1, np.int32)
            first = 0
        todo = np.arange(first, n)
        slot = (self.key[todo] >> np.uint64(64 - self.bits)).astype(np.int64)
        mask = (1 << self.bits) - 1
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]  # of several for one slot, one stays
            lost = self.slots[slot] != todo
            todo, slot = todo[lost], (slot[lost] + 1) & mask

    def gather(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = self.begin[entry]
        sizes = self.begin[entry + 1] - begin
        return self.ids[_ranges(begin, sizes)], sizes


def _longer(a: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, a.dtype)
    out[:len(a)] = a
    return out
