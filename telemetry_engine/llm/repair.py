"""Repair of conversation structure at least cost, by block tables in the manner of the Four Russians.

A conversation's rows, in the order of their turns, are edited until their role initials read ``(s?(ua)+)?``:
Keep (0), Rerole to user or assistant (3), Delete (4, the only choice for blank and duplicate rows), Insert an
empty user or assistant turn (3); a truncated row that stays costs 3 more.  Of the cheapest edits the one whose
initials are least in ASCII order is taken.

*Tables.*  A row is one of nine symbols (four kinds of role, truncated or not, or "must go"); a tenth pads.  The
costs from a place to the end, for the four states of the role pattern, less their minimum, form one of a few
vectors, all of them found by search.  For every vector and every block of ``BLOCK`` symbols the vector at the
block's left end is precomputed.  A conversation is run through from right to left, one lookup a block; then each
block is expanded backward from the vector at its right end, and the least edit that keeps to the optimum is taken
symbol by symbol.  No tie is lost: the vectors hold the whole rest of the conversation.

*Spark.*  Equal rows of a turn become one row with a count.  Rows are range partitioned and sorted by
(conversation, turn, role, text), and cut into segments of at most ``SEGMENT`` symbols, so that one long
conversation runs in many tasks.  A conversation in several segments is solved by each segment's summary (vector
and state at one end for every vector and state at the other) and one pass over the summaries, a few hundred bytes
a segment.  Only the sha256 of a conversation, which has no parallel form, streams its rows through one task.

Nulls: a null role, text, conversation or turn counts as one space where text is needed; null turns come first;
rows without a conversation id form one of their own.  Rows of one turn are ordered by role, md5 of the text and
text.  Very long texts are whole; an empty table gives no rows.  Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 4
SEGMENT = 8192
INITIALS = "sua"  # kinds 0 to 2; any other initial is kind 3
GONE, PAD, SYMBOLS = 8, 9, 10
STATES = 4  # start, after s, after u, after a
STEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}  # (state, kind) -> state
MADE = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}  # state -> the turn that can be put there
ENDS = (0, 3)


# --- tables --------------------------------------------------------------------------------

def _closed(costs: list[float]) -> tuple[float, ...]:
    """Costs from each state, where turns may be inserted first."""
    for _ in range(STATES):
        costs = [min(c, INSERT + costs[MADE[q][1]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _choices(symbol: int, state: int, after: tuple[float, ...]) -> list[tuple[str, float, int]]:
    """Edits that take a symbol in a state, as (initial, cost with all that follows, state after), by initial."""
    out = [("D", DELETE + after[state], state)]
    if symbol != GONE:
        kind, cut = symbol >> 1, TRUNCATED * (symbol & 1)
        if (state, kind) in STEP:
            to = STEP[state, kind]
            out.append(("K", KEEP + cut + after[to], to))
        to = MADE[state][1]
        out.append(("R", REROLE + cut + after[to], to))
    return out


def _before(symbol: int, after: tuple[float, ...]) -> tuple[float, ...]:
    return _closed([min(c for _, c, _ in _choices(symbol, q, after)) for q in range(STATES)])


def _edits(symbol: int, state: int, after: tuple[float, ...]) -> tuple[str, int]:
    """The least initials, among the cheapest, of insertions and the edit that takes the symbol; the state after."""
    now, letters = _before(symbol, after), ""
    while True:
        options = _choices(symbol, state, after) + [("I", INSERT + now[MADE[state][1]], MADE[state][1])]
        letter, _, to = min(o for o in options if o[1] == now[state])
        letters, state = letters + letter, to
        if letter != "I":
            return letters, state


class Tables:
    """Vectors, one-symbol and block transitions, and the edits of one symbol."""

    def __init__(self, block: int = BLOCK):
        end = _closed([0.0 if q in ENDS else float("inf") for q in range(STATES)])
        low = lambda v: tuple(c - min(v) for c in v)
        vectors, step = {low(end): 0}, []
        queue = [low(end)]
        for v in queue:  # grows while it is read
            to = []
            for s in range(GONE + 1):
                w = low(_before(s, v))
                if w not in vectors:
                    vectors[w] = len(vectors)
                    queue.append(w)
                to.append(vectors[w])
            step.append([*to, vectors[v]])
        self.block, self.n = block, len(queue)
        self.step = np.array(step, np.int16)
        self.blocks = self.step
        for _ in range(block - 1):  # one more symbol on the left
            self.blocks = np.stack([self.step[self.blocks, s] for s in range(SYMBOLS)], 1).reshape(self.n, -1)
        chunks: dict[str, int] = {"": 0}
        self.edit = np.zeros((self.n, SYMBOLS, STATES), np.int16)
        self.to = np.zeros((self.n, SYMBOLS, STATES), np.int8)
        for i, v in enumerate(queue):
            for q in range(STATES):
                self.to[i, PAD, q] = q
                for s in range(GONE + 1):
                    letters, self.to[i, s, q] = _edits(s, q, v)
                    self.edit[i, s, q] = chunks.setdefault(letters, len(chunks))
        self.chunks = np.array(list(chunks), object)
        self.tail = []
        for q in range(STATES):
            letters = ""
            while q not in ENDS:
                letters, q = letters + "I", MADE[q][1]
            self.tail.append(letters)

    def padded(self, symbols: list[np.ndarray]) -> np.ndarray:
        width = -(-max(map(len, symbols), default=0) // self.block) * self.block
        out = np.full((len(symbols), width), PAD, np.int16)
        for r, s in zip(out, symbols):
            r[:len(s)] = s
        return out

    def vectors(self, rows: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Vector at both ends of every block of every row of symbols; ``right``: the vectors at the rows' ends."""
        code = np.zeros((len(rows), rows.shape[1] // self.block), np.int64)
        for k in range(self.block):
            code = code * SYMBOLS + rows[:, k::self.block]
        out = np.empty((len(rows), code.shape[1] + 1), np.int16)
        out[:, -1] = right
        for b in range(code.shape[1] - 1, -1, -1):
            out[:, b] = self.blocks[out[:, b + 1], code[:, b]]
        return out

    def trace(self, rows: np.ndarray, vectors: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(chunk of edits of every symbol, state before every symbol and at the end)."""
        edit = np.zeros(rows.shape, np.int16)
        states = np.empty((len(rows), rows.shape[1] + 1), np.int8)
        states[:, 0] = state
        after = np.empty((len(rows), self.block), np.int16)
        for b in range(vectors.shape[1] - 1):
            at = b * self.block
            after[:, -1] = vectors[:, b + 1]
            for k in range(self.block - 1, 0, -1):  # the block, expanded backward
                after[:, k - 1] = self.step[after[:, k], rows[:, at + k]]
            for k in range(self.block):
                place = (after[:, k], rows[:, at + k], states[:, at + k])
                edit[:, at + k] = self.edit[place]
                states[:, at + k + 1] = self.to[place]
        return edit, states


_TABLES: dict[int, Tables] = {}


def tables(block: int = BLOCK) -> Tables:
    if block not in _TABLES:
        _TABLES[block] = Tables(block)
    return _TABLES[block]


# --- damage and faults ---------------------------------------------------------------------

def damaged(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """conv_id, turn, role, text, n: the rows after damage, ``n`` times each; a dropped row has n = 0.

    The rule is crc32(``conv_id:turn``) modulo 20: 0 drops the row, 1 empties its text, 2 removes full stops,
    exclamation and question marks, 3 repeats it, 4 makes it a user's.  ``damage=False`` leaves all as it is.
    """
    blank = lambda c: F.coalesce(C.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20 if damage else F.lit(-1)
    rows = conversations.select(C.col("conv_id").alias("conv_id"), C.col("turn").cast("long").alias("turn"),
                                blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    lost = F.col("kind") == 0
    return rows.select(
        "conv_id", F.when(~lost, F.col("turn")).alias("turn"),
        F.when(lost, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(lost, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"))


def _symbol(role: Column, fault: Column) -> Column:
    kind = F.lit(3)
    for i, c in enumerate(INITIALS):
        kind = F.when(F.substring(role, 1, 1) == c, i).otherwise(kind)
    return F.when(fault.isin("blank", "duplicate"), GONE).otherwise(kind * 2 + (fault == "truncated").cast("int"))


def faults(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row for the equal rows of a turn, ``n`` of them: their key, ``fault`` of the first, ``symbol`` of the first.

    All but the first of them are blank or duplicates.  More than ``segment`` are several rows, numbered ``run``.
    """
    ended = F.regexp_extract("text", r"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    one = (rows.withColumn("key", F.md5(F.col("text").cast("binary"))).groupBy("conv_id", "turn", "role", "key")
           .agg(F.sum("n").alias("n"), F.first("text").alias("text")))
    seen = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"))
    first = (one.where("n > 0").groupBy("conv_id", "role", "key").agg(F.min(seen).alias("seen"))
             .select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "key")], F.col("seen.turn").alias("_turn")))
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("key") == F.col("_key"))
    one = one.join(first, same, "left")
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / segment))))
    one = one.withColumn("run", run)
    fault = (F.when(F.col("n") == 0, "").when(ended == "", "blank")
             .when((F.col("run") > 0) | ~F.col("turn").eqNullSafe(F.col("_turn")), "duplicate")
             .when(~ended.isin(".", "!", "?"), "truncated").otherwise(""))
    one = C.computed(one, fault=fault)
    return one.select("conv_id", "turn", "role", "key", "text", "run", "fault",
                      F.least(F.lit(segment).cast("long"), F.col("n") - F.col("run") * segment).alias("n"),
                      _symbol(F.col("role"), F.col("fault")).alias("symbol"))


ORDER = ["conv_id", "turn", "role", "key", "text", "run"]
PLACED = ("conv_id long, turn long, role string, text string, fault string, n long, symbol int, "
          "part int, segment long, place int")


def _placed(size: int):
    """Sorted rows with their task, the segment within it and the place in the segment of their first symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        segment, place, last = 0, 0, None
        for b in batches:
            ids, counts = b.column(0).to_pylist(), b.column(5).to_pylist()
            at = np.empty((2, len(ids)), np.int64)
            for i, (conv, n) in enumerate(zip(ids, counts)):
                if (conv,) != last or place + n > size:
                    segment, place, last = segment + 1, 0, (conv,)
                at[:, i] = segment, place
                place += n
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(ids), part, np.int32)), pa.array(at[0]), pa.array(at[1].astype(np.int32))],
                [*b.schema.names, "part", "segment", "place"])

    return run


# --- solving -------------------------------------------------------------------------------

def _expanded(items: list[dict]) -> np.ndarray:
    """Symbols of a segment: the first of a row's equal rows has its symbol, the others must go."""
    out = np.full(sum(i["n"] for i in items), GONE, np.int16)
    at = 0
    for i in items:
        out[at] = i["symbol"]
        at += i["n"]
    return out


SUMMARY = "conv_id long, part int, segment long, left binary, leaves binary"
EDITS = "conv_id long, part int, segment long, places array<int>, states array<int>, letters array<string>, tail string"


def _summaries(block: int):
    """Per segment: the vector at its left for every one at its right; the state at its right for every pair of the
    vector at its right and the state at its left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables(block)
        ids, states = np.repeat(np.arange(t.n), STATES), np.tile(np.arange(STATES), t.n)
        for b in batches:
            left, leaves = [], []
            for items in b.column(3).to_pylist():
                rows = t.padded([_expanded(items)])
                v = t.vectors(np.repeat(rows, t.n, 0), np.arange(t.n))
                left.append(v[:, 0].astype(np.int16).tobytes())
                _, q = t.trace(np.repeat(rows, len(ids), 0), v[ids], states)
                leaves.append(q[:, -1].tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(left, pa.binary()),
                                              pa.array(leaves, pa.binary())],
                                             ["conv_id", "part", "segment", "left", "leaves"])

    return run


CHAIN = "part int, segment long, right int, state int, last boolean"


def _chain(group: pd.DataFrame) -> pd.DataFrame:
    """One conversation's segments: the vector at the right and the state at the left of each."""
    g = group.sort_values(["part", "segment"])
    right, v = [], 0
    for left in reversed(g["left"].tolist()):
        right.append(v)
        v = int(np.frombuffer(left, np.int16)[v])
    right.reverse()
    state, q = [], 0
    for r, leaves in zip(right, g["leaves"].tolist()):
        state.append(q)
        q = leaves[r * STATES + q]
    return pd.DataFrame({"part": g["part"], "segment": g["segment"], "right": right, "state": state,
                         "last": [False] * (len(g) - 1) + [True]})


def _solved(block: int):
    """Edits of every row of the segments, whose right vector and left state are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables(block)
        for b in batches:
            all_items = b.column(3).to_pylist()
            right, state = b.column(4).to_numpy(), b.column(5).to_numpy()
            last = b.column(6).to_pylist()
            order = np.argsort([sum(i["n"] for i in items) for items in all_items], kind="stable")
            out: list = [None] * len(order)
            for a in range(0, len(order), 512):  # rows of about one length together
                some = order[a:a + 512]
                rows = t.padded([_expanded(all_items[i]) for i in some])
                edit, states = t.trace(rows, t.vectors(rows, right[some]), state[some])
                for i, e, q in zip(some, edit, states):
                    letters, before, at = [], [], 0
                    for item in all_items[i]:
                        letters.append("".join(t.chunks[e[at:at + item["n"]]]))
                        before.append(int(q[at]))
                        at += item["n"]
                    out[i] = ([x["place"] for x in all_items[i]], before, letters, t.tail[q[at]] if last[i] else "")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([o[0] for o in out], pa.list_(pa.int32())),
                 pa.array([o[1] for o in out], pa.list_(pa.int32())), pa.array([o[2] for o in out], pa.list_(pa.string())),
                 pa.array([o[3] for o in out], pa.string())],
                ["conv_id", "part", "segment", "places", "states", "letters", "tail"])

    return run


def _edited(rows: DataFrame, path: str, block: int) -> DataFrame:
    """Edits per segment of ``rows`` (as ``_placed`` gives them)."""
    item = F.struct("place", F.col("n").cast("int").alias("n"), "symbol")
    segments = C.store(rows.where("n > 0").groupBy("conv_id", "part", "segment")
                       .agg(F.sort_array(F.collect_list(item)).alias("items")), f"{path}/segments")
    several = (segments.groupBy("conv_id").agg(F.count(F.lit(1)).alias("segments")).where("segments > 1")
               .select(F.col("conv_id").alias("_conv_id")))
    split = segments.join(several, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left_semi")
    chain = C.store(split.mapInArrow(_summaries(block), SUMMARY).groupBy("conv_id").applyInPandas(_chain, CHAIN), f"{path}/chain")
    known = segments.join(chain, ["part", "segment"], "left").select(
        "conv_id", "part", "segment", "items", F.coalesce("right", F.lit(0)).alias("right"),
        F.coalesce("state", F.lit(0)).alias("state"), F.coalesce("last", F.lit(True)).alias("last"))
    return known.mapInArrow(_solved(block), EDITS)


# --- results -------------------------------------------------------------------------------

STEPS = ("conv_id long, part int, segment long, place int, turn long, role string, text string, fault string, n long, "
         "letters string, edits array<struct<edit: string, role: string>>")


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, each segment's edits before them (place -1), as steps: a row with its edits and the turns they leave."""
    held: dict[int, tuple[int, str]] = {}
    where, tail = None, ""
    for b in batches:
        keep, letters, edits = [], [], []
        columns = {c: b.column(i).to_pylist() for i, c in enumerate(b.schema.names) if c != "text"}
        for i in range(b.num_rows):
            place = columns["place"][i]
            at = (columns["part"][i], columns["segment"][i])
            if place == -1:
                places = columns["places"][i]
                held = dict(zip(places, zip(columns["states"][i], columns["letters"][i])))
                where, tail, final = at, columns["tail"][i], places[-1]
                continue
            keep.append(i)
            if columns["n"][i] == 0 or where != at:
                letters.append("")
                edits.append([])
                continue
            state, text = held[place]
            if place == final:
                text += tail
            made = []
            for k, c in enumerate(text):
                if c == "I" or c == "R":
                    role, state = MADE[state]
                    made.append({"edit": c, "role": role})
                elif c == "K":
                    role = columns["role"][i]
                    state = STEP[state, INITIALS.index(role[0])]
                    made.append({"edit": c, "role": role})
            letters.append(text)
            edits.append(made)
        own = b.take(pa.array(keep, pa.int64()))
        names = ["conv_id", "part", "segment", "place", "turn", "role", "text", "fault", "n"]
        yield pa.RecordBatch.from_arrays(
            [*(own.column(own.schema.names.index(c)) for c in names), pa.array(letters, pa.string()),
             pa.array(edits, pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string())])))],
            [*names, "letters", "edits"])


def steps(conversations: DataFrame, damage: bool = True, by: tuple[str, ...] = ("part", "segment"), segment: int = SEGMENT,
          block: int = BLOCK) -> DataFrame:
    """Every row after damage (equal rows of a turn once, with ``n``; a dropped row with n = 0), in the order
    (conv_id, part, segment, place), with its fault, its edits' initials and the turns that they leave."""
    path = C.work_dir(conversations.sparkSession, "repair")
    rows = faults(damaged(conversations, damage), segment).repartitionByRange("conv_id", "turn", "role", "key", "run")
    rows = rows.sortWithinPartitions(*ORDER).select("conv_id", "turn", "role", "text", "fault", "n", "symbol")
    placed = C.store(rows.mapInArrow(_placed(segment), PLACED), f"{path}/rows")
    none = F.lit(None)
    edits = _edited(placed, path, block).select(
        "conv_id", "part", "segment", F.lit(-1).alias("place"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("text"), none.cast("string").alias("fault"), none.cast("long").alias("n"),
        "places", "states", "letters", "tail")
    own = placed.select("conv_id", "part", "segment", "place", "turn", "role", "text", "fault", "n",
                        none.cast("array<int>").alias("places"), none.cast("array<int>").alias("states"),
                        none.cast("array<string>").alias("letters"), none.cast("string").alias("tail"))
    # a row that was dropped has the place of its successor and comes before it
    return (own.unionByName(edits).repartition(*by).sortWithinPartitions("conv_id", "part", "segment", "place", "n")
            .mapInArrow(_steps, STEPS))


def repaired(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """The repaired conversations, a row per turn: conv_id, part, segment, place, step (their order), edit, role, text."""
    s = steps(conversations, damage)
    return s.select("conv_id", "part", "segment", "place", F.posexplode("edits").alias("step", "made"), "text").select(
        "conv_id", "part", "segment", "place", "step", "made.edit", "made.role",
        F.when(F.col("made.edit") == "I", "").otherwise(F.col("text")).alias("text"))


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
LEGAL = ("su", "ua", "au")
MOST = (1 << 63) - 1


class _Digest:
    def __init__(self, conv):
        self.conv, self.sha, self.any = conv, hashlib.sha256(), False
        self.audit = bytearray()
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = self.distinct = 0
        self.initial = self.first = self.turn = None

    def add(self, turn, role, text, fault, n, letters, edits) -> None:
        if not n:
            return
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn = turn
            self.distinct += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        self.illegal += n - 1  # no initial may follow itself
        if fault:
            self.count[fault] += 1
        self.count["blank" if fault == "blank" else "duplicate"] += n - 1
        self.audit += letters.encode()
        self.cost += DELETE * letters.count("D") + INSERT * letters.count("I") + REROLE * letters.count("R")
        for made in edits:
            if fault == "truncated" and made["edit"] != "I":
                self.cost += TRUNCATED
            if self.any:
                self.sha.update(b"\n")
            self.any = True
            self.sha.update(made["role"].encode() + b":")
            if made["edit"] != "I":
                self.sha.update(text.encode())

    def row(self) -> tuple:
        gaps = 0 if self.first is None else min(MOST, self.turn - self.first + 1 - self.distinct)
        return (self.conv, gaps, *self.count.values(), self.illegal, self.cost, self.audit.decode(), self.sha.hexdigest())


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [pa.int64()] * 7 + [pa.string()] * 2

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    now, done = None, []
    for b in batches:
        for piece in C.pieces(b, b.schema.names.index("text"), 8 << 20):
            for r in piece.to_pylist():
                if now is None or now.conv != r["conv_id"]:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(r["conv_id"])
                now.add(*(r[c] for c in ("turn", "role", "text", "fault", "n", "letters", "edits")))
        if len(done) > 10_000:
            yield batch(done)
            done = []
    if now is not None:
        yield batch([*done, now.row()])


def report(conversations: DataFrame, damage: bool = True, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """Per conversation: its gaps and faults after damage, the cost and initials of its edits, sha256 of the result."""
    return steps(conversations, damage, ("conv_id",), segment, block).mapInArrow(_digests, REPORT)
