"""Toxicity of noisy text: restore disguised words, then score the restored text.

1. *Character model.*  Trigrams of letters (with word boundaries) are counted
   over all documents, in ``TRIGRAMS`` hashed buckets.
2. *Noisy channel.*  A word written with look-alike symbols (``1d10t``), with
   letters set apart (``i d i o t``) or drawn out (``idiooot``), of any length,
   becomes a lattice: each symbol may be any letter it stands for, punctuation
   that ends the word also itself, a run of three or more equal letters one or
   two of them, a run of two letters or of symbols fewer at a cost, a gap
   between single letters a word boundary or nothing.  Viterbi finds the path
   of the greatest probability under the character model.  Other words have
   one path, themselves.
3. *Score.*  Features are the restored words and their first 4, 5 and 6 bytes,
   hashed.  From at most ``SAMPLE`` labelled rows (``held_out`` ones never),
   features that occur mainly in toxic texts are picked greedily: each pick
   covers most of the toxic texts that no earlier pick explains, so that words
   which merely accompany a toxic one are not picked.  The score is the
   probability that at least one of a text's picked features is toxic, or the
   rate of toxic texts among those without any.

Null and empty texts have no feature and get that rate.  Without labelled rows
every score is 0.  Rows are scored one by one, so repeated rows and null ids
change nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C

TRIGRAMS = 1 << 18
BUCKETS = 1 << 22
SAMPLE = 10_000
MIN_TEXTS = 4        # toxic texts that a picked feature explains, at least
MIN_RATE = 0.5       # lower bound (one deviation) of the share of toxic texts among those with it
MISTAKE = 5
MAX_FEATURES = 20_000  # candidates before the picks; the model's size bound
PREFIXES = (4, 5, 6)

# Letters that a symbol may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "*": "aeiou",
}
_SYMBOLS = "".join(re.escape(c) for c in LOOK_ALIKES)
_LETTER = r"[^\W\d_]"
_EITHER = rf"(?:{_LETTER}|[{_SYMBOLS}])"
#: A whole run of letters and symbols with at least one of each.
_LEET = re.compile(rf"(?<!{_LETTER})(?<![{_SYMBOLS}])(?:{_LETTER}++[{_SYMBOLS}]|[{_SYMBOLS}]++{_LETTER}){_EITHER}*+")
_APART = re.compile(r"(?<![\w])(?:[\w@$!|€]([ ._\-*]))(?:[\w@$!|€]\1)+[\w@$!|€](?![\w])")
_DRAWN = re.compile(rf"(?<!\w)\w*({_LETTER})\1{{2,}}\w*")
#: Symbols that may also be punctuation when they end a word.
_ENDS = "!|+*"
FEWER = -4.0  # log cost of one letter fewer than written in a run of two, or of symbols
_SETTLE = 512  # places after which paths that agree are written out


# --- the character model -------------------------------------------------------------------

_CLASS = np.zeros(0x250, bool)
_CLASS[[i for i in range(0x250) if chr(i).isalpha()]] = True


def _letters(text: str) -> np.ndarray:
    """Code points with every non-letter as 0."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    low = c < 0x250
    letter = np.where(low, _CLASS[np.where(low, c, 0)], (c < 0x2000) | (c > 0x303F))
    return np.where(letter, c, 0)


def _key(a, b, c):
    return (C.mix((a << np.uint64(42)) | (b << np.uint64(21)) | c) & np.uint64(TRIGRAMS - 1)).astype(np.int64)


def count_trigrams(texts: pa.Array) -> np.ndarray:
    """Counts of letter trigrams in hashed buckets; a word ends and begins with 0."""
    out = np.zeros(TRIGRAMS, np.int64)
    lower = pc.utf8_lower(texts.cast(pa.large_string()))
    for a in range(0, len(lower), 256):
        joined = " ".join(x for x in lower.slice(a, 256).to_pylist() if x)
        c = _letters(f" {joined} ")
        c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]  # one boundary between words
        if len(c) >= 3:
            keep = c[1:-1] != 0
            out += np.bincount(_key(c[:-2], c[1:-1], c[2:])[keep], minlength=TRIGRAMS)
            first = np.flatnonzero(c[:-1] == 0)
            out += np.bincount(_key(np.zeros(len(first), np.uint64), np.zeros(len(first), np.uint64), c[first + 1]),
                               minlength=TRIGRAMS)
    return out


class CharacterModel:
    """log P(c | a, b) of letters; 0 is the boundary of words."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.context: dict[tuple[int, int], float] = {}
        self.seen: dict[tuple[int, int, int], float] = {}
        self.total = max(1, int(counts.sum()))
        self.alphabet = [0, *map(ord, "abcdefghijklmnopqrstuvwxyzàáâäåæçèéêëìíîïñòóôöøùúûüýßœ")]

    def _count(self, a: int, b: int, c: int) -> float:
        u = np.uint64
        return float(self.counts[int(_key(np.array([a], u), np.array([b], u), np.array([c], u))[0])])

    def logp(self, a: int, b: int, c: int) -> float:
        got = self.seen.get((a, b, c))
        if got is None:
            if len(self.seen) > 100_000:
                self.seen.clear()
            got = self.seen[a, b, c] = self._logp(a, b, c)
        return got

    def _logp(self, a: int, b: int, c: int) -> float:
        key = (a, b)
        if key not in self.context:
            u = np.uint64
            n = len(self.alphabet)
            k = _key(np.full(n, a, u), np.full(n, b, u), np.array(self.alphabet, u))
            if len(self.context) > 100_000:
                self.context.clear()
            self.context[key] = float(self.counts[k].sum())
        return float(np.log((self._count(a, b, c) + 0.05) / (self.context[key] + 0.05 * len(self.alphabet))))


def viterbi(lattice: Iterable[list[tuple[str, float]]], model: CharacterModel) -> str:
    """The likeliest string: one option (letters, a boundary or nothing, log cost) at each place.

    Whatever is no letter is a boundary; boundaries side by side count once.
    """
    # a state is the last two letters, the boundary as 0; its path is a chain of [earlier, string]
    states: dict[tuple[int, int], tuple[float, list | None]] = {(0, 0): (0.0, None)}
    done: list[str] = []
    for k, options in enumerate(chain(lattice, [[(" ", 0.0)]]), 1):
        after: dict[tuple[int, int], tuple[float, list]] = {}
        for (a, b), (score, path) in states.items():
            for string, cost in options:
                x, y, s = a, b, score + cost
                for ch in string:
                    c = ord(ch) if ch.isalpha() else 0
                    if c or y:
                        s += model.logp(x, y, c)
                    x, y = (0, 0) if c == 0 else (y, c)
                kept = after.get((x, y))
                if kept is None or s > kept[0]:
                    after[x, y] = (s, [path, string])
        states = after
        if k % _SETTLE == 0:
            _settle([path for _, path in states.values()], done)
    _settle([max(states.values(), key=lambda x: x[0])[1]], done)
    return "".join(done).strip()


def _settle(paths: list[list], done: list[str]) -> None:
    """Moves what all paths begin with to ``done``."""
    whole = []
    for path in paths:
        nodes = []
        while path is not None:
            nodes.append(path)
            path = path[0]
        whole.append(nodes[::-1])
    same = 0
    while all(len(w) > same and w[same] is whole[0][same] for w in whole):
        same += 1
    if same:
        done += [node[1] for node in whole[0][:same]]
        last = whole[0][same - 1]
        last[0], last[1] = None, ""


def _places(word: str) -> Iterator[list[tuple[str, float]]]:
    """The lattice of one written word."""
    ends = len(word.rstrip(_ENDS))
    i = 0
    while i < len(word):
        ch = word[i]
        n = 1
        while i + n < len(word) and word[i + n] == ch and i + n != ends:
            n += 1
        stand = LOOK_ALIKES.get(ch)
        if i >= ends:
            yield [(ch * n, 0.0)] + [(c * m, 0.0) for c in stand for m in range(1, min(n, 2) + 1)]
        elif stand:
            letters = [(c, 0.0) for c in stand]
            yield letters
            for _ in range(n - 1):
                yield [*letters, ("", FEWER)]
        elif n >= 3 and ch.isalpha():
            yield [(ch, 0.0), (ch * 2, 0.0)]
        elif n == 2 and ch.isalpha():
            yield [(ch * 2, 0.0), (ch, FEWER)]
        elif ch.isalpha():
            yield [(ch, 0.0)]
        i += n


class Restorer:
    """Texts with their disguised words restored (lower case)."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.known: dict[str, str] = {}

    def word(self, written: str) -> str:
        got = self.known.get(written)
        if got is None:
            got = viterbi(_places(written), self.model)
            if len(written) <= 40:  # longer ones are not met again often
                if len(self.known) > 200_000:
                    self.known.clear()
                self.known[written] = got
        return got

    def _apart(self, m: re.Match) -> str:
        letters = m[0][::2]
        if not any(c.isalpha() for c in letters):
            return m[0]

        def places() -> Iterator[list[tuple[str, float]]]:
            gap = [("", 0.0), (" ", -2.0)]
            for k, c in enumerate(letters):
                if k:
                    yield gap
                yield [(x, 0.0) for x in LOOK_ALIKES.get(c, c if c.isalpha() else " ")]

        return viterbi(places(), self.model)

    def text(self, lower: str, kinds: int = 7) -> str:
        """``kinds``: as ``disguised`` gives them; what one step restores may need the next."""
        if kinds & 4:
            lower = _APART.sub(self._apart, lower)
        if kinds & 6:
            lower = _LEET.sub(lambda m: self.word(m[0]), lower)
        return _DRAWN.sub(lambda m: self.word(m[0]), lower)


_BYTE_LETTER = np.zeros(256, bool)
_BYTE_LETTER[[*range(97, 123), *range(128, 256)]] = True
_BYTE_SYMBOL = np.zeros(256, bool)
_BYTE_SYMBOL[[ord(c) for c in LOOK_ALIKES if ord(c) < 128]] = True
_BYTE_MARK = np.zeros(256, bool)
_BYTE_MARK[[ord(c) for c in " ._-*"]] = True
_BYTE_WORD = _BYTE_LETTER | _BYTE_SYMBOL
_BYTE_WORD[[*range(48, 58), ord("_")]] = True


def disguised(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """What each lower-case text may hold: drawn-out words (1), symbols for letters (2), letters set apart (4).

    A cheap test that misses none.
    """
    n = len(offsets) - 1
    out = np.zeros(n, np.int8)
    if len(data) < 2:
        return out

    def note(at: np.ndarray, kind: int) -> None:
        out[np.unique(np.searchsorted(offsets, at, side="right") - 1)] |= kind

    letter, symbol = _BYTE_LETTER[data], _BYTE_SYMBOL[data]
    drawn = np.zeros(len(data), bool)
    drawn[2:] = letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    if len(data) >= 6:  # a letter of two bytes, three times
        drawn[5:] |= ((data[5:] & 0xC0) == 0x80) & (data[5:] == data[3:-2]) & (data[3:-2] == data[1:-4])
    note(np.flatnonzero(drawn), 1)
    # a symbol beside a letter, or the one symbol of several bytes
    note(np.flatnonzero((symbol[:-1] & letter[1:]) | (letter[:-1] & symbol[1:])), 2)
    note(np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x82) & (data[2:] == 0xAC)), 2)
    # three single characters with one mark between each two
    first = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
    if len(first) >= 5:
        char = data[first]
        inside, mark = _BYTE_WORD[char], _BYTE_MARK[char]
        apart = ~inside | mark
        alone = inside.copy()
        alone[1:] &= apart[:-1]
        alone[:-1] &= apart[1:]
        note(first[4:][alone[:-4] & mark[1:-3] & alone[2:-2] & mark[3:-1] & alone[4:]], 4)
    return out


def restore(texts: pa.Array, restorer: Restorer) -> pa.Array:
    """Lower-case texts with disguised words restored; null counts as empty."""
    lower = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    kinds = disguised(*C.utf8(lower))
    some = np.flatnonzero(kinds)
    if not len(some):
        return lower
    fixed = [restorer.text(x, k) for x, k in zip(lower.take(pa.array(some)).to_pylist(), kinds[some].tolist())]
    return pc.replace_with_mask(lower, pa.array(kinds > 0), pa.array(fixed, pa.large_string()))


# --- features and score --------------------------------------------------------------------

def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts as (first, last + 1, feature buckets, their text within the run)."""
    data, offsets = C.utf8(texts)
    for a, b in C.chunks(offsets):
        part, own = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        start, end, doc = C.spans(part, own, _BYTE_LETTER[part])
        keep = end - start >= 3
        start, end, doc = start[keep], end[keep], doc[keep]
        h = [C.run_hashes(part, start, end)]
        d = [doc]
        for k in PREFIXES:
            longer = end - start > k
            h.append(C.mix(C.run_hashes(part, start[longer], start[longer] + k) + np.uint64(k)))
            d.append(doc[longer])
        yield a, b, (np.concatenate(h) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(d)


@dataclass
class Model:
    counts: np.ndarray             # of trigrams
    weights: dict[int, float]      # feature -> probability that a text with it is toxic
    rest: float                    # rate of toxic texts without a feature

    def scorer(self):
        restorer = Restorer(CharacterModel(self.counts))
        weight = np.zeros(BUCKETS, np.float32)
        for k, p in self.weights.items():
            weight[k] = -np.log1p(-p)

        def score(texts: pa.Array) -> np.ndarray:
            texts = restore(texts, restorer)
            out = np.full(len(texts), self.rest)
            for a, b, f, d in features(texts):
                hit = np.flatnonzero(weight[f])
                if len(hit):
                    pair = np.unique(d[hit] * BUCKETS + f[hit])  # a feature counts once in a text
                    none = np.bincount(pair // BUCKETS, weights=weight[pair % BUCKETS], minlength=b - a)
                    out[a:b] = np.where(none > 0, 1 - np.exp(-none) * (1 - self.rest), self.rest)
            return out

        return score


def _counted(docs: DataFrame, text_col: str) -> np.ndarray:
    """Trigram counts over all documents: one row per bucket at most reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(TRIGRAMS, np.int64)
        for b in batches:
            for part in C.pieces(b, 0):
                n += count_trigrams(part.column(0))
        k = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(n[k])], ["k", "n"])

    got = (docs.select(C.col(text_col).cast("string").alias("text")).mapInArrow(run, "k int, n long")
           .groupBy("k").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(TRIGRAMS, np.int64)
    out[got["k"]] = got["n"]
    return out


def sample_labels(labels: DataFrame, label_col: str, size: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of at most ``size`` labelled rows that are not held out, chosen by a hash of the id."""
    one = (labels.select(C.col(id_col).cast("long").alias("doc_id"), C.col(label_col).cast("int").alias("label"))
           .where("doc_id is not null and label is not null").where(~C.held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("label").alias("label")))
    return C.hash_sample(one, size, "doc_id")


def enough(rate: float, chance: float = 0.01) -> float:
    """In how many toxic texts, and no other, a feature must be found so that not even one of all ``BUCKETS``
    features is likely (``chance``) to be there by accident, where ``rate`` of the texts are toxic."""
    if rate <= 0 or rate >= 1:
        return float("inf")
    return max(MIN_TEXTS, math.log(BUCKETS / chance) / -math.log(rate))


def pick(texts: list[np.ndarray], toxic: np.ndarray, candidates: np.ndarray) -> tuple[dict[int, float], float]:
    """Greedy picks among candidate features, and all that are found in toxic texts alone, in enough that differ.

    texts: the distinct candidate numbers in each text.
    """
    n = len(candidates)
    flat = np.concatenate([np.zeros(0, np.int64), *texts]).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    order = np.argsort(flat, kind="stable")
    by_feature = owner[order]
    edge = np.searchsorted(flat[order], np.arange(n + 1))
    negative = np.bincount(flat[~toxic[owner]], minlength=n)
    left = np.bincount(flat[toxic[owner]], minlength=n)
    open_ = toxic.copy()
    weights = {}
    while n:
        seen = left + negative
        rate = left / np.maximum(seen, 1)
        lower = rate - np.sqrt((rate * (1 - rate) + 0.25 / np.maximum(seen, 1)) / np.maximum(seen, 1))
        # a clean text that a pick would accuse weighs as much as MISTAKE toxic ones that it finds
        fit = np.where((left >= MIN_TEXTS) & (lower >= MIN_RATE), left - MISTAKE * negative, -np.inf)
        best = int(np.argmax(fit))
        if not fit[best] > 0:
            break
        weights[int(candidates[best])] = float((left[best] + 0.5) / (seen[best] + 1))
        own = by_feature[edge[best]:edge[best + 1]]
        own = own[open_[own]]
        open_[own] = False
        left = left - np.bincount(np.concatenate([np.zeros(0, np.int64), *(texts[t] for t in own)]).astype(np.int64),
                                  minlength=n)
    # What others accompany tells as much when it stands alone.  Copies of one text are no further evidence:
    # texts with the same picks count once.
    picked = np.zeros(n, bool)
    picked[[int(np.searchsorted(candidates, k)) for k in weights]] = True
    kind = np.unique([t[picked[t]].tobytes() for t in texts], return_inverse=True)[1] if texts else owner
    least = enough(float(toxic.mean()) if len(toxic) else 0.0)
    for c in np.flatnonzero((negative == 0) & ~picked):
        own = by_feature[edge[c]:edge[c + 1]]
        if len(own) >= least and len(np.unique(kind[own])) >= least:
            weights[int(candidates[c])] = float((len(own) + 0.5) / (len(own) + 1))
    covered = np.zeros(len(texts), bool)
    for k in weights:
        c = int(np.searchsorted(candidates, k))
        covered[by_feature[edge[c]:edge[c + 1]]] = True
    rest = float((toxic & ~covered).sum() + 0.5) / ((~covered).sum() + 1) if len(texts) else 0.0
    return weights, min(rest, 0.5)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text") -> Model:
    """Character model from all documents; features from at most ``sample`` labelled ones."""
    spark = docs.sparkSession
    counts = _counted(docs, text_col)
    chosen = sample_labels(labels, label_col, sample)
    # at most ``sample`` rows of two numbers
    rows = (docs.select(C.col(id_col).cast("long").alias("doc_id"), C.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text"))
    kept = spark.sparkContext.broadcast(counts)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(CharacterModel(kept.value))
        for b in (part for whole in batches for part in C.pieces(whole, 2)):
            for a, z, f, d in features(restore(b.column(2), restorer)):
                pair = np.unique(d * BUCKETS + f)
                edge = np.searchsorted(pair, np.arange(z - a + 1) * BUCKETS)
                each = [(pair[x:y] % BUCKETS).astype("<i4").tobytes() for x, y in zip(edge, edge[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), b.column(1).slice(a, z - a), pa.array(each, pa.binary())],
                    ["doc_id", "label", "f"])

    path = C.work_dir(spark, "toxicity")
    seen = C.store(rows.mapInArrow(distinct, "doc_id long, label int, f binary"), path)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, BUCKETS), np.int32)
        for b in batches:
            for label, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n[1 if label else 0, np.frombuffer(f, "<i4")] += 1
        k = np.flatnonzero(n[1])
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(n[1, k]), pa.array(n[0, k])], ["k", "p", "n"])

    def negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.asarray(wanted.value)
        for b in batches:
            each = [np.flatnonzero(np.isin(ids, np.frombuffer(f, "<i4"), assume_unique=True)).astype("<i4").tobytes()
                    for f in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(each, pa.binary())], ["label", "f"])

    few = (seen.select("label", "f").coalesce(4).mapInArrow(sums, "k int, p int, n int").groupBy("k")
           .agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
           .where((F.col("p") >= MIN_TEXTS) & (F.col("p") >= MIN_RATE * (F.col("p") + F.col("n"))))
           .orderBy(F.desc("p"), "k").limit(MAX_FEATURES).toPandas())
    candidates = np.sort(few["k"].to_numpy(np.int64))
    wanted = spark.sparkContext.broadcast(candidates)
    texts = seen.select("label", "f").mapInArrow(negatives, "label int, f binary").collect()
    C.discard(spark, path)
    weights, rest = pick([np.frombuffer(r["f"], "<i4") for r in texts],
                         np.array([bool(r["label"]) for r in texts], bool), candidates)
    return Model(counts, weights, rest)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
           with_text: bool = True) -> DataFrame:
    """doc_id, score and, if wanted, the restored text of every row."""
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = kept.value.scorer()
        restorer = Restorer(CharacterModel(kept.value.counts))
        for b in (part for whole in batches for part in C.pieces(whole, 1)):
            out = [b.column(0), pa.array(score(b.column(1)), pa.float64())]
            if with_text:
                out.append(restore(b.column(1), restorer).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "score", "restored"][:len(out)])

    picked = docs.select(C.col(id_col).cast("long").alias("doc_id"), C.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, score double" + (", restored string" if with_text else ""))


def below(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is below ``threshold``."""
    kept = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = kept.value.scorer()
        for b in (part for whole in batches for part in C.pieces(whole, column)):
            yield b.filter(pa.array(score(b.column(column)) < threshold))

    return C.filtered(docs, run)


def result(rows: DataFrame, threshold: float) -> DataFrame:
    """The columns of a classifier's query."""
    flag: Column = (F.col("score") >= threshold).cast("int")
    return rows.select("doc_id", C.held_out(F.col("doc_id")).alias("held_out"), "score", flag.alias("predicted"))
