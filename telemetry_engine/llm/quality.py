"""Quality of documents: supervised subword embeddings.

Features are the words of a text, pairs of neighbouring words (a word repeated
is one feature, whatever the word), and the character n-grams (3 to 5 bytes,
with marks where a word begins and ends), as written, hashed into ``BUCKETS``.
Each has a learned vector; a text is the mean of the vectors of all its
features, and a softmax layer gives its class.  Vectors and layer are learned
by stochastic gradient descent in numpy, on at most ``SAMPLE`` labelled rows
(``held_out`` ones never) of at most ``SAMPLE_BYTES`` of text, chosen by a hash
of the id.  What is held of a text are its distinct features, of which even the
longest has no more than ``BUCKETS``: it counts as ``LONG`` bytes at most, and
a row that does not fit leaves its place to the next ones.  To score a text, each feature adds one number: its vector's
product with the difference of the layer's two rows.

Null and empty texts have no features and get the layer's bias.  Without
labelled rows every score is 0.5.  Rows are scored one by one, so repeated
rows and null ids change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C
from telemetry_engine.llm.toxicity import sample_labels

BUCKETS = 1 << 18
NGRAMS = (3, 4, 5)
DIMENSIONS = 16
EPOCHS = 8
RATE = 0.5
SAMPLE = 3_000
SAMPLE_BYTES = 12 << 20
LONG = BUCKETS // 3  # bytes that can have BUCKETS distinct features: some three start at each

AGAIN = np.uint64(0xA6A16)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts as (first, last + 1, feature buckets, their text within the run), all occurrences."""
    data, offsets = C.utf8(texts)
    for a, b in C.chunks(offsets, 1 << 19):
        part, own = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        space = _SPACE[part]
        start, end, doc = C.spans(part, own, ~space)
        h, d = [C.run_hashes(part, start, end)], [doc]
        # pairs of words; a word and itself again is one feature, whatever the word
        a1, b1, near = h[0][:-1], h[0][1:], doc[1:] == doc[:-1]
        pair = np.where(a1 == b1, AGAIN, C.mix(a1 * np.uint64(0x9E3779B97F4A7C15) + b1))
        h.append(pair[near])
        d.append(doc[1:][near])
        # each word between two marks: one byte more on either side
        n = end - start + 2
        begin = np.concatenate([[0], np.cumsum(n)])
        marked = np.full(int(begin[-1]), 32, np.uint8)
        marked[_at(begin[:-1] + 1, end - start)] = part[_at(start, end - start)]
        owner = np.repeat(doc, n)
        word = np.repeat(np.arange(len(n)), n)
        code = marked.astype(np.uint64)
        for k in NGRAMS:
            if len(code) < k:
                continue
            g = np.zeros(len(code) - k + 1, np.uint64)
            for i in range(k):
                g = g * np.uint64(257) + code[i:len(code) - k + 1 + i]
            same = word[:len(g)] == word[k - 1:]
            h.append(C.mix(g[same] + np.uint64(k << 48)))
            d.append(owner[:len(g)][same])
        yield a, b, (np.concatenate(h) & np.uint64(BUCKETS - 1)).astype(np.int32), np.concatenate(d)


def _at(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = int(sizes.sum())
    return np.arange(total) + np.repeat(begin - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)


@dataclass
class Model:
    logits: np.ndarray  # of each feature, for label 1 against label 0
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, b, f, d in features(texts):
            n = np.bincount(d, minlength=b - a)
            out[a:b] = np.bincount(d, weights=self.logits[f], minlength=b - a) / np.maximum(n, 1)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -30, 30)))


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Model:
    """texts: (distinct features, share of the text's features that each is)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    steps, total = 0, max(1, EPOCHS * len(texts))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(texts)):
            f, share = texts[i]
            rate = RATE * (1 - steps / total)
            steps += 1
            hidden = share @ vectors[f]
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1  # the gradient of the loss by z
            back = p @ layer
            layer -= rate * np.outer(p, hidden)
            bias -= rate * 0.1 * p
            vectors[f] -= (rate * len(f) ** 0.5) * share[:, None] * back
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
          sample_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> Model:
    chosen = sample_labels(labels, label_col, sample, "doc_id")
    picked = docs.select(C.col(id_col).cast("long").alias("doc_id"), C.col(text_col).cast("string").alias("text"))
    # whole texts, in the order of the hash, each whose bytes still fit: at most ``sample`` ids come to the driver
    size = F.sum(F.least(F.octet_length(F.coalesce("text", F.lit(""))), F.lit(LONG))).alias("size")
    sizes = (picked.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(size)
             .select("doc_id", "label", "size", F.xxhash64("doc_id").alias("hash")).collect())
    fit_in, left = [], sample_bytes
    for r in sorted(sizes, key=lambda r: (r["hash"], r["doc_id"])):
        if r["size"] <= left:
            fit_in.append((r["doc_id"], r["label"]))
            left -= r["size"]
    fitting = docs.sparkSession.createDataFrame(fit_in, "doc_id long, label int")
    sized = picked.join(F.broadcast(fitting), "doc_id").select("label", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z, f, d in features(b.column(1)):
                if z - a == 1:  # a long text: a count of each bucket needs less than a sort
                    n = np.bincount(f, minlength=BUCKETS)
                    own = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(a, 1), pa.array([own.astype("<i4").tobytes()], pa.binary()),
                         pa.array([n[own].astype("<u4").tobytes()], pa.binary())], ["label", "ids", "n"])
                    continue
                pair, n = np.unique(d * np.int64(BUCKETS) + f, return_counts=True)
                edge = np.searchsorted(pair, np.arange(z - a + 1) * BUCKETS)
                ids = [(pair[x:y] % BUCKETS).astype("<i4").tobytes() for x, y in zip(edge, edge[1:])]
                num = [n[x:y].astype("<u4").tobytes() for x, y in zip(edge, edge[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), pa.array(ids, pa.binary()), pa.array(num, pa.binary())],
                    ["label", "ids", "n"])

    # the bounded sample's features, not its texts, come to the driver
    got = sized.mapInArrow(counted, "label int, ids binary, n binary").collect()
    texts, y = [], []
    for r in got:
        n = np.frombuffer(r["n"], "<u4").astype(np.float32)
        if len(n):
            texts.append((np.frombuffer(r["ids"], "<i4"), n / n.sum()))
            y.append(1 if r["label"] else 0)
    return fit(texts, np.array(y, np.int64))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1; higher: label 1 likelier) of every row."""
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in C.pieces(whole, 1)):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept.value.score(b.column(1)), pa.float64())],
                                             ["doc_id", "score"])

    picked = docs.select(C.col(id_col).cast("long").alias("doc_id"), C.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, score double")
