"""Similarity join of texts by the Jaccard similarity of their word shingles, with Bayesian candidate pruning.

1. Every text becomes the set of its 5-word shingles (64-bit hashes of
   lower-cased words; ASCII white space separates words).  Rows with equal
   sets form a *class*, which later steps meet once; copies are never paired.
2. Classes get ``HASHES`` MinHash values.  ``BANDS`` bands of ``ROWS`` values
   each find candidates: members of one bucket are tied to the bucket's least
   member (a star, never all pairs), the ties of a class to several such heads
   become one tie and ties between heads, and components of those ties hold every
   pair that shares a band.  A pair at the threshold 0.8 shares none with a
   probability of (1 - 0.8**5)**32 = 3e-6, and less above.
3. Components are dealt out in square tiles of at most ``TILE`` x ``TILE``
   members.  Within a tile, pairs compare MinHash values ``STEP`` at a time and
   are dropped as soon as the posterior probability (uniform prior) that their
   similarity reaches the threshold falls below ``TOLERANCE``.
4. The rest is verified exactly on the shingle sets.  A tile returns, for each
   class, how many documents it links to, and a spanning forest of its links:
   never the pairs.  Components of the forests are the result's classes.

Texts of fewer than five words have one shingle of all their words.  Texts
without words (null, empty, blank) match nothing and stay alone.  Repeated
rows are copies of each other.  A row whose id is null takes part under a
number from its text, at least 2**62, which names a class only if no row of
the class has an id of its own; so do the rows of an id that occurs with
different texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C
from telemetry_engine.llm.components import components, starred

THRESHOLD = 0.8
SHINGLE = 5
ROWS, BANDS = 5, 32
HASHES = ROWS * BANDS
STEP = 16
TOLERANCE = 1e-6
TILE = 1024


# --- sets and MinHash ----------------------------------------------------------------------

def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts as (first, last + 1, distinct shingles text by text, their n + 1 offsets)."""
    data, offsets = C.utf8(pc.utf8_lower(texts))
    for a, b in C.chunks(offsets):
        own = offsets[a:b + 1] - offsets[a]
        word, doc = C.words(data[offsets[a]:offsets[b]], own)
        h, d = C.shingles(word, doc, b - a, size)
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h, d = h[new], d[new]
        yield a, b, h, np.searchsorted(d, np.arange(b - a + 1))


_rng = np.random.default_rng(20)
_MULT = _rng.integers(1, 1 << 63, HASHES, np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, np.uint64)


def minhash(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits) of consecutive non-empty sets: one row each."""
    out = np.empty((len(offsets) - 1, HASHES), np.uint32)
    at = offsets[:-1]
    for k in range(HASHES):
        v = ((h * _MULT[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(v, at)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x, y, h, off in shingle_sets(b.column("text")):
            n = np.diff(off)
            full = np.flatnonzero(n > 0)
            sums = np.zeros((2, y - x), np.uint64)
            values = [None] * (y - x)
            if len(full):
                at = off[:-1][full]
                sums[0, full] = np.add.reduceat(C.mix(h), at)
                sums[1, full] = np.bitwise_xor.reduceat(C.mix(h + np.uint64(0x51ED27)), at)
                # copies within the run share one sketch
                key, first, back = np.unique(sums[:, full], axis=1, return_index=True, return_inverse=True)
                lens = n[full][first]
                pick = np.concatenate([h[off[full[i]]:off[full[i] + 1]] for i in first])
                m = minhash(pick, np.concatenate([[0], np.cumsum(lens)]))
                for i, r in zip(full, np.ravel(back)):
                    values[i] = m[r].tobytes()
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).slice(x, y - x) for c in range(3)), pa.array(n, pa.int32()),
                 pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), pa.array(values, pa.binary())],
                ["doc_id", "rid", "text_key", "n_shingles", "k1", "k2", "minhash"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        m = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.zeros(m.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
        for r in range(ROWS):
            key = C.mix(key * np.uint64(0x9E3779B97F4A7C15) + m[:, :, r])
        cls = np.repeat(np.asarray(b.column(0)), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(cls)], ["bucket", "cls"])


# --- verification --------------------------------------------------------------------------

def fewest_matches(threshold: float, tolerance: float, hashes: int = HASHES, step: int = STEP) -> list[tuple[int, int]]:
    """(values compared, fewest equal ones to go on): below, P(similarity >= threshold) < tolerance.

    With a uniform prior, m equal values of n leave a Beta(m+1, n-m+1)
    posterior, whose mass above t is P(Binomial(n+1, t) <= m).
    """
    out = []
    for n in range(step, hashes + 1, step):
        mass, m = 0.0, 0
        while m <= n:
            mass += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if mass >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def linked_pairs(sets: list[np.ndarray], sketch: np.ndarray, side: np.ndarray, within: bool, threshold: float,
                 plan: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of similarity >= threshold: all pairs ``within``, else those of side 0 with side 1."""
    n = np.array([len(s) for s in sets], np.int64)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    out_i, out_j = [], []
    rows = max(1, 500_000 // max(1, len(left) if within else len(right)))
    for a in range(0, len(left), rows):
        i = left[a:a + rows]
        if within:
            i, j = [x.ravel() for x in np.meshgrid(i, left, indexing="ij")]
            i, j = i[i < j], j[i < j]
        else:
            i, j = [x.ravel() for x in np.meshgrid(i, right, indexing="ij")]
        # sizes alone rule out some pairs
        ok = np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9
        i, j = i[ok], j[ok]
        equal, done = np.zeros(len(i), np.int16), 0
        for upto, least in plan:
            equal += (sketch[i, done:upto] == sketch[j, done:upto]).sum(axis=1, dtype=np.int16)
            done = upto
            ok = equal >= least
            i, j, equal = i[ok], j[ok], equal[ok]
        out_i.append(i)
        out_j.append(j)
    i, j = np.concatenate(out_i or [left[:0]]), np.concatenate(out_j or [left[:0]])
    common = _common(sets, i, j)
    ok = common >= threshold * (n[i] + n[j] - common) - 1e-9
    return i[ok], j[ok]


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of pairs of sets."""
    if len(i) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    # many pairs of few sets: a product of 0/1 matrices over the shingles that two sets share, some columns at a time
    used = np.unique(np.concatenate([i, j]))
    place = np.zeros(len(sets), np.int64)
    place[used] = np.arange(len(used))
    owner = np.repeat(np.arange(len(used)), [len(sets[u]) for u in used])
    _, column, count = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    column = np.unique(column, return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(used), len(used)), np.float32)  # counts below 2**24 are exact
    width = 4096
    for c in range(0, int(column.max(initial=-1)) + 1, width):
        x, y = np.searchsorted(column, [c, c + width])
        m = np.zeros((len(used), width), np.float32)
        m[owner[x:y], column[x:y] - c] = 1
        total += m @ m.T
    return total[place[i], place[j]].astype(np.int64)


def _tile(cls: np.ndarray, docs: np.ndarray, side: np.ndarray, within: bool, sets: list[np.ndarray],
          sketch: np.ndarray, threshold: float, plan) -> pa.RecordBatch:
    i, j = linked_pairs(sets, sketch, side, within, threshold, plan)
    links = np.zeros(len(cls), np.int64)
    np.add.at(links, i, docs[j])
    np.add.at(links, j, docs[i])
    root = np.arange(len(cls))  # least number of each connected part
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            break
        root = low
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(cls[some]), pa.array(links[some]), pa.array(cls[root[some]])],
                                      ["cls", "links", "root"])


def _tiles(threshold: float, tolerance: float):
    plan = fewest_matches(threshold, tolerance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for b in batches:
            keys = list(zip(*(b.column(k).to_pylist() for k in range(3))))
            cut = [0] + [k for k in range(1, len(keys)) if keys[k] != keys[k - 1]] + [len(keys)]
            for x, y in zip(cut, cut[1:]):
                if x == y:
                    continue
                if keys[x] != key:
                    if held:
                        yield solve(key, held)
                    key, held = keys[x], []
                held.append(b.slice(x, y - x))
        if held:
            yield solve(key, held)

    def solve(key: tuple, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        t = t.take(np.argsort(t.column("cls").to_numpy(), kind="stable"))
        sets = [s for c in t.column("text").chunks for s in _sets(c)]
        sketch = np.frombuffer(b"".join(t.column("minhash").to_pylist()), np.uint32).reshape(-1, HASHES)
        cls, docs, side = (t.column(c).to_numpy() for c in ("cls", "n_docs", "side"))
        return _tile(cls, docs, side, key[1] == key[2], sets, sketch, threshold, plan)

    return run


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    for _, _, h, off in shingle_sets(texts):
        for a, b in zip(off, off[1:]):
            yield h[a:b]


# --- the join ------------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, tile: int = TILE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, rid (the id, or what stands for a null one), text_key (xxhash64 of its
    text), class_id (least id of its class), n_links (rows it is linked to), n_shingles.

    ``class_id`` names the connected component of links; a row without links
    is its own class.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = C.work_dir(spark, "jaccard")
    keys = _keys(docs, id_col, text_col)
    picked = docs.select(C.col(id_col).cast("long").alias("doc_id"), keys["jaccard_rid"].alias("rid"),
                         keys["jaccard_key"].alias("text_key"),
                         F.coalesce(C.col(text_col).cast("string"), F.lit("")).alias("text"))

    rows = C.store(picked.mapInArrow(_sketch, "doc_id long, rid long, text_key long, n_shingles int, k1 long, k2 long, "
                                              "minhash binary"), f"{path}/rows")
    rows = rows.withColumn("node", F.col("rid"))
    shared_ids = C.store(rows.groupBy("rid").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b"))
                         .where("a != b").select("rid", F.lit(True).alias("shared")), f"{path}/shared_ids")
    if not shared_ids.isEmpty():
        own = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text_key", "rid"), 2)
        rows = C.store(rows.join(shared_ids, "rid", "left").withColumn("node", F.when(F.col("shared"), own).otherwise(F.col("rid")))
                       .drop("shared"), f"{path}/own_rows")
    key = ["n_shingles", "k1", "k2"]
    classes = C.store(
        rows.where("n_shingles > 0").groupBy(*key)
        .agg(F.min(F.struct("node", "rid", "text_key")).alias("least"), F.count("*").alias("n_docs"),
             F.first("minhash").alias("minhash"))
        .select(*key, F.col("least.node").alias("cls"), F.col("least.rid").alias("rid"),
                F.col("least.text_key").alias("text_key"), "n_docs", "minhash"),
        f"{path}/classes")

    bands = classes.select("cls", "minhash").mapInArrow(_bands, "bucket long, cls long")
    heads = bands.groupBy("bucket").agg(F.min("cls").alias("head"), F.count("*").alias("n")).where("n > 1")
    stars = bands.join(heads.select("bucket", "head"), "bucket").where("cls != head")
    parts = components(starred(stars, "cls", "head", f"{path}/candidates"), f"{path}/candidates")

    # rows that repeat an id with its text would bring the text of their class once each
    again = not rows.groupBy("rid", "text_key").count().where("count > 1").isEmpty()
    once = picked.select("rid", "text_key", "text")
    linked = _verify(once.dropDuplicates(["rid", "text_key"]) if again else once, classes, parts, threshold, tolerance, tile,
                     path)
    groups = components(starred(linked, "cls", "root", f"{path}/links"), f"{path}/links")
    degree = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    found = C.store(
        classes.select(*key, "cls", "n_docs").join(degree, "cls", "left")
        .join(groups.withColumnRenamed("node", "cls"), "cls", "left")
        .select(*key, F.coalesce("component", "cls").alias("class_id"),
                (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links")),
        f"{path}/found")
    return (rows.drop("minhash").join(found, key, "left")
            .select("doc_id", "rid", "text_key", F.coalesce("class_id", "node").alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_shingles"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, tile: int = TILE,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of which one of each class stays: that of the least id.

    Texts without words all stay.
    """
    spark = docs.sparkSession
    found = C.store(near_duplicates(docs, threshold, tolerance, tile, id_col, text_col), C.work_dir(spark, "classes"))
    words = found.where("n_shingles > 0")
    keep = (words.groupBy("class_id").agg(F.min(F.struct("rid", "text_key")).alias("r")).select("r.*")
            .union(found.where("n_shingles = 0").select("rid", "text_key").distinct()))
    keys = _keys(docs, id_col, text_col)
    own = docs.select(F.struct(*[C.col(c) for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in keys.items()])
    named = [F.col("rid").alias("jaccard_rid"), F.col("text_key").alias("jaccard_key")]
    kept = own.join(keep.select(*named), list(keys), "left_semi")
    # rows that repeat an id with its text are told apart only here; usually there are none
    again = C.store(words.groupBy("rid", "text_key").count().where("count > 1").select(*named), C.work_dir(spark, "repeated"))
    if not again.isEmpty():
        few = (kept.join(again, list(keys), "left_semi").groupBy(*keys)
               .agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row", *keys))
        kept = kept.join(again, list(keys), "left_anti").unionByName(few)
    return kept.select("row.*")


def _keys(docs: DataFrame, id_col: str, text_col: str) -> dict:
    text_key = F.xxhash64(F.coalesce(C.col(text_col).cast("string"), F.lit("")))
    return {"jaccard_rid": F.coalesce(C.col(id_col).cast("long"), F.lit(1 << 62) + F.shiftrightunsigned(text_key, 2)),
            "jaccard_key": text_key}


def _verify(picked: DataFrame, classes: DataFrame, parts: DataFrame, threshold: float, tolerance: float, tile: int,
            path: str) -> DataFrame:
    """(cls, links, root) of every tile, written below ``path``.

    ``picked``: rid, text_key and text, each pair of the first two once.
    """
    sizes = parts.groupBy("component").agg(F.count("*").alias("m"))
    blocks = F.ceil(F.col("m") / F.lit(tile)).cast("int")
    member = (parts.join(sizes, "component")
              .select(F.col("node").alias("cls"), "component", blocks.alias("blocks"))
              .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")))
    member = C.store(member.join(classes.select("cls", "rid", "text_key", "n_docs", "minhash"), "cls"), f"{path}/members")
    # one text per class: that of its least row
    full = C.store(picked.join(member, ["rid", "text_key"]), f"{path}/texts")
    dealt = (full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("component", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                     F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
                     "cls", "n_docs", "minhash", "text"))
    run = _tiles(threshold, tolerance)
    n = int(picked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return C.store(dealt.repartition(n, "component", "p", "q").sortWithinPartitions("component", "p", "q")
                   .mapInArrow(run, "cls long, links long, root long"), f"{path}/tiles")
