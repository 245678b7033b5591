import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C
from telemetry_engine.llm import quality, toxicity

BAD = ["grobnik", "zulfar", "vexmolt"]
LABELS = "doc_id long, toxic int, quality int, text string"


@pytest.fixture()
def labelled(words):
    """Texts of which a third hold one of ``BAD`` (label 1), half of those in disguise."""
    rng = random.Random(3)
    leet = {"o": "0", "i": "1", "e": "3", "a": "4"}
    rows, labels = [], []
    for k in range(360):
        w = words(rng.randint(20, 90), k).split()
        toxic = k % 3 == 0
        if toxic:
            word = rng.choice(BAD)
            style = k // 3 % 4
            if style == 1:
                word = "".join(leet.get(c, c) for c in word)
            elif style == 2:
                word = " ".join(word)
            elif style == 3:
                word = word.replace("r", "rrrr").replace("x", "xxx")
            w.insert(rng.randrange(len(w)), word)
        rows.append((k, " ".join(w)))
        labels.append((k, int(toxic), 1, "clash"))
    return rows, labels


def test_held_out_is_the_stated_rule(spark):
    got = spark.range(200).select("id", C.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in got)


def test_disguises_are_found_and_restored():
    texts = pa.array(["the idiot loses a stupid clown and a moron"] * 30 + ["plain words of a text"] * 30)
    r = toxicity.Restorer(toxicity.CharacterModel(toxicity.count_trigrams(texts)))
    for written, meant in [("an 1d10t", "an idiot"), ("$tup1d", "stupid"), ("m.o.r.o.n", "moron"),
                           ("a c l o w n", "a clown"), ("stuuuupid", "stupid"), ("cl0wn m0ron", "clown moron"),
                           ("nothing here, at 10:45!", "nothing here, at 10:45!"), ("", "")]:
        got = toxicity.restore(pa.array([written]), r).to_pylist()[0]
        assert got == meant, written
    assert toxicity.restore(pa.array([None, "ÉTÉ"]), r).to_pylist() == ["", "été"]


def test_no_gate_or_length_keeps_a_disguise():
    texts = pa.array(["the idiot will kill an ass and a worthless euro"] * 30 + ["plain words of a text, no!"] * 30)
    r = toxicity.Restorer(toxicity.CharacterModel(toxicity.count_trigrams(texts)))
    long = "the worthless idiot will kill an ass " * 20
    for written, meant in [("idi" + "o" * 40 + "t", "idiot"), ("idi" + "0" * 40 + "t", "idiot"), ("a$$", "ass"),
                           ("a55", "ass"), ("idi07", "idiot"), ("ki11", "kill"), ("w0rthl355", "worthless"),
                           ("€uro", "euro"), ("idi00t", "idiot"), ("no!", "no!"), ("1d10t!!!", "idiot!!!"),
                           (" ".join(long.replace(" ", "")), long.strip()), ("k1ll" * 2_000, "kill" * 2_000)]:
        got = toxicity.restore(pa.array([written]), r).to_pylist()[0]
        assert got == meant, written[:60]


def test_viterbi_takes_the_likeliest_path():
    model = toxicity.CharacterModel(toxicity.count_trigrams(pa.array(["bad dab cab"] * 50)))
    options = [[("b", 0.0), ("c", 0.0)], [("a", 0.0), ("d", 0.0)], [("d", 0.0), ("b", 0.0)]]

    def logp(s):
        a = b = 0
        total = 0.0
        for ch in s + " ":
            c = 0 if ch == " " else ord(ch)
            total += model.logp(a, b, c)
            a, b = (0, 0) if c == 0 else (b, c)
        return total

    every = [x + y + z for x, _ in options[0] for y, _ in options[1] for z, _ in options[2]]
    assert toxicity.viterbi(options, model) == max(every, key=logp)


def test_toxic_texts_are_told_apart(spark, documents, labelled):
    rows, labels = labelled
    docs = documents(rows + [(None, "a grobnik"), (900, None), (901, ""), (0, rows[0][1])])
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS))
    got = toxicity.result(toxicity.scored(docs, model), 0.7).collect()
    assert len(got) == len(rows) + 4
    truth = {i: t for i, t, *_ in labels}
    wrong = [r for r in got if r["doc_id"] in truth and r["held_out"] and r["predicted"] != truth[r["doc_id"]]]
    tested = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    assert len(tested) > 80 and len(wrong) <= 0.05 * len(tested)
    assert [r["predicted"] for r in got if r["doc_id"] is None] == [1]
    assert all(0 <= r["score"] <= 1 for r in got) and {r["predicted"] for r in got if r["doc_id"] in (900, 901)} == {0}
    kept = toxicity.below(docs, model, 0.7)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 for r in got if r["score"] < 0.7)


def test_words_beside_a_toxic_one_are_not_picked():
    rng = np.random.default_rng(0)
    candidates = np.arange(100, 130)
    texts, toxic = [], []
    for k in range(200):  # feature 0 makes a text toxic; 1 to 9 come with it in copies of one text
        own = set(rng.choice(np.arange(10, 30), 5, replace=False).tolist())
        if k < 60:
            own |= {0}
        if k < 30:
            own |= set(range(1, 10))
        texts.append(np.array(sorted(own)))
        toxic.append(k < 60)
    weights, rest = toxicity.pick(texts, np.array(toxic), candidates)
    assert set(weights) == {100} and weights[100] > 0.9 and rest < 0.01


def test_without_labels(spark, documents, words):
    docs = documents([(1, words(30, 1)), (2, None)])
    none = spark.createDataFrame([], LABELS)
    got = toxicity.scored(docs, toxicity.train(docs, none)).collect()
    assert [r["score"] for r in got] == [0.0, 0.0] or all(r["score"] <= 0.5 for r in got)
    assert [r["score"] for r in quality.scored(docs, quality.train(docs, none)).collect()] == [0.5, 0.5]
    empty = documents([])
    assert toxicity.scored(empty, toxicity.train(empty, none)).collect() == []
    assert quality.scored(empty, quality.train(empty, none)).collect() == []


def test_quality_of_held_out_texts(spark, documents, words):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(300):
        w = words(rng.randint(15, 120), k).split()
        low = k % 4 == 0
        if low:
            w = [x.upper() + "!!" for x in w] if k % 8 else [x + rng.choice(["###", "%%%"]) for x in w]
        rows.append((k, " ".join(w)))
        labels.append((k, 0, int(not low), "clash"))
    rows += [(1000, None), (1001, ""), (None, words(20, 1)), (1002, words(60_000, 2))]
    docs = documents(rows)
    model = quality.train(docs, spark.createDataFrame(labels, LABELS))
    got = toxicity.result(quality.scored(docs, model), 0.5).collect()
    truth = {i: q for i, _, q, _ in labels}
    tested = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in tested) >= 0.95 * len(tested)
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)


def test_a_huge_text_leaves_the_sample_to_others(spark, documents, words):
    first = [r["id"] for r in spark.range(2_000).where(~C.held_out(F.col("id"))).orderBy(F.xxhash64("id")).limit(1).collect()]
    rows, labels = [], []
    for k in [*first, *range(2_000, 2_150)]:
        low = k % 2
        text = words(60_000 if k in first else 30, k)
        rows.append((k, text.upper() if low else text))
        labels.append((k, 0, int(not low), "clash"))
    assert len(rows[0][1]) > 300_000
    docs = documents(rows)
    model = quality.train(docs, spark.createDataFrame(labels, LABELS), sample_bytes=300_000)
    got = toxicity.result(quality.scored(docs, model), 0.5).where("held_out").collect()
    truth = {i: q for i, _, q, _ in labels}
    assert len(got) > 30 and sum(r["predicted"] == truth[r["doc_id"]] for r in got) >= 0.95 * len(got)


def test_descent_fits_separable_texts():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 60)
    texts = [((rng.choice(500, 30, replace=False) + 400 * k).astype("<i4"), np.full(30, 1 / 30, np.float32)) for k in y]
    model = quality.fit(texts, y)
    score = [1 / (1 + np.exp(-(s @ model.logits[f] + model.bias))) for f, s in texts]
    assert ((np.array(score) >= 0.5) == y).mean() > 0.95


def test_subword_features_mark_word_ends():
    got = {k: set(f.tolist()) for k, (_, _, f, _) in enumerate(next(quality.features(pa.array([t]))) for t in ("ab", "xab", "ab ab"))}
    assert got[2] - got[0] == {int(quality.AGAIN) % quality.BUCKETS} and len(got[0] & got[1]) == 1  # only "ab>" is common


def test_a_word_that_others_accompany_is_kept():
    """Features 0 to 7 explain the toxic texts, two in each; 8 occurs beside many of them and never in a clean text; 9
    only in copies of one text; 10 in clean texts."""
    pairs = [(i, j) for i in range(8) for j in range(i)]
    texts = [np.array(sorted(p)) for p in pairs] + [np.array(sorted(p) + [8] * (min(p) < 2)) for p in pairs]
    texts += [np.array([0, 9])] * 30
    toxic = [True] * len(texts) + [False] * 1500
    texts += [np.array([10])] * 1500
    weights, rest = toxicity.pick(texts, np.array(toxic), np.arange(100, 111))
    assert weights[108] > 0.9 and 109 not in weights and 110 not in weights and rest < 0.1


def test_accidental_words_are_not_enough():
    assert toxicity.enough(0.1) > 8 and toxicity.enough(0.5) > 28
    assert toxicity.enough(0.0) == toxicity.enough(1.0) == float("inf")
