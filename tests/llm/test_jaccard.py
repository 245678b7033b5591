import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from telemetry_engine.llm import jaccard as J
from telemetry_engine.llm.components import components, starred


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """(links, class) of each row number."""
    sets = [shingle_set(t) for _, t in rows]
    links, part = Counter(), list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                part[max(a, b)] = min(a, b)
    return links, [find(i) for i in range(len(rows))]


def corpus(words):
    rng = random.Random(2)
    rows = []
    for k in range(40):  # near copies of one text, of different degrees
        w = words(120, 1).split()
        for _ in range(k % 9):
            w[rng.randrange(len(w))] = f"new{rng.random()}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, words(60, 50 + k // 3)) for k in range(30)]        # exact copies
    rows += [(200 + k, words(5 + k, 90 + k)) for k in range(40)]
    passage = words(55, 777)
    rows += [(300 + k, words(40, 300 + k) + " " + passage) for k in range(30)]  # a shared passage is no copy
    rows += [(400, "one two"), (401, "One  TWO"), (402, "two one"), (403, ""), (404, None), (405, " \n"), (406, "")]
    return rows


def compare(rows, got):
    links, parts = brute(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for n, (i, _) in enumerate(rows):
        assert by_id[i]["n_links"] == links[n], i
        assert by_id[i]["class_id"] == rows[parts[n]][0], i


@pytest.mark.parametrize("tile", [1024, 7])
def test_equals_brute_force(documents, words, tile):
    rows = corpus(words)
    compare(rows, J.near_duplicates(documents(rows), tile=tile).collect())


def test_one_of_each_class_stays(documents, words):
    rows = corpus(words)
    docs = documents(rows)
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    _, parts = brute(rows)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({rows[p][0] for p in parts})


def test_null_and_repeated_ids(documents, words):
    a, b = words(40, 1), words(40, 2)
    docs = documents([(None, a), (5, a), (None, b), (None, b), (7, a), (7, words(40, 3)), (8, words(40, 4)), (8, words(40, 4)),
                      (None, None), (None, None)])
    got = J.near_duplicates(docs).collect()
    assert len(got) == 10
    classes = defaultdict(list)
    for r in got:
        classes[r["class_id"]].append((r["doc_id"], r["n_links"]))
    assert sorted(map(str, classes[5])) == sorted(map(str, [(None, 2), (5, 2), (7, 2)]))
    assert classes[8] == [(8, 1), (8, 1)]
    texts = [r["text"] for r in J.one_of_each(docs).collect()]
    assert Counter(texts) == Counter([a, b, words(40, 3), words(40, 4), None, None])


def test_repeated_rows_bring_their_text_once(documents, words, monkeypatch):
    a = words(60, 1)
    rows = [(None, a)] * 300 + [(5, a + " more")] * 300 + [(7, words(60, 2))]
    stored, store = {}, J.C.store

    def counting(df, path):
        out = store(df, path)
        stored[path.rsplit("/", 1)[-1]] = out
        if path.endswith("/texts"):
            stored["n"] = out.count()
        return out

    monkeypatch.setattr(J.C, "store", counting)
    got = J.near_duplicates(documents(rows), tile=1).collect()
    assert len(got) == 601 and stored["n"] == 2
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in got} == {(None, 5, 599), (5, 5, 599), (7, 7, 0)}


def test_empty_table(documents):
    assert J.near_duplicates(documents([])).collect() == []
    assert J.one_of_each(documents([])).collect() == []


def test_very_long_text(documents, words):
    long = words(120_000, 5)
    docs = documents([(1, long), (2, long + " end"), (3, words(120_000, 6))])
    assert {r["doc_id"]: r["class_id"] for r in J.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_pruning_follows_the_posterior():
    plan = J.fewest_matches(0.8, 1e-6)
    assert [n for n, _ in plan] == list(range(16, 161, 16))
    for n, m in plan:  # by integrating the Beta posterior
        x = (np.arange(200_000) + 0.5) / 200_000
        for equal, dropped in ((m - 1, True), (m, False)):
            if equal >= 0:
                with np.errstate(divide="ignore"):
                    log = equal * np.log(x) + (n - equal) * np.log1p(-x)
                d = np.exp(log - log.max())
                assert (d[x >= 0.8].sum() / d.sum() < 1e-6) == dropped


def test_minhash_estimates_similarity(words):
    a = words(300, 1).split()
    texts = [" ".join(a), " ".join(a[:280] + words(20, 2).split()), words(300, 3)]
    sets = [h[x:y] for _, _, h, off in J.shingle_sets(pa.array(texts)) for x, y in zip(off, off[1:])]
    m = [J.minhash(s, np.array([0, len(s)]))[0] for s in sets]
    exact = len(np.intersect1d(sets[0], sets[1])) / len(np.union1d(sets[0], sets[1]))
    assert abs((m[0] == m[1]).mean() - exact) < 0.12
    assert (m[0] == m[2]).mean() < 0.05


def test_shingles_of_runs_and_whole_batches_agree(words):
    texts = [words(n, n) for n in (0, 1, 4, 5, 6, 300)] * 3
    one = [set(map(int, h)) for t in texts for _, _, h, _ in J.shingle_sets(pa.array([t]))]
    many = [set(map(int, h[x:y])) for _, _, h, off in J.shingle_sets(pa.array(texts)) for x, y in zip(off, off[1:])]
    assert one == many and [len(s) for s in many] == [len(shingle_set(t)) for t in texts]


def test_components_of_paths_and_stars(spark, tmp):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 130)] + [(7, 7), (None, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long"), f"{tmp}/c").collect()
    assert {r["node"]: r["component"] for r in got} == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 130)}}


def test_edges_stay_near_one_per_member(spark, tmp):
    """Members of a dense group with up to 16 heads each: the edges double with the group, one or so a member."""
    sizes = {}
    for m in (500, 1000, 2000):
        rng = random.Random(m)
        rows = [(100 + i, h) for i in range(m) for h in rng.sample(range(32), 16)]
        edges = starred(spark.createDataFrame(rows, "cls long, head long"), "cls", "head", f"{tmp}/{m}")
        sizes[m] = edges.count()
        got = {r["node"]: r["component"] for r in components(edges, f"{tmp}/c{m}").collect()}
        assert set(got.values()) == {0} and len(got) == m + 32
    assert all(n < m + 32 * 32 for m, n in sizes.items()) and sizes[2000] <= 2 * sizes[1000]


def test_components_of_paths_stars_and_loops(spark, tmp):
    path = [(i, i + 1) for i in range(1000, 1300)]
    star = [(5, 2000 + i) for i in range(200)] + [(2000 + i, 5) for i in range(50)]
    df = spark.createDataFrame(path + star + [(7, 7), (None, 3), (9, None), (30, 31), (31, 32), (32, 30)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(df, f"{tmp}/c").collect()}
    assert got == ({i: 1000 for i in range(1000, 1301)} | {2000 + i: 5 for i in range(200)} | {5: 5}
                   | {i: 30 for i in (30, 31, 32)})
    empty = spark.createDataFrame([], "a long, b long")
    assert components(empty, f"{tmp}/e").collect() == []
