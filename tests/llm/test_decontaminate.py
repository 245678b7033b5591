import random

import pytest

from telemetry_engine.llm import decontaminate as D

ITEMS = "item_id long, text string, score string"


def brute(p, t, least):
    """Greedy string tiling by its definition: the longest unmarked common run, again and again."""
    mp, mt, tiles = [0] * len(p), [0] * len(t), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and not mp[i + k] and not mt[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return tiles
        mp[i:i + k] = mt[j:j + k] = [1] * k
        tiles.append((i, j, k))


def test_tiles_equal_the_definition_but_for_ties():
    rng = random.Random(1)
    other = 0
    for _ in range(600):
        v = rng.choice([3, 6, 30])
        p = [rng.randrange(v) for _ in range(rng.randint(1, 40))]
        t = [rng.randrange(v) for _ in range(rng.randint(0, 50))]
        if rng.random() < 0.6:
            a = rng.randrange(len(p))
            t[3:3] = p[a:a + 15]
        got, want = D.tiling(p, t, 3), brute(p, t, 3)
        assert all(p[i:i + k] == t[j:j + k] and k >= 3 for i, j, k in got)
        for side in (0, 1):  # no overlaps
            marks = [x + n for m in got for x, n in ((m[side], n) for n in range(m[2]))]
            assert len(marks) == len(set(marks))
        assert max((k for *_, k in got), default=0) == max((k for *_, k in want), default=0)
        other += sum(k for *_, k in got) != sum(k for *_, k in want)
    assert other < 12


def test_long_matches_restart_the_search():
    p = list(range(100, 190))
    assert D.tiling(p, [1, 2, *p, 3], 5) == [(0, 2, 90)]


def leaked(spark, documents, docs, items, **more):
    rows = D.leaks(documents(docs), spark.createDataFrame(items, ITEMS), **more).collect()
    return {(r["doc_id"], r["item_id"]): r for r in rows}


@pytest.fixture()
def items(words):
    return [(k, words(30, 1000 + k), None) for k in range(12)]


def test_whole_partial_and_reordered_passages(spark, documents, words, items):
    w = items[3][1].split()
    docs = [(1, words(200, 1)), (2, words(50, 2) + "\n" + items[0][1].upper().replace(" ", ",  ") + " " + words(50, 3)),
            (3, words(40, 4) + " " + " ".join(w[20:30] + words(5, 9).split() + w[10:20] + words(5, 8).split() + w[:10])),
            (4, " ".join(w[:12])), (5, " ".join(w[:15])), (6, None), (7, ""), (None, items[1][1]),
            (8, words(30_000, 5) + " " + items[2][1])]
    got = leaked(spark, documents, docs, items)
    assert set(got) == {(2, 0), (3, 3), (5, 3), (None, 1), (8, 2)}
    assert got[3, 3]["coverage"] == 1.0 and len(got[3, 3]["tiles"]) == 3
    assert got[5, 3]["coverage"] == 0.5 and got[5, 3]["matched_tokens"] == 15
    t = got[2, 0]["tiles"][0]
    assert (t["doc_start"], t["item_start"], t["length"]) == (50, 0, 30)


def test_blocks_of_the_benchmark_give_the_same(spark, documents, words, items):
    docs = [(k, words(20, k) + " " + items[k][1]) for k in range(12)]
    assert set(leaked(spark, documents, docs, items, block_bytes=500)) == {(k, k) for k in range(12)}


def test_short_items_repeated_rows_and_empty_tables(spark, documents, words):
    items = [(1, "one two", None), (2, "", None), (3, None, None), (4, "a b c d e f", None), (4, "a b c d e f", None)]
    docs = [(1, "zero one two three"), (2, "one x two"), (3, "A b, C d e f!"), (3, "A b, C d e f!")]
    rows = D.leaks(documents(docs), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(1, 1), (3, 4), (3, 4), (3, 4), (3, 4)]
    assert D.leaks(documents([]), spark.createDataFrame(items, ITEMS)).collect() == []
    assert D.leaks(documents(docs), spark.createDataFrame([], ITEMS)).collect() == []


def test_clean_keeps_columns_and_every_other_row(spark, documents, words, items):
    docs = documents([(k, words(30, k)) for k in range(20)] + [(20, items[5][1]), (None, None), (3, "")])
    kept = D.clean(docs, spark.createDataFrame(items, ITEMS))
    assert kept.schema == docs.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("doc_id is null or doc_id != 20").collect()))
