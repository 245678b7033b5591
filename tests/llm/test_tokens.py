import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from telemetry_engine.llm import huffman, packing
from telemetry_engine.llm import tokens as T

public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def vocabulary():
    return T.read_vocabulary(public.path("byte_bpe_50k.json"))


def plain(encoder, texts):
    return [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


ODD = [" ", "\n", "\t", "  ", "a", "bé", "ñ", ".", ",", "'s", "12", "!", "…", " ", "\xa0", "日本", "😀", "×",
       "<|endoftext|>", "Word", "the"]


def test_pieces_give_the_ids_of_whole_texts(vocabulary, words):
    enc = T.Encoder(vocabulary)
    assert enc.by_piece
    rng = random.Random(4)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 15))) for _ in range(4000)] + [None, "", words(60_000)]
    ids, off = enc.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == plain(enc, texts)


def test_the_table_starts_anew_when_full(vocabulary, words, monkeypatch):
    monkeypatch.setattr(T, "KEPT_PIECES", 50)
    enc = T.Encoder(vocabulary)
    texts = [words(300, seed) for seed in range(12)]
    for t in texts:
        ids, _ = enc.encode(pa.array([t]))
        assert ids.tolist() == plain(enc, [t])[0]


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_tokenizers_encode_whole(name):
    enc = T.Encoder(T.read_vocabulary(public.path(name)))
    assert not enc.by_piece
    ids, off = enc.encode(pa.array(["Hello  World", None]))
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == plain(enc, ["Hello  World", None])


# --- Huffman -------------------------------------------------------------------------------

def test_lengths_are_huffmans_and_keep_the_limit():
    import heapq

    rng = np.random.default_rng(0)
    for n in (2, 3, 17, 250):
        counts = rng.integers(1, 10 ** 5, n) ** 2
        heap = [int(c) for c in counts]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            cost += both
            heapq.heappush(heap, both)
        assert (huffman.code_lengths(counts, 40) * counts).sum() == cost
        short = huffman.code_lengths(counts, max(1, int(np.ceil(np.log2(n)))))
        assert short.max() <= max(1, np.ceil(np.log2(n))) and sum(2.0 ** -int(x) for x in short) <= 1
    assert huffman.code_lengths(np.array([0, 9])).tolist() == [0, 1]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5), 2)


def test_coded_ids_round_trip():
    rng = np.random.default_rng(5)
    lengths = huffman.code_lengths(rng.integers(1, 10 ** 6, 3000) ** 2, 14)
    ids = rng.integers(0, 3000, 10_001)
    payload, lanes, _ = huffman.encode(ids, huffman.canonical(lengths), lengths)
    sizes = np.minimum(huffman.LANE, len(ids) - huffman.LANE * np.arange(len(lanes)))
    got = huffman.decode(np.frombuffer(payload, np.uint8), lanes, sizes, huffman.decode_table(lengths))
    assert (got == ids).all()


def test_store_round_trips_and_keeps_the_order(spark, documents, vocabulary, words, tmp):
    rows = [(k, words(k % 40, k)) for k in range(400, 0, -1)] + [(None, "no id"), (7, None), (7, ""), (9, words(80_000))]
    huffman.write_ids(documents(rows), f"{tmp}/s", vocabulary, end_id=0, shard_ids=20_000)
    assert spark.read.parquet(f"{tmp}/s/blocks").select("shard").distinct().count() > 3
    got = huffman.read_ids(spark, f"{tmp}/s").collect()
    enc = T.Encoder(vocabulary)
    expected = sorted(((-1 if i is None else i, tuple(x) + (0,)) for (i, _), x in zip(rows, plain(enc, [t for _, t in rows]))))
    read = sorted((-1 if r["doc_id"] is None else r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got)
    assert read == expected
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order)
    digests = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in huffman.read_digests(spark, f"{tmp}/s").collect()}
    assert digests == {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in got}


def test_empty_store(spark, documents, vocabulary, tmp):
    huffman.write_ids(documents([]), f"{tmp}/e", vocabulary)
    assert huffman.read_ids(spark, f"{tmp}/e").collect() == []


# --- packing -------------------------------------------------------------------------------

def test_differencing_is_near_equal_and_whole():
    assert sorted(s for s, _ in packing.differencing([8, 7, 6, 5, 4], 2)) == [14, 16]  # the textbook case
    rng = random.Random(6)
    sizes = [rng.randint(1, 512) for _ in range(900)]
    parts = packing.differencing(sizes, 120)
    assert sorted(i for _, items in parts for i in items) == list(range(900))
    assert all(s == sum(sizes[i] for i in items) for s, items in parts)
    sums = [s for s, _ in parts]
    assert max(sums) - min(sums) <= 0.02 * sum(sums) / 120
    assert packing.windows([], 10) == []


def test_window_count_rises_only_as_far_as_needed():
    for sizes in ([10, 10, 1], [6, 6, 6], [1] * 25, [10]):
        got = packing.windows(sizes, 10)
        assert sorted(i for w in got for i in w) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in w) <= 10 for w in got)
    assert len(packing.windows([6, 6, 6], 10)) == 3 and len(packing.windows([1] * 25, 10)) == 3


def test_alike_items_are_cut_to_fit():
    rng = random.Random(8)
    cases = [[300] * 2048, [400] * 2048, [500] * 700, [1025] * 90, [2048] * 5, [2047] * 40, [1], [2048, 1],
             [rng.choice([700, 701, 690]) for _ in range(500)], [rng.randint(1, 512) for _ in range(900)], [6] * 3]
    for sizes in cases:
        got = packing.pieces(sizes, 2048)
        fewest = -(-sum(sizes) // 2048)
        assert fewest <= len(got) <= fewest + fewest // packing.RISE + 1
        assert all(0 < sum(y - x for _, x, y in w) <= 2048 for w in got)
        spans = {}
        for i, x, y in (p for w in got for p in w):
            spans.setdefault(i, []).append((x, y))
        for i, n in enumerate(sizes):  # every item once, whole
            own = sorted(spans[i])
            assert own[0][0] == 0 and own[-1][1] == n and all(x < y for x, y in own)
            assert all(a[1] == b[0] for a, b in zip(own, own[1:]))
    assert packing.pieces([], 2048) == [] and len(packing.pieces([6, 6, 6], 10)) == 3
    assert sum(len(w) for w in packing.pieces([300] * 2048, 2048)) <= 2048 + 2 * 300  # a few cuts a window
    assert packing.cut_to_fit([[0, 1, 2]], [6, 6, 6], 10) == [[(1, 0, 4), (2, 0, 6)], [(1, 4, 6), (0, 0, 6)]]


def test_alike_documents_leave_little_padding(spark, documents, vocabulary):
    words = " ".join(["window"] * 299)
    got = packing.pack(documents([(k, words) for k in range(700)]).coalesce(1), vocabulary).collect()
    total = sum(r["length"] for r in got)
    assert len({r["sequence_id"] for r in got}) <= -(-total // 2048) * 65 // 64 + 1
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for own in by_doc.values():
        own.sort(key=lambda r: r["start"])
        assert [r["start"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own])[:-1])
        assert sum(r["length"] for r in own) == own[0]["doc_tokens"]
    assert len(by_doc) == 700 and len({b"".join(r["ids"] for r in own) for own in by_doc.values()}) == 1


def test_pieces_cover_every_document(documents, vocabulary, words):
    rows = [(k, words(k * 3 % 900, k)) for k in range(300)] + [(None, "x"), (5, None), (5, ""), (5, ""), (900, words(30_000))]
    got = packing.pack(documents(rows).repartition(3), vocabulary).collect()
    enc = T.Encoder(vocabulary)
    whole = sorted(tuple(x) + (1,) for x in plain(enc, [t for _, t in rows]))
    # pieces of a document, in order; repeated documents are told apart by their windows
    assert sum(r["length"] for r in got) == sum(map(len, whole))
    by_doc = {}
    for r in got:
        assert r["length"] == len(r["ids"]) // 4 and 0 < r["length"] <= 2048
        by_doc.setdefault(r["doc_id"], []).append(r)
    for (i, t), x in zip(rows, plain(enc, [t for _, t in rows])):
        if i not in (5, None):
            own = sorted(by_doc[i], key=lambda r: r["start"])
            assert [r["start"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own])[:-1])
            assert np.concatenate([np.frombuffer(r["ids"], "<u4") for r in own]).tolist() == x + [1]
            assert {r["doc_tokens"] for r in own} == {len(x) + 1}
    windows = {}
    for r in got:
        windows.setdefault(r["sequence_id"], []).append(r)
    for own in windows.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own])[:-1])
        assert sum(r["length"] for r in own) == own[0]["sequence_tokens"] <= 2048
    assert len(windows) <= sum(map(len, whole)) / 2048 * 1.05 + 3  # little padding


def test_packing_an_empty_table(documents, vocabulary):
    assert packing.pack(documents([]), vocabulary).collect() == []
