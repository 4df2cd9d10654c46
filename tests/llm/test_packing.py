from __future__ import annotations

import random

import numpy as np

from shelfcast.llm import packing


class Bytes:
    """Token ids that are the UTF-8 bytes."""

    largest = 255

    def __call__(self, texts):
        return [list(t.encode()) for t in texts]


def slow_best_fit(lengths, size):
    rooms, out = [], []
    for length in lengths:
        fits = [r for r in rooms if r >= length]
        out.append(len([r for r in rooms]) if not fits else None)
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(size - length)
    return sorted(rooms)


def test_rows_are_filled_as_by_a_plain_search():
    dice = random.Random(4)
    for size in (1, 7, 64, 100):
        lengths = sorted((dice.randrange(1, size + 1) for _ in range(300)), reverse=True)
        places = packing.best_fit(lengths, size)
        used = np.bincount(places, weights=lengths).astype(int)
        assert sorted(size - used) == slow_best_fit(lengths, size)
        assert (used <= size).all()


def unpack(rows, size, end):
    parts = {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u2")
        cuts = np.array(r.cu_seqlens)
        assert len(ids) == size and (ids[cuts[-1] :] == end).all() and cuts[0] == 0
        places = packing.positions(np.array(r.starts), cuts)
        for i, (doc, part, start) in enumerate(zip(r.doc_ids, r.parts, r.starts)):
            a, b = cuts[i], cuts[i + 1]
            assert places[a:b].tolist() == list(range(start, start + b - a))
            parts.setdefault((doc, part), []).append((start, ids[a:b].tolist()))
    return parts


def test_everything_comes_back(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_IDS", 2000)
    dice = random.Random(9)
    texts = ["x" * dice.choice([1, 5, 30, 31, 32, 33, 63, 64, 65, 700]) + str(i) for i in range(150)]
    texts += [None, "", "é" * 9000]
    frame = spark.createDataFrame([(i, t, "row") for i, t in enumerate(texts)], "doc_id long, text string, row string")
    packed = packing.pack(frame.repartition(4), Bytes(), end=300, row=64)
    rows = packed.collect()
    assert len({r.bucket for r in rows}) > 3
    parts = unpack(rows, 64, 300)
    for i, t in enumerate(texts):
        own = sorted((k[1], v) for k, v in parts.items() if k[0] == i)
        assert [k for k, _ in own] == list(range(len(own))) and all(len(v) == 1 for _, v in own)
        assert sum((v[0][1] for _, v in own), []) == [*(t or "").encode(), 300]
        assert [v[0][0] for _, v in own] == [64 * k for k in range(len(own))]


def test_repeats_null_ids_and_empty_table(spark):
    frame = spark.createDataFrame([(None, "ab"), (1, "same"), (1, "same")], "doc_id long, text string")
    parts = unpack(packing.pack(frame, Bytes(), end=300, row=16).collect(), 16, 300)
    assert parts == {(None, 0): [(0, [97, 98, 300])], (1, 0): [(0, [*b"same", 300])] * 2}
    assert packing.pack(frame.where("false"), Bytes(), end=300).collect() == []


def test_rank_file_ids(spark):
    import tiktoken

    from shelfcast.llm.queries import END_OF_TEXT, TOKENIZERS

    encoder = packing.RankEncoder(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    coder = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    text = "Some words, and <|endoftext|> as words too."
    frame = spark.createDataFrame([(7, text)], "doc_id long, text string")
    parts = unpack(packing.pack(frame, encoder, END_OF_TEXT).collect(), packing.ROW, END_OF_TEXT)
    assert parts == {(7, 0): [(0, [*coder.encode_ordinary(text), END_OF_TEXT])]}


def test_files(spark, tmp_path):
    frame = spark.createDataFrame([(7, "abc")], "doc_id long, text string")
    packing.write_packed(packing.pack(frame, Bytes(), end=300, row=8, wide=True), str(tmp_path / "p"))
    row = spark.read.parquet(str(tmp_path / "p")).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == [97, 98, 99, 300, 300, 300, 300, 300]


def slow_merge(ranks, word):
    """Ids of one word: the adjacent pair of lowest rank is merged until none is left."""
    parts = [bytes([b]) for b in word]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_long_runs_of_white_space():
    import tiktoken

    from shelfcast.llm.queries import TOKENIZERS

    encoder = packing.RankEncoder(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", long_space=5)
    coder = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    dice = random.Random(3)
    for _ in range(300):
        text = "".join(dice.choice([" ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "a", "7", "'s", "é", "!"]) * dice.choice([1, 1, 2, 4, 5, 6, 9]) for _ in range(12))
        assert encoder([text]) == [coder.encode_ordinary(text)], text
    usual = packing.RankEncoder(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    text = "x" + " " * 1500 + "\ny"
    words = ["x", " " * 1500, "\n", "y"]
    assert usual([text])[0] == sum((slow_merge(usual.ranks, w.encode()) for w in words), [])


def test_very_long_texts_with_the_real_encoder(spark):
    from shelfcast.llm.queries import END_OF_TEXT, TOKENIZERS

    encoder = packing.RankEncoder(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    texts = [" " * 1_000_000 + "x", "\n" * 1_000_000, "a" * 300_000, "word " * 200_000, " \t" * 500_000 + "!" + " " * 1_000_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parts = unpack(packing.pack(frame, encoder, END_OF_TEXT).collect(), packing.ROW, END_OF_TEXT)
    back = {v: k for k, v in encoder.ranks.items()}
    for i, text in enumerate(texts):
        ids = sum((v[0][1] for _, v in sorted((k[1], v) for k, v in parts.items() if k[0] == i)), [])
        assert ids[-1] == END_OF_TEXT and b"".join(back[t] for t in ids[:-1]) == text.encode()


class Large(Bytes):
    def __call__(self, texts):
        return [[70_000] for _ in texts]


def test_ids_beyond_sixteen_bits(spark):
    import pytest

    frame = spark.createDataFrame([(7, "abc")], "doc_id long, text string")
    encoder = Large()
    with pytest.raises(Exception, match="does not fit"):
        packing.pack(frame, encoder, end=1, row=4).collect()  # it claims 255
    with pytest.raises(Exception, match="does not fit"):
        packing.pack(frame, encoder, end=1, row=4, wide=False).collect()
    encoder.largest = 70_000
    assert np.frombuffer(packing.pack(frame, encoder, end=1, row=4).first().ids, "<u4").tolist() == [70_000, 1, 1, 1]
    assert packing.width(object(), 5, None) == "<u4" and packing.width(Bytes(), 1 << 16, None) == "<u4"


def test_equal_rows_spread_over_the_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_IDS", 50_000)
    frame = spark.range(100_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'same' AS text")
    frame = frame.unionByName(spark.range(100_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "CAST(NULL AS STRING) AS text"))
    rows = packing.pack(frame, Bytes(), end=300, row=64).selectExpr("bucket", "size(doc_ids) AS n").groupBy("bucket").sum("n").collect()
    assert len(rows) == 12 and sum(r[1] for r in rows) == 200_000 and max(r[1] for r in rows) < 20_000
