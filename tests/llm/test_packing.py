import zlib

import numpy as np
import pytest

from ranklake.llm import cutting, packing, tokens

TEXTS = [
    "", " ", "a  b", "a   b\n\n c", "x\n y", " lead", "trail ", "trail \n", "\nx", "it's they'll", "l'été n° 12 ½ ²",
    "a.\nB,c!? d e  f", "<|endoftext|> x", "日本 語", "a\tb \tc", "a\n\nb", " \nThen x", "x|y | z", "a\n\t\tb", "a  b",
    "a<|endoftext|>b", "a <|endoftext|><|endoftext|>  b", "<|endoftext|>", "The end.\nOf it, again. again, again", "word" * 30 + " " + "word" * 30,
]


@pytest.fixture(scope="module")
def plain():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(tokens.default_vocabulary())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizer(plain):
    path = tokens.default_vocabulary()
    for text in TEXTS * 2:
        assert np.frombuffer(tokens.token_bytes(text, path), "<u4").tolist() == plain(text), text


@pytest.mark.parametrize("n", [0, 1, 7, 400, 20000])
def test_plans_hold_every_piece_once(n):
    rng = np.random.default_rng(n)
    demand = np.bincount(rng.integers(1, 64, n), minlength=65)
    uses = cutting.solve(demand)
    held = np.zeros(65, int)
    for use in uses:
        assert sum(use.lengths) <= 64
        for x in use.lengths:
            held[x] += use.times
    assert (held == demand).all()
    if n > 300:
        assert sum(u.times for u in uses) <= 1.01 * (demand * np.arange(65)).sum() / 64 + 1


def test_columns_beat_longest_first():
    demand = np.zeros(31, int)
    demand[[14, 12, 11, 8, 7, 4]] = [50, 70, 90, 60, 40, 80]
    assert sum(u.times for u in cutting.solve(demand)) <= sum(u.times for u in cutting.fill(demand))
    value, counts = cutting.price(np.array([3, 5]), np.array([0.4, 0.7]), 11)
    assert (value, counts.tolist()) == (pytest.approx(1.5), [2, 1])


def test_pieces(spark, plain):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)]
    rows += [(50, "the and of " * 900, 1), (51, None, 1), (52, "one two " * 3000, 1), (52, "one two " * 3000, 1), (None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int")
    pieces = [r.asDict() for r in packing.pack(docs, capacity=64).collect()]
    wanted = {}
    for i, t, _ in rows:
        wanted.setdefault(i, []).append(plain(t) + [0])
    for i, copies in wanted.items():
        own = [p for p in pieces if p["doc_id"] == i]
        for start in {p["start"] for p in own}:
            assert sum(p["start"] == start for p in own) == len(copies)
        assert sum(p["length"] for p in own) == sum(map(len, copies))
        for p in own:
            ids = copies[0][p["start"] : p["start"] + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
            assert p["doc_tokens"] == len(copies[0])
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
