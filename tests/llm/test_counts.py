import random

import pytest

from ranklake.llm import counts, tokens

TEXTS = [
    None, "", " ", "a  b", "a   b\n\n c", "x\n y", " lead", "trail ", "trail \n", "\nx", "it's they'll", "l'été n° 12 ½ ²",
    "a.\nB,c!? d e  f", "<|endoftext|> x", "a<|endoftext|>b", "a <|endoftext|><|endoftext|>  b", "日本 語", "a\tb \tc", "a\n\nb",
    "a\x1c b", "é" * 900, "a " * 70_000, "word" * 3000 + " " + "word" * 30, "n  b c 　d", "\x00 \x00a", "<|endoftext|>",
]


@pytest.fixture(scope="module")
def plain():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(tokens.default_vocabulary())
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


def wanted(rows, plain, limit=512):
    found = [(i, len((t or "").encode()), plain(t), plain(t) > limit) for i, t, *_ in rows]
    return sorted(found, key=repr)


@pytest.mark.parametrize("block", [3, 8192])
def test_counts_are_those_of_the_tokenizer(spark, plain, monkeypatch, block):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcdeé.,'1 \n", k=rng.randint(1, 7))) for _ in range(300)]
    texts = TEXTS + [" ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 80]))) for _ in range(200)] + ["same text"] * 90
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "a b", "x", 1), (7, "twice", "x", 1), (7, "twice", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, n_tokens int").repartition(3)
    # Workers see their own copy of the module, so the size of a block travels in the function.
    monkeypatch.setattr(counts._Block.full, "__defaults__", (block,))
    found = sorted((tuple(r) for r in counts.count_tokens(docs, limit=20).collect()), key=repr)
    assert found == wanted(rows, plain, 20)


def test_whole_blocks_without_spark(plain):
    path = tokens.default_vocabulary()
    import pyarrow as pa

    block = counts._Block(path, 0, pa.int64())
    for i, t in enumerate(TEXTS):
        block.add(i, t or "")
    head, *rest = [b.to_pylist()[0] for b in block.close(7)]
    assert head["ids"] == list(range(len(TEXTS)))
    names = [n for r in rest for n in r["names"]]
    assert len(names) == len(set(names))


def test_other_vocabularies(spark):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    t = tokenizers.Tokenizer.from_file(path)
    rows = [(i, x) for i, x in enumerate(TEXTS[1:16])]
    found = counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path)
    assert {r.doc_id: r.n_tokens for r in found.collect()} == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in rows}
    with pytest.raises(ValueError):
        counts._tokenizer("some.model")


def test_empty_table_and_other_ids(spark, plain):
    assert counts.count_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    found = counts.count_tokens(spark.createDataFrame([("k", "a b c")], "doc_id string, text string")).collect()
    assert [tuple(r) for r in found] == [("k", 5, 3, False)]
