import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranklake.operators import chunks
from ranklake.operators.chunks import Limits, Passage, chunk_by_bytes


def loop(rows, threshold, per_file=0):
    """(group, place) -> file, one row after the other."""
    out, state = {}, {}
    for group, place, size in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        number, held, count = state.get(group, (0, 0, 0))
        out[(group, place)] = number
        held, count = held + (size or 0), count + 1
        if held >= threshold or (per_file and count >= per_file):
            number, held, count = number + 1, 0, 0
        state[group] = (number, held, count)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_a_range_is_a_function_of_what_is_open(seed):
    rng = np.random.default_rng(seed)
    limits = Limits(100, 9 if seed % 2 else chunks._NO_LIMIT)
    parts = [rng.choice([0, 1, 7, 30, 260], rng.integers(0, 40)) for _ in range(5)]
    whole = Passage.over(parts[0], limits)
    for part in parts[1:]:
        whole = whole.then(Passage.over(part, limits), limits)
    sizes = np.concatenate(parts)
    for held in range(0, 100, 9):
        for rows in range(0, 9, 4):
            closing = chunks.closing_rows(sizes, limits, held, rows)
            last = int(closing[-1]) + 1 if len(closing) else 0
            want = [len(closing), int(sizes[last:].sum()) + (0 if len(closing) else held), len(sizes) - last + (0 if len(closing) else rows)]
            assert [int(x) for x in whole.after(limits, held, rows)] == want


@pytest.mark.parametrize(("threshold", "per_file", "parts"), [(500, 0, 4), (500, 7, 40), (1, 0, 4), (10**9, 0, 40)])
def test_chunks_equal_a_loop(spark, threshold, per_file, parts):
    rng = random.Random(threshold + per_file)
    # One group with most rows, small ones, and one large record in a thousand.
    groups = ["big"] * 1500 + [None, "", "a"] * 40 + [f"g{i}" for i in range(30)]
    rows = [(g, i, 5000 if i % 1000 == 0 else rng.choice([None, 0, 1, 40, 90])) for i, g in enumerate(groups)]
    df = spark.createDataFrame(rows, "g string, i long, s int").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = chunk_by_bytes(df, ["g"], ["i"], threshold, F.col("s"), per_file)
        assert found.columns == ["g", "i", "s", "file_no"]
        assert {(r.g, r.i): r.file_no for r in found.collect()} == loop(rows, threshold, per_file)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_without_groups_and_without_rows(spark):
    df = spark.range(300).select("id", F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("t"))
    found = chunk_by_bytes(df, [], ["id"], 400)
    sizes = [(None, i, len(f'{{"id":{i},"t":"{"x" * (i % 50)}"}}')) for i in range(300)]
    assert {(None, r.id): r.file_no for r in found.collect()} == loop(sizes, 400)
    assert chunk_by_bytes(df.where("id < 0"), [], ["id"], 400).collect() == []
    with pytest.raises(ValueError):
        chunk_by_bytes(df, [], ["id"], 0)
