import random
from datetime import date

from ranklake.operators.dedup import cap_per_key, dedup_best
from ranklake.operators.increment import increment, take_until_seen

IDS = "puuid string, pos long, match_id string"


def loop(ids, known, cap):
    kept, seen = [], set(known)
    for item in ids:
        if item in seen:
            break
        seen.add(item)
        kept.append(item)
    return kept[:cap]


def test_take_until_seen_equals_a_loop_on_random_lists(spark):
    rnd = random.Random(7)
    lists, known, want = [], [], []
    for player in range(60):
        ids = [f"m{rnd.randint(0, 60)}" for _ in range(rnd.randint(0, 40))]
        old = {f"m{rnd.randint(0, 60)}" for _ in range(rnd.randint(0, 2))}
        lists += [(f"p{player}", pos, item) for pos, item in enumerate(ids)]
        known += [(f"p{player}", item) for item in old]
        want += [(f"p{player}", pos, item) for pos, item in enumerate(loop(ids, old, 12))]
    rnd.shuffle(lists)
    got = take_until_seen(
        spark.createDataFrame(lists, IDS), "puuid", "pos", "match_id",
        spark.createDataFrame(known, "puuid string, match_id string"), cap=12,
    )
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_cap_edges(spark):
    sizes = {"a": 0, "b": 999, "c": 1000, "d": 1001}
    ids = spark.createDataFrame([(k, i, f"m{i}") for k, n in sizes.items() for i in range(n)], IDS)
    counts = {r[0]: r[1] for r in cap_per_key(ids, ["puuid"], ["pos"], 1000).groupBy("puuid").count().collect()}
    assert counts == {"b": 999, "c": 1000, "d": 1000}


def test_known_id_at_edges_of_the_cap(spark):
    ids, known = [], []
    for at in (0, 1, 100, 999, 1000, 1200):
        key = f"p{at}"
        ids += [(key, i, f"m{i}") for i in range(1300)]
        known.append((key, f"m{at}"))
    got = take_until_seen(
        spark.createDataFrame(ids, IDS), "puuid", "pos", "match_id",
        spark.createDataFrame(known, "puuid string, match_id string"),
    )
    counts = {r[0]: r[1] for r in got.groupBy("puuid").count().collect()}
    assert counts == {"p1": 1, "p100": 100, "p999": 999, "p1000": 1000, "p1200": 1000}


def test_increment_dispatch(spark, rows):
    day = 86_400_000
    start = 19_724 * day  # 2024-01-02
    ids = spark.createDataFrame(
        [
            ("new", 0, "a", 420, 5), ("new", 1, "a", 420, 5), ("new", 2, "b", 420, 5), ("new", 3, "k", 420, 5),
            ("old", 0, "a", 420, start + day), ("old", 1, "b", 420, start), ("old", 2, "c", 420, start - 1),
            ("old", 3, "k", 420, start), ("old", 4, "d", 420, start), ("old", 5, "e", 400, start),
            ("today", 0, "a", 420, start + 9 * day), ("gone", 0, "a", 420, start),
        ],
        IDS + ", queue int, game_start_timestamp long",
    )
    state = spark.createDataFrame(
        [("new", None), ("old", date(2024, 1, 2)), ("today", date(2024, 1, 5)), ("idle", None)],
        "puuid string, last_read date",
    )
    known = spark.createDataFrame([("new", "k"), ("old", "k")], "puuid string, match_id string")
    got = increment(ids, state, known, "2024-01-05")
    # A new player keeps repeats and known ids; an old one stops at the first known id.
    assert rows(got, "puuid", "match_id") == [
        ("new", "a"), ("new", "a"), ("new", "b"), ("new", "k"), ("old", "a"), ("old", "b"),
    ]


def test_cap_is_cut_on_the_map_side(spark):
    ids = spark.range(5000).selectExpr("cast(id as string) puuid", "id pos", "'m' match_id")
    plan = cap_per_key(ids, ["puuid"], ["pos"], 1000)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_dedup_prefers_the_best_tier_and_breaks_ties(spark, rows):
    ladder = spark.createDataFrame(
        [("p", "gold", 2), ("p", "Master", 3), ("p", "iron", 1), ("q", "", 1), ("q", "silver", 9),
         ("r", "unknown", 1), ("s", "gold", 2), ("s", "GOLD", 1), ("t", None, 4)],
        "puuid string, tier string, tie int",
    )
    got = rows(dedup_best(ladder, "puuid", ties=["tie"]))
    assert got == sorted(
        [("p", "Master", 3), ("q", "silver", 9), ("r", "unknown", 1), ("s", "GOLD", 1), ("t", None, 4)], key=repr
    )
