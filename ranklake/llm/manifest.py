"""A Merkle manifest of a dataset: a hash tree over its rows, and for every row the proof that it is in it.

Rows are ranked within their part. Ranks are read in base 8, and the digits are grouped away one by
one: rows that differ only in the last digit become a struct of their hash and themselves, these structs
become the children of the next, and so on up to a block of 4096 rows. Blocks are dealt over the cluster once, and
all groupings of a block happen where it lies. The hashes of blocks are the rows of a smaller tree, until one is left
for each part, and the parts make one tree in the same way. Proofs come out of the nested structs by transform and
explode. A tree of any size is never one row: the path above a block meets the block in a grouping by its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklake.llm.common import partitions
from ranklake.operators.numbering import numbered
from ranklake.session import settle

#: Children of a node, as a power of two, and levels of a block.
_BITS, LEVELS = 3, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before: string, after: string>>"


def digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value that cannot be mistaken for another where values follow each other."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _index(level: int) -> Column:
    """The number of a node of ``level`` (0: a row of the tree) among all of its tree."""
    above = F.shiftleft("_block", _BITS * (LEVELS - level))
    for digit in range(level, LEVELS):
        above = above.bitwiseOR(F.shiftleft(f"_d{digit}", _BITS * (digit - level)))
    return above


def _blocks(nodes: DataFrame, by: list[str], payload: list[str]) -> DataFrame:
    """``nodes`` (``by``, ``_rank``, ``_hash``, ``payload``) as one row per block: its hash and its nested ``kids``."""
    digits = {f"_d{i}": F.shiftright("_rank", _BITS * i).bitwiseAND((1 << _BITS) - 1) for i in range(LEVELS)}
    rows = nodes.withColumns({"_block": F.shiftright("_rank", _BITS * LEVELS), **digits}).drop("_rank")
    rows = rows.repartition(partitions(nodes), *by, "_block")
    held = ["_hash", *payload]
    for level in range(LEVELS):
        above = [f"_d{i}" for i in range(level + 1, LEVELS)]
        kids = F.array_sort(F.collect_list(F.struct(f"_d{level}", *held)))
        rows = rows.groupBy(*by, "_block", *above).agg(kids.alias("kids"))
        # The only node of a level is the top of its tree: there is nothing to hash it with.
        lone = (_index(level + 1) == 0) & (F.size("kids") == 1)
        together = digest(F.array_join(F.transform("kids", lambda kid: kid["_hash"]), ""))
        rows = rows.withColumn("_hash", F.when(lone, F.element_at("kids", 1)["_hash"]).otherwise(together))
        held = ["_hash", "kids"]
    return rows


def _opened(blocks: DataFrame, kept: list[str], payload: list[str]) -> DataFrame:
    """The rows below ``blocks`` with ``_rank`` and their ``path``, the step next to the row first. ``kept``: other columns."""
    rows = blocks.drop("_hash")
    for level in reversed(range(LEVELS)):
        digit, below = f"_d{level}", ["_hash", *payload] if level == 0 else ["kids"]
        lone = (_index(level + 1) == 0) & (F.size("kids") == 1)

        def step(kid: Column, at: Column) -> Column:
            def hashes(start: Column, length: Column) -> Column:
                return F.array_join(F.transform(F.slice("kids", start, length), lambda other: other["_hash"]), "")

            beside = F.struct(hashes(F.lit(1), at).alias("before"), hashes(at + 2, F.size("kids")).alias("after"))
            return F.struct(kid[digit].alias(digit), beside.alias("_step"), *[kid[c].alias(c) for c in below])

        known = [f"_d{i}" for i in range(level + 1, LEVELS)]
        told = rows.select(*kept, "_block", *known, "path", lone.alias("_lone"), F.inline(F.transform("kids", step)))
        longer = F.when(F.col("_lone"), F.col("path")).otherwise(F.concat(F.array("_step"), F.col("path")))
        rows = told.select(*kept, "_block", *known, digit, longer.alias("path"), *below)
    return rows.withColumn("_rank", _index(0)).drop("_block", *[f"_d{i}" for i in range(LEVELS)])


def _tiers(nodes: DataFrame, by: list[str], payload: list[str]) -> list[DataFrame]:
    """Blocks of the rows, blocks of these blocks, and so on, until each tree is within one block."""
    tiers = []
    while True:
        tiers.append(settle(_blocks(nodes, by, payload), "manifest-blocks"))
        if not tiers[-1].agg(F.max("_block")).first()[0]:
            return tiers
        nodes, payload = tiers[-1].select(*by, F.col("_block").alias("_rank"), "_hash"), []


def _met(blocks: DataFrame, above: DataFrame, by: list[str], kept: list[str]) -> DataFrame:
    """``blocks``, each with the columns of its row ``above``: both have one row for each block."""
    from_above = ["path", *kept]
    types = {f.name: f.dataType for f in [*blocks.schema, *above.schema]}
    filled = blocks.withColumns({c: F.lit(None).cast(types[c]) for c in from_above})
    other = above.withColumns({c: F.lit(None).cast(types[c]) for c in ("kids", "_hash")})
    first = [F.first(c, ignorenulls=True).alias(c) for c in ("kids", "_hash", *from_above)]
    return filled.unionByName(other).groupBy(*by, "_block").agg(*first)


def _paths(tiers: list[DataFrame], above: DataFrame, by: list[str], kept: list[str], payload: list[str]) -> DataFrame:
    """The rows of the lowest tier with their paths to the top. ``above`` has the paths and ``kept`` columns of the tops."""
    for number, tier in reversed(list(enumerate(tiers))):
        opened = _opened(_met(tier, above, by, kept), [*by, *kept], payload if number == 0 else [])
        above = opened.select(*by, F.col("_rank").alias("_block"), "path", *kept) if number else opened
    return above


def manifest(
    docs: DataFrame,
    part: str = "lang",
    order: str = "doc_id",
    fields: tuple[str, ...] = FIELDS,
    claimed: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``order, leaf, claimed_leaf, subroot, root, path``.

    ``leaf`` is the hash of ``fields``. ``path`` has a step for each level of the trees: the hashes ``before`` and ``after``
    the node in its run of up to eight, from the row up to ``subroot``, the top of its part, and on to ``root``.
    ``claimed`` gives other values for some fields; ``claimed_leaf`` is the hash of these, null where nothing differs.

    Rows stand in the order of ``order``, null first; rows that repeat a value stand in the order of their hashes. Null is
    a part like any other, the first one; parts are ordered by their bytes. A null field is hashed as ``-``. An empty table
    gives no rows. Other columns are ignored.
    """
    leaf = digest(*[field(F.col(c)) for c in fields])
    other = digest(*[field((claimed or {}).get(c, F.col(c))) for c in fields])
    rows = docs.select(F.col(part).alias("_part"), F.col(order).alias("_key"), leaf.alias("_hash"), other.alias("_claimed"))
    rows = rows.withColumn("_claimed", F.when(F.col("_claimed") != F.col("_hash"), F.col("_claimed")))
    rows = numbered(settle(rows, "manifest-leaves"), ["_key", "_hash"], ["_part"], "_rank")
    by, payload = ["_part"], ["_key", "_claimed"]
    tiers = _tiers(rows, by, payload)

    subroots = tiers[-1].select("_part", "_hash")
    ranked = settle(numbered(subroots, ["_part"], name="_rank"), "manifest-parts")
    parts = _tiers(ranked, [], ["_part"])
    empty = F.array().cast(_PATH)
    top = parts[-1].select("_block", empty.alias("path"), F.col("_hash").alias("root"))
    tops = _paths(parts, top, [], ["root"], ["_part"])
    tops = tops.select("_part", F.lit(0).cast("long").alias("_block"), "path", F.col("_hash").alias("subroot"), "root")
    tops = settle(tops, "manifest-tops")
    found = _paths(tiers, tops, by, ["subroot", "root"], payload)
    return found.select(
        F.col("_key").alias(order), F.col("_hash").alias("leaf"), F.col("_claimed").alias("claimed_leaf"), "subroot", "root", "path"
    )


def proof_digest(path: str = "path") -> Column:
    """One hash over all hashes of a proof, level by level and left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))
