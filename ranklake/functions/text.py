"""Text defaults and the rank of a tier."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ranklake.schemas import BLANK_TIER, TIER_RANKS, UNKNOWN_TIER_RANK


def _col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def or_default(col: str | Column, default) -> Column:
    """``default`` where the value is NULL, which is also what an absent JSON key reads as."""
    return F.coalesce(_col(col), F.lit(default))


def blank_to(col: str | Column, default: str) -> Column:
    """``default`` where the text is NULL or empty."""
    return F.coalesce(F.nullif(_col(col), F.lit("")), F.lit(default))


def tier_rank(col: str | Column, ranks: dict[str, int] = TIER_RANKS, blank: str = BLANK_TIER) -> Column:
    """Rank of a tier, 0 being best, in any letter case. Blank ranks as ``blank``, unknown last."""
    pairs = [F.lit(x) for name, rank in ranks.items() for x in (name, rank)]
    return F.coalesce(F.create_map(*pairs)[F.lower(blank_to(col, blank))], F.lit(UNKNOWN_TIER_RANK))


def key_text(col: str | Column) -> Column:
    """A key as text in which NULL is a value of its own, so that it groups and joins like any other."""
    return F.coalesce(F.concat(F.lit("="), _col(col).cast("string")), F.lit("NULL"))
