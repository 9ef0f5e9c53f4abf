"""The list of work items of a ladder run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklake.schemas import APEX_TIERS, DIVISIONS, TIERS


def work_grid(
    platforms: DataFrame,
    tiers: list[str] = TIERS,
    apex: list[str] = APEX_TIERS,
    divisions: list[str] = DIVISIONS,
) -> DataFrame:
    """Every platform with each apex tier (no division) and each tier and division.

    The tiers are settings, so each platform row is expanded in place; nothing is joined.
    """
    cells = [(tier, None) for tier in apex] + [(tier, division) for tier in tiers for division in divisions]
    column = F.array(
        *[F.struct(F.lit(t).alias("tier"), F.lit(d).cast("string").alias("division")) for t, d in cells]
    )
    return platforms.select("*", F.inline(column))
