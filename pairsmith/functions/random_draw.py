"""Seeded uniform numbers as column expressions.

A number depends on (seed, tag, row id, attempt) only, never on partitioning, task retries or
the order of rows, so a recomputed partition draws the same values again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LANES = 2  # 53-bit numbers per 128-bit digest


def digest(seed: int, tag: str, row_id: Column, block: Column | int = 0) -> Column:
    """Hex MD5 that holds the draws of attempts ``2 * block`` and ``2 * block + 1``."""
    block_text = block.cast("string") if isinstance(block, Column) else F.lit(str(block))
    return F.md5(F.concat(F.lit(f"{seed}:{tag}:"), row_id.cast("string"), F.lit(":"), block_text))


def lane(digest_hex: Column, number: Column | int) -> Column:
    """Draw ``number`` (0 or 1) of a digest, in [0, 1) with 53 bits."""
    start = number * 16 + 1
    hex14 = F.substring(digest_hex, start, 14)
    return F.shiftright(F.conv(hex14, 16, 10).cast("long"), 3).cast("double") / F.lit(float(1 << 53))


def uniform(seed: int, tag: str, row_id: Column, attempt: Column | int = 0) -> Column:
    if isinstance(attempt, Column):
        block = F.floor(attempt / LANES)
        return lane(digest(seed, tag, row_id, block), F.pmod(attempt, F.lit(LANES)).cast("int"))
    block, number = divmod(attempt, LANES)
    return lane(digest(seed, tag, row_id, block), number)
