"""Reproducible pseudo-random values derived from row keys.

Every random choice hangs on ``md5(seed|key)``, so it does not change with
partitioning, retries or cluster size, and plain SQL can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DRAW_DIGITS = 13  # 52 bits: exact in a double and in a long


def order_key(seed: int, *cols: Column | str) -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def draw(key: Column) -> Column:
    """Uniform whole number in [0, 2^52) from a hash key."""
    return F.conv(F.substring(key, 1, DRAW_DIGITS), 16, 10).cast("long")


def uniform(key: Column) -> Column:
    """Uniform double in [0, 1) from a hash key."""
    return draw(key) / F.lit(float(16**DRAW_DIGITS))


def below(key: Column, share: float) -> Column:
    """True for about ``share`` of the keys."""
    return draw(key) < F.lit(int(share * 16**DRAW_DIGITS))
