"""Deterministic uniforms.

Each random decision is a column: the md5 of (seed, salt, keys) read as a 48-bit integer. The value
depends on the row's own keys only, so a recomputed task, another partitioning or another engine
gives the same draw. One salt per decision keeps decisions independent of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

GRID = float(2**48)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def key_hash(*keys: Column | str) -> Column:
    return F.md5(F.concat_ws("|", *[as_column(k).cast("string") for k in keys]))


def decision(seed: int, salt: str | Column) -> Column:
    """The name of a decision: the same text whether the salt is given or comes with the row."""
    return F.lit(f"{seed}|{salt}") if isinstance(salt, str) else F.concat(F.lit(f"{seed}|"), salt)


def uniform(seed: int, salt: str, *keys: Column | str) -> Column:
    """A double in (0, 1), never 0 and never 1."""
    digest = key_hash(decision(seed, salt), *keys)
    high_bits = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
    return (high_bits + F.lit(0.5)) / F.lit(GRID)


def uniform_int(u: Column, low: Column | int, high: Column | int) -> Column:
    """Integer in [low, high], both ends included."""
    low = F.lit(low) if isinstance(low, int) else low
    high = F.lit(high) if isinstance(high, int) else high
    return (F.floor(u * (high - low + 1)) + low).cast("bigint")


def position_below(size: Column, seed: int, salt: str | Column, *keys: Column | str) -> Column:
    """Integer in [0, size), null where there is nothing to choose from: 60 hash bits times the size, less 60 bits.
    The product is taken in halves, so sizes up to 2**62 need no more than 64-bit integers and every position is
    reachable."""
    digest = key_hash(decision(seed, salt), *keys)
    high, low = (F.shiftright(F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint"), 2) for start in (1, 9))
    size_high, size_low = F.shiftright(size, 31), size.bitwiseAND(F.lit(2**31 - 1).cast("bigint"))
    rest = high * size_low + 2 * low * size_high + F.shiftright(low * size_low, 30)
    return F.when(size > 0, 2 * high * size_high + F.shiftright(rest, 30))


def generation_id(seed: int, *keys: Column | str) -> Column:
    """Reproducible identifier in the 8-4-4-4-12 shape of a UUID."""
    digest = key_hash(F.lit(f"{seed}|generation"), *keys)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])
