"""SQL fragments in DuckDB's dialect, written from the definition of each draw rather than from its plan."""

from __future__ import annotations

SEED = 7


def u(salt: str, *keys: str, seed: int = SEED) -> str:
    parts = ", ".join([f"'{seed}|{salt}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return (
        f"((CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 12) AS BIGINT) + CAST(0.5 AS DOUBLE))"
        " / CAST(281474976710656 AS DOUBLE))"
    )


def spread(*keys: str, digits: int = 2) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"substr(md5(concat_ws('|', {parts})), 1, {digits})"


def bits(salt: str, *keys: str, seed: int = SEED) -> str:
    """60 hash bits."""
    parts = ", ".join([f"'{seed}|{salt}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    half = [f"CAST(CAST('0x' || substr(md5(concat_ws('|', {parts})), {at}, 8) AS BIGINT) // 4 AS HUGEINT)" for at in (1, 9)]
    return f"({half[0]} * 1073741824 + {half[1]})"


def below(bits: str, size: str) -> str:
    return f"CAST({bits} * CAST({size} AS HUGEINT) // {2**60} AS BIGINT)"


def between(uniform: str, low: int, high: int) -> str:
    return f"CAST(floor({uniform} * {high - low + 1}) + {low} AS BIGINT)"


def laid_out(source: str, key: list[str], order: list[str], weight: str = "w") -> str:
    """Cumulative intervals of ``source`` rows, in one window over each pool."""
    part = f"PARTITION BY {', '.join(key)} " if key else ""
    by = ", ".join(f"{o} NULLS FIRST" for o in order)
    return (
        f"SELECT *, CAST(SUM({weight}) OVER ({part}ORDER BY {by} ROWS UNBOUNDED PRECEDING) AS BIGINT) - {weight} AS lo,"
        f" CAST(SUM({weight}) OVER ({part}) AS BIGINT) AS total FROM {source}"
    )


def generation_id(*keys: str, seed: int = SEED) -> str:
    parts = ", ".join([f"'{seed}|generation'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    digest = f"md5(concat_ws('|', {parts}))"
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return "concat_ws('-', " + ", ".join(f"substr({digest}, {a}, {n})" for a, n in cuts) + ")"
