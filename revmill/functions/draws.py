"""Repeatable pseudo-random values: a hash of the row's own key and a seed, so the
result does not depend on partitioning, on retries or on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAWS_PER_HASH = 4


def draws(seed: int, *keys: Column) -> list[Column]:
    """Four independent 32-bit integers out of one 128-bit hash of the key."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    digest = F.md5(text)
    return [
        F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")
        for i in range(DRAWS_PER_HASH)
    ]


def between(draw: Column, low: int, high: int) -> Column:
    """An integer from ``low`` to ``high``, both included."""
    return (draw % (high - low + 1) + low).cast("int")


def choice(draw: Column, values: tuple[str, ...]) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, between(draw, 1, len(values)))
