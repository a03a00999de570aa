"""Deterministic pseudo-random draws that do not depend on partitioning.

A draw is a polynomial of the row's key modulo the prime 2^31 - 1, with
coefficients from (seed, stream). Degree four makes any five rows independent,
and whole-number arithmetic stays in generated code: far cheaper per row than
a digest of the key as text.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRIME = 2**31 - 1
BITS = 31
DEGREE = 4


def coefficients(seed: int, stream: str) -> list[int]:
    """The factor of a key's high bits, then the polynomial, highest power first."""
    source = random.Random(f"{seed}:{stream}")
    return [source.randrange(1, PRIME) for _ in range(DEGREE + 2)]


def draw(seed: int, stream: str, key: Column) -> Column:
    """A uniform whole number in [0, 2^31 - 1) from a whole-number key."""
    high_factor, first, *rest = coefficients(seed, stream)
    high = F.shiftrightunsigned(key, BITS) % PRIME
    x = (high * high_factor + key.bitwiseAND(F.lit(PRIME).cast("long"))) % PRIME
    return reduce(lambda acc, c: (acc * x + c) % PRIME, rest, F.lit(first).cast("long") % PRIME)


def drawn_number(seed: int, stream: str, key: int) -> int:
    """The same draw for one key outside of a plan."""
    high_factor, first, *rest = coefficients(seed, stream)
    x = ((key >> BITS) % PRIME * high_factor + (key & PRIME)) % PRIME
    return reduce(lambda acc, c: (acc * x + c) % PRIME, rest, first % PRIME)


def pick(drawn: Column, n: int) -> Column:
    """Uniform whole number in [0, n)."""
    return F.shiftright(drawn * n, BITS)


def unit(drawn: Column) -> Column:
    """Uniform double in [0, 1)."""
    return drawn / F.lit(2.0**BITS)


def whole_key(df: DataFrame, key: str) -> Column:
    """A key column as a whole number; other types by 62 bits of their hash."""
    if isinstance(df.schema[key].dataType, T.IntegralType):
        return F.col(key).cast("long")
    return F.shiftrightunsigned(F.xxhash64(key), 2)


def hash_rank(df: DataFrame, key: str, seed: int) -> Column:
    """A number that orders rows at random but reproducibly; ties are for the key to break."""
    return draw(seed, "rank", whole_key(df, key))
