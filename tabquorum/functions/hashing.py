"""Repeatable uniforms from row keys.

``rand()`` depends on how rows fall into partitions: after a lost executor a shuffled
partition may come back in another order and give other draws. A hash of the row's key does
not. ``xxhash64`` costs some nanoseconds, so it is simply computed again in every pass
instead of being stored; a cryptographic digest and its text form would cost as much as the
pass itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 1 << 32
LARGEST_RATE = 100.0    # one comparison a step: some 180 of them at this rate


def hash_word(key: Column, word: int = 0, seed: int | None = None) -> Column:
    """Lower (0) or upper (1) 32 bits of the key's 64-bit hash, as a non-negative long.

    An int and a long of the same value hash differently.
    """
    hashed = F.xxhash64(key) if seed is None else F.xxhash64(key, F.lit(seed).cast("long"))
    return hashed.bitwiseAND(WORD - 1) if word == 0 else F.shiftrightunsigned(hashed, 32)


def hash_bucket(key: Column, buckets: int) -> Column:
    """Key-determined bucket in ``0..buckets-1``."""
    return hash_word(key) % buckets


def member_seed(seed: int, member: int) -> int:
    return seed * 1_000_003 + member


def member_uniform(key: Column, seed: int, member: int) -> Column:
    """Uniform in [0, 1) for one ensemble member: a hash of key, seed and member of its own."""
    return hash_word(key, 0, member_seed(seed, member)) / F.lit(float(WORD))


def poisson_steps(rate: float) -> list[float]:
    """Values of the Poisson(rate) distribution function, until the rest is below 2^-32."""
    if not 0.0 < rate <= LARGEST_RATE:
        raise ValueError(f"a sampling rate must be above 0 and at most {LARGEST_RATE}, not {rate}")
    term = math.exp(-rate)
    steps = [term]
    while 1.0 - steps[-1] > 1.0 / WORD:
        term *= rate / len(steps)
        steps.append(steps[-1] + term)
    return steps


def poisson_count(uniform: Column, rate: float) -> Column:
    """Poisson(rate) draw: how many values of the distribution function ``uniform`` reaches."""
    count = F.lit(0)
    for step in poisson_steps(rate):
        count = count + (uniform >= F.lit(step)).cast("int")
    return count
