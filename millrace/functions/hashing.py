"""Partition hashes as column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalar import col

# The constants of the 32-bit hash used for record keys.
MURMUR2_SEED = 0x9747B28C
MURMUR2_M = 0x5BD1E995
MURMUR2_R = 24


@F.pandas_udf(T.LongType())
def _murmur2(keys: pd.Series) -> pd.Series:
    """The hash of a batch of keys at once: one step per word position, for all keys that
    are that long. Array arithmetic on 32-bit numbers wraps as the hash wants it."""
    data = [key.encode("utf-8") for key in keys]
    size = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
    start = np.concatenate(([0], np.cumsum(size)[:-1])) if len(data) else size
    raw = np.frombuffer(b"".join(data) + bytes(4), dtype=np.uint8).astype(np.uint32)
    m = np.uint32(MURMUR2_M)
    state = np.uint32(MURMUR2_SEED) ^ size.astype(np.uint32)
    words = size // 4
    for word in range(int(words.max(initial=0))):
        has = np.flatnonzero(words > word)
        at = start[has] + 4 * word
        k = raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16 | raw[at + 3] << 24
        k *= m
        k ^= k >> MURMUR2_R
        state[has] = state[has] * m ^ k * m
    left = size - 4 * words
    at = start + 4 * words
    tail = np.zeros(len(data), dtype=np.uint32)
    for i in range(3):
        has = np.flatnonzero(left > i)
        tail[has] |= raw[at[has] + i] << (8 * i)
    state = np.where(left > 0, (state ^ tail) * m, state)
    state = (state ^ state >> 13) * m
    return pd.Series((state ^ state >> 15).astype(np.int64))


def murmur2(key) -> Column:
    """Unsigned 32-bit murmur2 of a key's UTF-8 bytes, the hash log producers place keys by.

    Arrow batches and array arithmetic: the same in built-in functions has to take the key
    apart as text and is some fifty times slower.
    """
    return _murmur2(col(key).cast("string"))


def positive31(value) -> Column:
    """Drop the sign bit, as key placement does before taking the remainder."""
    return value.bitwiseAND(F.lit(0x7FFFFFFF).cast("long"))


def md5_prefix(key) -> Column:
    """First 28 bits of the md5 digest: portable, reproducible in plain SQL."""
    digest = F.md5(col(key).cast("string"))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long")
