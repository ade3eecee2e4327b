"""A filter of fixed size for 64-bit keys: what it lacks is surely none of them, what it holds is to be looked up."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 25  # 4 MB whatever the number of keys; more keys let more through
PROBES = 3  # bits per key, from separate parts of it


def key_filter(keys: DataFrame, name: str) -> np.ndarray:
    """The filter of a column of hashes, put together by Spark from the words that have a bit."""
    probes = F.array(*((F.shiftrightunsigned(name, 13 * at)).bitwiseAND((1 << BITS) - 1) for at in range(PROBES)))
    rows = keys.select(F.explode(probes).alias("bit")).groupBy(F.shiftright("bit", 5).cast("int").alias("place")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits")).toArrow()
    bits = np.zeros(1 << BITS - 5, np.uint32)
    bits[rows["place"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return bits


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each signed 64-bit key may be one of those of the filter."""
    found = np.ones(len(keys), bool)
    for at in range(PROBES):
        probe = keys.view(np.uint64) >> np.uint64(13 * at) & np.uint64((1 << BITS) - 1)
        found &= (bits[probe >> np.uint64(5)] >> (probe & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)
    return found
