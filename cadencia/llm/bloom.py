"""A pair of Bloom filters: hashes seen once, and hashes probably seen twice.

Every task fills its own pair; pairs are merged segment by segment, so that the merge is spread over tasks:
``twice = twice1 | twice2 | (once1 & once2)`` and ``once = once1 | once2``. A hash that occurs in two tasks
has all its bits in both ``once`` filters, hence in ``twice``: nothing that repeats is missed. What ``twice`` holds
by accident is sorted out later by an exact comparison. The filter has a fixed number of bits and is the only
thing that reaches the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Upper bound of a filter: 2^28 bits are 32 MB. More hashes than it can tell apart cost shuffle, not results.
MAX_BITS = 1 << 28
BITS_PER_HASH = 8
SEGMENTS = 64
PROBES = 3

_SCHEMA = "segment int, once binary, twice binary"


def bits_for(n: int, most: int = MAX_BITS) -> int:
    return min(most, max(1 << 16, 1 << (int(n) * BITS_PER_HASH - 1).bit_length() if n else 0))


def positions(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Bit positions of 64-bit hashes: double hashing on their two halves."""
    h = hashes.astype(np.uint64)
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [((a + np.uint64(i) * b) & np.uint64(bits - 1)).astype(np.int64) for i in range(PROBES)]


def contains(filter_bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = filter_bits.size * 8
    found = np.ones(len(hashes), bool)
    for p in positions(hashes, bits):
        found &= (filter_bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
    return found


def _set(filter_bits: np.ndarray, hashes: np.ndarray) -> None:
    for p in positions(hashes, filter_bits.size * 8):
        np.bitwise_or.at(filter_bits, p >> 3, np.left_shift(1, p & 7).astype(np.uint8))


def add(once: np.ndarray, twice: np.ndarray, hashes: np.ndarray) -> None:
    """Count a batch into a pair of filters."""
    values, counts = np.unique(hashes, return_counts=True)
    _set(twice, values[(counts > 1) | contains(once, values)])
    _set(once, values)


def _fill(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice, any_row = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8), False
        for batch in batches:
            if batch.num_rows:
                any_row = True
                add(once, twice, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        if any_row:
            yield from _segments((i, o, t) for i, (o, t) in enumerate(zip(np.split(once, SEGMENTS), np.split(twice, SEGMENTS))))

    return run


def _segments(rows) -> Iterator[pa.RecordBatch]:
    for i, once, twice in rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array([i], pa.int32()), pa.array([zlib.compress(once.tobytes(), 1)], pa.binary()), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())],
            names=["segment", "once", "twice"],
        )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for i, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
            o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (once, twice))
            if i in held:
                o0, t0 = held[i]
                held[i] = o0 | o, t0 | t | (o0 & o)
            else:
                held[i] = o, t
    yield from _segments((i, o, t) for i, (o, t) in held.items())


def twice_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """The ``twice`` filter over the only column (a 64-bit hash) of ``hashes``."""
    return _filter(hashes, bits, "twice")


def seen_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """The ``once`` filter: what ``hashes`` holds, however often."""
    return _filter(hashes, bits, "once")


def _filter(hashes: DataFrame, bits: int, which: str) -> np.ndarray:
    filled = hashes.mapInArrow(_fill(bits), _SCHEMA)
    merged = filled.repartition(SEGMENTS, "segment").mapInArrow(_merge, _SCHEMA).select("segment", F.col(which).alias("bits"))
    out = np.zeros((SEGMENTS, bits // 8 // SEGMENTS), np.uint8)
    for row in merged.collect():  # at most SEGMENTS rows, bits / 8 bytes in all
        out[row.segment] = np.frombuffer(zlib.decompress(row.bits), np.uint8)
    return out.reshape(-1)
