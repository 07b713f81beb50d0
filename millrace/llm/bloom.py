"""Bloom filters over 64-bit keys, built by Spark in segments.

A key's high bits choose its segment, so each segment is one short task over
its own keys; only the finished bit arrays (a size the caller fixes) reach the
driver and the workers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import sorted_groups
from millrace.llm.text import mix

SEGMENT_BITS = 1 << 20


def probe_bits(keys: np.ndarray, probes: int) -> Iterator[np.ndarray]:
    """The bit positions of the keys in their segment, one array per probe."""
    a = mix(keys)
    b = mix(a) | np.uint64(1)
    for k in range(probes):
        yield ((a + np.uint64(k) * b) >> np.uint64(20)) & np.uint64(SEGMENT_BITS - 1)


def build(keys: DataFrame, segments: int, probes: int) -> np.ndarray:
    """``keys``: one long column named key.  Returns segments x SEGMENT_BITS bits, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 1):
            bits = np.zeros(SEGMENT_BITS, bool)
            for at in probe_bits(group.column(1).to_numpy().astype(np.int64).view(np.uint64), probes):
                bits[at.astype(np.int64)] = True
            yield pa.RecordBatch.from_arrays([pa.array([int(group.column(0)[0].as_py())]), pa.array([np.packbits(bits).tobytes()], pa.binary())],
                                             names=["segment", "bits"])

    # keys are hashes: segments are even
    rows = keys.select(F.pmod("key", F.lit(segments)).alias("segment"), "key")
    done = (rows.repartition("segment").sortWithinPartitions("segment")
            .mapInArrow(run, "segment bigint, bits binary").collect())
    out = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
    for r in done:
        out[r["segment"]] = np.frombuffer(r["bits"], np.uint8)
    return out


def contains(bits: np.ndarray, keys: np.ndarray, probes: int) -> np.ndarray:
    """Mask of the uint64 ``keys`` that may be in the filter."""
    flat = bits.reshape(-1)
    segment = np.mod(keys.view(np.int64), len(bits)) * (SEGMENT_BITS // 8)
    found = np.ones(len(keys), bool)
    for at in probe_bits(keys, probes):
        at = at.astype(np.int64)
        found &= (flat[segment + (at >> 3)] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
    return found
