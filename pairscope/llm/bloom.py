"""Bloom filters of bounded size over 64-bit hashes, built by executors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of a filter's bits: 128 KB at least, 16 MB at most.  A filter that more
#: values than that can tell apart lets more rows through; results stay the same.
LOG_BITS = (20, 27)


def slots(h: np.ndarray, log_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of each hash (unsigned 64-bit)."""
    mask = np.uint64((1 << log_bits) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


class Bloom:
    def __init__(self, bits: np.ndarray, log_bits: int):
        self.bits, self.log_bits = bits, log_bits

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Whether each hash may have been added; false only if it was not."""
        a, b = slots(h, self.log_bits)
        return ((self.bits[a >> 3] >> (a & 7)) & (self.bits[b >> 3] >> (b & 7)) & 1).astype(bool)


def build(hashes: DataFrame, column: str, count: int, bits_per_value: int) -> Bloom:
    """Filter of a long column; the words are combined by executors, at most 2^log_bits / 32 of them come back."""
    log_bits = min(max(math.ceil(math.log2(max(count, 1) * bits_per_value)), LOG_BITS[0]), LOG_BITS[1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"slot": np.unique(np.concatenate(slots(batch["h"].to_numpy().view(np.uint64), log_bits)))})

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:            # a row a batch: millions of rows would fill the driver
            yield pd.DataFrame({"words": [batch["word"].to_numpy(np.uint32).tobytes()],
                                "bits": [batch["bits"].to_numpy(np.int64).astype(np.uint32).tobytes()]})

    words = (hashes.select(F.col(column).alias("h")).mapInPandas(run, "slot long")
             .groupBy(F.expr("slot div 32").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 32 as int))")).alias("bits"))
             .mapInPandas(pack, "words binary, bits binary"))
    out = np.zeros(1 << (log_bits - 5), np.uint32)
    for r in words.collect():
        out[np.frombuffer(r.words, np.uint32)] = np.frombuffer(r.bits, np.uint32)
    return Bloom(out.view(np.uint8), log_bits)
