"""A fixed-size bit filter over 64-bit hashes.

It has ``2**bits`` bits whatever the data, so it may be sent to every task.  It never misses a
hash that was put in; what passes by chance is removed by the join that follows.
"""

from __future__ import annotations

import numpy as np

BITS = 24


def bit_filter(hashes, column: str, bits: int = BITS) -> np.ndarray:
    """Bit filter of a frame's hash column: at most ``2**(bits-6)`` short rows reach the driver."""
    from pyspark.sql import functions as F

    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (hashes.where(F.col(column).isNotNull()).select(slot.alias("slot"))
            .groupBy(F.shiftright("slot", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("mask")).toArrow())
    words = np.zeros(1 << (bits - 6), np.int64)
    words[rows.column("word").to_numpy()] = rows.column("mask").to_numpy()
    return words.view(np.uint64)


def passes(words: np.ndarray, h: np.ndarray, bits: int = BITS) -> np.ndarray:
    slot = h & np.uint64((1 << bits) - 1)
    return ((words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)


def passing_rows(frame, key: str, words: np.ndarray):
    """``frame`` with a column ``maybe``: whether a row's hash in column ``key`` passes the filter."""
    import pyarrow as pa
    from pyspark.sql.types import BooleanType, StructType

    schema = StructType([*frame.schema]).add("maybe", BooleanType())
    at = frame.columns.index(key)

    def stage(batches):
        for batch in batches:
            maybe = pa.array(passes(words, batch.column(at).to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, maybe], names=[f.name for f in schema])

    return frame.mapInArrow(stage, schema)
