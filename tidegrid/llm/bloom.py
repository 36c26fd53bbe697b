"""A Bloom filter of long keys, so that only rows that may join are shuffled.

Bits are sized by the number of keys up to a fixed bound, and that bound is
what tasks and the driver receive.  Beyond it more rows pass than need be; the
join that follows decides, so results never depend on the filter.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm import kernels as K

PROBES = 4
LEAST_BITS, MOST_BITS = 16, 28
BITS_PER_KEY = 16


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    h = K.mix(keys.astype(np.int64).view(np.uint64))
    step = K.mix(h) | K.U64(1)
    return [((h + K.U64(i) * step) >> K.U64(64 - bits)).astype(np.int64) for i in range(PROBES)]


class Bloom:
    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for p in _places(keys, self.bits):
            out &= (self.words[p >> 6] >> (p & 63).astype(np.uint64)) & K.U64(1) == 1
        return out

    def column(self, key: Column) -> Column:
        """True where a key may be held; nulls may not."""
        held = self

        @F.pandas_udf(T.BooleanType())
        def test(x: pd.Series) -> pd.Series:
            known = x.notna().to_numpy()
            out = np.zeros(len(x), bool)
            out[known] = held.may_hold(x.to_numpy()[known].astype(np.int64))
            return pd.Series(out)

        return test(key)


    def first_column(self, key: Column, other: Column) -> Column:
        """True for the first row of a task with its pair of keys, where ``key`` may be held."""
        held = self

        @F.pandas_udf(T.BooleanType())
        def test(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            seen: set[tuple[int, int]] = set()
            for x, y in batches:
                a, b = x.to_numpy().astype(np.int64), y.to_numpy().astype(np.int64)
                out = held.may_hold(a)
                for k in np.flatnonzero(out):
                    pair = (int(a[k]), int(b[k]))
                    out[k] = pair not in seen
                    seen.add(pair)
                yield pd.Series(out)

        return test.asNondeterministic()(key, other)


def build(keys: DataFrame) -> Bloom:
    """A filter of the one long column of ``keys`` (a written table: it is counted first)."""
    count = keys.count()
    bits = int(np.clip(np.ceil(np.log2(max(count, 1) * BITS_PER_KEY)), LEAST_BITS, MOST_BITS))

    def mark(batches):
        words = np.zeros(1 << (bits - 6), np.uint64)
        for batch in batches:
            x = np.array(batch.column(0).drop_null())
            for p in _places(x, bits):
                np.bitwise_or.at(words, p >> 6, K.U64(1) << (p & 63).astype(np.uint64))
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(words[at].view(np.int64))], names=["at", "word"])

    table = keys.mapInArrow(mark, "at int, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[np.array(table.column("at"))] = np.array(table.column("word")).astype(np.int64).view(np.uint64)
    return Bloom(words, bits)
