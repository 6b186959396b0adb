"""Sharding by a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import documents, numbered
from .textnum import mix


class Permutation:
    """A bijection of 0 .. n-1 that needs no table.

    A balanced Feistel network permutes the next even power of two; an image
    beyond n is permuted again until it falls inside (cycle walking), under
    four steps on average. The inverse walks the rounds backwards.
    """

    def __init__(self, n: int, seed: int = 0, rounds: int = 6):
        self.n, self.half = n, np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        self.keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) + mix(np.array([seed], np.uint64)))

    def _round(self, right: np.ndarray, key: np.uint64) -> np.ndarray:
        return mix(right + key) & self.mask

    def _network(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return (left << self.half) | right

    def _network_back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ self._round(left, key), left
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        out = step(np.asarray(x, np.uint64))
        while len(out) and (far := np.flatnonzero(out >= np.uint64(self.n))).size:
            out[far] = step(out[far])
        return out.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self._network)

    def backward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self._network_back)


def shard_rows(df: DataFrame, order: list, shards: int = 24, seed: int = 7, name: str = "shards") -> DataFrame:
    """df with `row_number`, `shard` and `slot`: a reproducible shuffle.

    Row r of the given order goes to place p = permutation(r); shard is p mod
    shards and slot is p div shards, so counts differ by one at most, slots
    have no gaps, and both directions can be computed without any table.
    Rows that tie in the order may trade places; nulls stand where the order puts
    them. An empty table stays empty. Columns named row_number, shard or slot are
    replaced, all others pass through, long texts too.
    """
    df = df.drop("shard", "slot")
    rows = numbered(df, order, name)
    law = Permutation(rows.count(), seed)
    names = rows.columns
    schema = T.StructType([*rows.schema, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def place(batches):
        for b in batches:
            p = law.forward(b.column(names.index("row_number")).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array((p % shards).astype(np.int32)), pa.array(p // shards)], schema.names)

    return rows.mapInArrow(place, schema)


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `rows`: counts at most one apart. A null text has size 8 and the
    checksum of an empty one; a null doc_id stands first in the order."""
    docs = documents(spark, sf_dir)
    text = F.coalesce("text", F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shard_rows(slim, ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")
