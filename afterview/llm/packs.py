"""Packed exchange: chunks of documents ask, parts of a key space answer.

Operators that compare every place of a corpus with every other would shuffle
one row per place. Here the documents are dealt into chunks by a hash; a chunk
sends each part of the key space one packed, compressed message with its
distinct keys, so that a key which a third of all documents hold still costs a
part only one entry per chunk. The part answers in the order of the question.
A part that a chunk has no key for gets no message, so there are never more
messages than keys: with ever more chunks and parts the exchange goes over into
an ordinary shuffle of keys, with a few bytes more for each.
Chunks are recomputed from the documents wherever they are needed, and all
messages go through ordinary shuffles, so lost executors are made up for.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import flat, give_back, text_size

#: What stands for a null id: after all others.
NO_ID = np.iinfo(np.int64).max
MESSAGE = "part int, chunk int, kind int, data binary"
MESSAGE_ARROW = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])


_KINDS = "u1 u2 u4 u8 i4 i8 f8".split()
_HEAD = struct.Struct("<BII")
#: Arrays of fewer bytes go as they are.
SMALL = 64


def bundle(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one compressed message; the bytes of equal weight lie together."""
    out = [struct.pack("<B", len(arrays))]
    press = zstandard.ZstdCompressor(level=level)
    for a in arrays:
        a = np.ascontiguousarray(a)
        raw = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.itemsize > 1 else a.tobytes()
        packed = press.compress(raw) if len(raw) > SMALL else raw
        out += [_HEAD.pack(_KINDS.index(a.dtype.str[1:]), len(packed), len(a)), packed]
    return b"".join(out)


def unbundle(data: bytes) -> list[np.ndarray]:
    n, at, out, press = data[0], 1, [], zstandard.ZstdDecompressor()
    for _ in range(n):
        kind, size, length = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        dtype, raw = np.dtype(_KINDS[kind]), data[at : at + size]
        at += size
        if length * dtype.itemsize > SMALL:
            raw = press.decompress(raw, max_output_size=length * dtype.itemsize)
        raw = np.frombuffer(raw, np.uint8)
        out.append(np.ascontiguousarray(raw.reshape(dtype.itemsize, -1).T).view(dtype).reshape(-1) if dtype.itemsize > 1 else raw.view(dtype))
    return out


def steps(a: np.ndarray) -> np.ndarray:
    """Differences of a sorted array, which pack better; np.cumsum undoes it."""
    return np.diff(a, prepend=a.dtype.type(0))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each 64-bit key; keeps the order of the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def by_part(sorted_keys: np.ndarray, parts: int) -> Iterable[tuple[int, int, int]]:
    """(part, from, to) for each part that has keys."""
    bounds = np.searchsorted(part_of(sorted_keys, parts), np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(bounds)):
        yield int(p), int(bounds[p]), int(bounds[p + 1])


def messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, MESSAGE_ARROW, strict=True)], schema=MESSAGE_ARROW)


BLOBS = "chunk int, data binary"


def packed(batches: Iterable[pa.RecordBatch], level: int = 1) -> Iterable[pa.RecordBatch]:
    """(chunk, data) of (chunk, doc_id, text): the documents of a batch that go to one
    chunk, as one compressed message."""
    for b in batches:
        chunk = b.column(0).to_numpy(zero_copy_only=False)
        order = np.argsort(chunk, kind="stable")
        buf, bounds = flat(b.column(2).take(pa.array(order)))
        ids_ = b.column(1).take(pa.array(order))
        null = np.asarray(ids_.is_null().to_numpy(zero_copy_only=False), np.uint8)
        number = ids_.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        chunk = chunk[order]
        head = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])) if len(chunk) else np.zeros(0, np.int64)
        rows = []
        for x, y in zip(head.tolist(), np.append(head[1:], len(chunk)).tolist(), strict=True):
            rows.append(bundle(number[x:y], null[x:y], np.diff(bounds[x : y + 1]), buf[bounds[x] : bounds[y]], level=level))
        yield pa.RecordBatch.from_arrays([pa.array(chunk[head], pa.int32()), pa.array(rows, pa.binary())], ["chunk", "data"])


def unpacked(table: pa.Table) -> pa.Table:
    """(chunk, doc_id, text as bytes) of a chunk's messages, in an order that does not depend on the shuffle."""
    held = [unbundle(d) for d in sorted(table["data"].to_pylist())]
    join = lambda k, t: np.concatenate([np.zeros(0, t), *(h[k] for h in held)])
    number, null, sizes = join(0, np.int64), join(1, np.uint8), join(2, np.int64)
    ids_ = pa.array(number, pa.int64(), mask=null.astype(bool))
    bounds = np.append(0, np.cumsum(sizes))
    text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(number), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(join(3, np.uint8))])
    chunk = pa.array(np.full(len(number), table["chunk"][0].as_py() if table.num_rows else 0), pa.int32())
    return pa.table({"chunk": chunk, "doc_id": ids_, "text": text})


def _kept(f):
    def run(table: pa.Table) -> pa.Table:
        try:
            return f(table)
        finally:
            give_back()

    return run


def _kept2(f):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        try:
            return f(table, answers)
        finally:
            give_back()

    return run


class Chunks:
    """docs as (chunk, doc_id, text), dealt by a hash of id and text; they are shuffled once, compressed.

    Both sizes are bounds of memory: a chunk is about `chunk_bytes` of text, and a
    part holds the keys of about `part_bytes`. `level`: how hard the documents are compressed.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text", chunk_bytes: int = 16 << 20, part_bytes: int = 32 << 20, least: int = 6, level: int = 1):
        self.n, size = text_size(docs, text)
        self.count = max(least, math.ceil(size / chunk_bytes))
        self.parts = max(least, math.ceil(size / part_bytes))
        key = F.pmod(F.xxhash64(F.col(id_col), F.col(text)), F.lit(self.count)).cast("int")
        dealt = docs.select(key.alias("chunk"), F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
        self.frame = dealt.mapInArrow(lambda batches: packed(batches, level), BLOBS).repartition(self.count, "chunk")

    def ask(self, f: Callable[[pa.Table], pa.Table]) -> DataFrame:
        """One call per chunk -> messages to parts."""
        return self.frame.groupBy("chunk").applyInArrow(_kept(lambda t: f(unpacked(t))), MESSAGE)

    def answer(self, asked: DataFrame, f: Callable[[pa.Table], pa.Table]) -> DataFrame:
        """One call and task per part with all its messages -> messages to chunks, dealt by chunk:
        the exchange is made once, whoever hears them, also in a union with others."""
        told = asked.repartitionById(self.parts, F.col("part")).groupBy("part").applyInArrow(_kept(f), MESSAGE)
        return told.repartition(self.count, "chunk")

    def hear(self, answers: DataFrame, f: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        """One call per chunk with its documents and the answers to it."""
        return self.frame.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_kept2(lambda t, a: f(unpacked(t), a)), schema)


def letters(table: pa.Table, kind: int | None = None) -> list[tuple[int, int, bytes]]:
    """(part, chunk, data) of a table of messages, in the order of parts and chunks."""
    rows = zip(table["part"].to_pylist(), table["chunk"].to_pylist(), table["kind"].to_pylist(), table["data"].to_pylist(), strict=True)
    return sorted((p, c, d) for p, c, k, d in rows if kind is None or k == kind)


def ids(table: pa.Table) -> np.ndarray:
    return table["doc_id"].combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
