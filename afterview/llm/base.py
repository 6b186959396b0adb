"""What the operators share: the shared folder, stored tables, sizes, global numbering."""

from __future__ import annotations

import ctypes
import functools
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def mark(columns: list[str]) -> str:
    """What an operator's own columns may begin with: no column of the table begins so
    (names are told apart without regard to case)."""
    out = "_op_"
    while any(c.lower().startswith(out) for c in columns):
        out += "_"
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Returns the memory that a worker process has freed to the system: workers are
    kept between tasks, and what one stage has freed is of no use to the JVM beside it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(run):
    """A function over batches that gives its memory back when it has seen them all."""

    @functools.wraps(run)
    def outer(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return outer


def text_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes of the whole column."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def numbered(df: DataFrame, order: list, name: str, out: str = "row_number") -> DataFrame:
    """df with `out` long: 0, 1, ... in the given order over the whole table.

    One range exchange; each partition counts its own rows, and only one count
    for each partition goes to the driver. Rows that tie in the whole order
    (equal rows, for instance a third of the table) are spread by a random last
    key; they stand in any order, fixed once by the stored table. A column
    named `out` is replaced.
    """
    df = df.drop(out)
    own = mark(df.columns)
    part, at, salt, start = (own + x for x in ("part", "at", "salt", "from"))
    last = F.col(salt)
    ranged = df.withColumn(salt, F.rand(11)).repartitionByRange(*order, last).sortWithinPartitions(*order, last).drop(salt)
    place = (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).alias(at)
    kept = stored(ranged.select("*", F.spark_partition_id().alias(part), place), name)
    counts = sorted((r[part], r["count"]) for r in kept.groupBy(part).count().collect())
    rows, total = [], 0
    for number, n in counts:
        rows.append((number, total))
        total += n
    offsets = kept.sparkSession.createDataFrame(rows, f"{part} int, {start} long")
    return kept.join(F.broadcast(offsets), part).withColumn(out, F.col(start) + F.col(at)).drop(part, at, start)


def flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string or binary column as one byte buffer, and the bounds of each; null is empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], column.type)
    n = len(array)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    bounds = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)[array.offset : array.offset + n + 1].astype(np.int64)
    data = array.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, bounds - bounds[0]


def slices(bounds: np.ndarray, most: int):
    """Ranges of documents of at most `most` bytes each; a longer document is alone."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
        yield at, to
        at = to
