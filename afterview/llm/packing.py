"""Packing of documents into windows of tokens by non-negative least squares.

A document longer than a window is cut into whole windows and a rest; only the
rests have to be combined. Shallow combinations of rest lengths that fill a
window exactly are the columns of a linear system whose right side is the
histogram of rest lengths; its non-negative least-squares solution says how
often to use each. Rounded down, they take up nearly all rests; what is left
is packed greedily. The histogram has one entry for each length, so the
planning costs the driver the same for a thousand documents as for a trillion.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import documents, released, stored
from .tokens import VOCABULARY, encoder

WINDOW = 1024
END = 0


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """Pairs and triples of present lengths that fill the window exactly, as rows padded with 0."""
    have = np.zeros(window + 1, bool)
    have[present] = True
    found = []
    a = present[present * 2 <= window]
    a = a[have[window - a]]
    found.append(np.stack([a, window - a, np.zeros_like(a)], 1))
    for x in present[present * 3 <= window]:
        y = present[(present >= x) & (present * 2 <= window - x)]
        y = y[have[window - x - y]]
        found.append(np.stack([np.full_like(y, x), y, window - x - y], 1))
    return np.concatenate(found).astype(np.int64)


def solve(columns: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative least squares: repeat counts of the columns whose lengths
    add up to the histogram. Accelerated projected gradient; the matrix has
    three entries a column and is never formed."""
    size = len(histogram)
    if not len(columns):
        return np.zeros(0)
    use = (columns > 0).astype(float)

    def apply(x):
        return sum(np.bincount(columns[:, k], x * use[:, k], size) for k in range(columns.shape[1]))

    def apply_back(y):
        return sum(y[columns[:, k]] * use[:, k] for k in range(columns.shape[1]))

    goal = histogram.astype(float)
    goal[0] = 0
    probe = np.ones(len(columns))
    for _ in range(20):  # the largest eigenvalue, for the step
        probe = apply_back(apply(probe))
        top = np.linalg.norm(probe)
        probe /= top
    x = np.zeros(len(columns))
    ahead, t = x, 1.0
    for _ in range(steps):
        new = np.maximum(0, ahead - apply_back(apply(ahead) - goal) / (1.01 * top))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths and how often each is used; they use up the histogram exactly.

    histogram[n]: how many rests have n tokens, for 0 < n < window.
    """
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    columns = combinations(np.flatnonzero(left), window)
    amounts = np.floor(solve(columns, left) + 1e-6).astype(np.int64)
    out: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], most: int) -> None:
        need = Counter(lengths)
        times = min(most, *(left[n] // k for n, k in need.items()))
        if times > 0:
            for n, k in need.items():
                left[n] -= times * k
            out.append((lengths, int(times)))

    for i in np.argsort(-amounts, kind="stable"):
        if amounts[i] <= 0:
            break
        take(tuple(int(n) for n in columns[i] if n), int(amounts[i]))
    while left.any():  # residuals: the longest rest, then always the longest that still fits
        free, lengths, avail = window, [], left.copy()
        while (fit := np.flatnonzero(avail[: free + 1])).size:
            n = int(fit[-1])
            lengths.append(n)
            avail[n] -= 1
            free -= n
        take(tuple(lengths), int(left.max()))
    return out


def places(made: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, first sequence, offset), sorted: where the
    rests of each length go by their rank; and the number of sequences."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for lengths, times in made:
        offset = 0
        for n in lengths:
            rows.append((n, used[n], sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4), sequence


def _tokenised(docs: DataFrame, window: int, vocabulary: str, text: str) -> DataFrame:
    names = [c for c in docs.columns if c != text]
    extra = [("doc_tokens", T.LongType()), ("crcs", T.ArrayType(T.LongType())), ("rest", T.IntegerType()), ("part", T.IntegerType()), ("full_at", T.LongType()), ("rest_at", T.LongType())]
    schema = T.StructType([*(docs.schema[c] for c in names), *(T.StructField(*x) for x in extra)])

    def run(batches):
        encode, part = encoder(vocabulary), TaskContext.get().partitionId()
        full, ranks = 0, np.zeros(window, np.int64)
        for b in batches:
            out = []
            for t in b.column(b.schema.get_field_index(text)):
                ids = np.array([*encode(t.as_py() or ""), END], "<u4")
                whole, rest = divmod(len(ids), window)
                out.append((len(ids), [zlib.crc32(ids[i : i + window]) for i in range(0, len(ids), window)], rest, part, full, ranks[rest]))
                full += whole
                ranks[rest] += 1
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in names), *(pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds))], schema.names)

    return docs.mapInArrow(released(run), schema)


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Texts are tokenised once; what is stored are lengths and checksums. A null
    or empty text is the end token alone. Repeated rows and null ids are packed
    like any other row. An empty table gives no pieces.
    """
    spark = docs.sparkSession
    kept = stored(_tokenised(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), window, vocabulary, "text"), "packing")
    # How many rests of each length each part holds: parts times `window` rows at most.
    counts = kept.where("rest > 0").groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(window, np.int64)
    for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect():  # at most `window` rows
        histogram[r["rest"]] = r["n"]
    table, rest_sequences = places(plan(histogram, window))
    before = counts.select("part", "rest", (F.sum("n").over(Window.partitionBy("rest").orderBy("part")) - F.col("n")).alias("rest_from"))
    fulls, total = [], 0
    for r in sorted(kept.groupBy("part").agg(F.sum(F.floor(F.col("doc_tokens") / window)).cast("long").alias("n")).collect()):  # one row for each part
        fulls.append((r["part"], total))
        total += r["n"]
    starts = spark.createDataFrame(fulls, "part int, full_from long")
    placed = kept.join(F.broadcast(starts), "part").join(before, ["part", "rest"], "left")
    placed = placed.select("doc_id", "doc_tokens", "crcs", "rest", (F.col("full_from") + F.col("full_at")).alias("full_no"), F.coalesce(F.col("rest_from") + F.col("rest_at"), F.lit(0)).alias("rank"))
    shared = spark.sparkContext.broadcast(table)  # at most a row for each length of each combination
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    kinds = (pa.int64(),) * 7

    def pieces(batches):
        rows = shared.value
        key = rows[:, 0] << 44 | rows[:, 1]
        for b in batches:
            out = []
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            rest, rank = (col[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("rest", "rank"))
            at = np.searchsorted(key, rest << 44 | rank, side="right") - 1
            for i, (doc, n, crcs, full) in enumerate(zip(*(col[c].to_pylist() for c in ("doc_id", "doc_tokens", "crcs", "full_no")), strict=True)):
                for k, crc in enumerate(crcs):
                    if (k + 1) * window <= n:
                        out.append((doc, k * window, window, crc, n, rest_sequences + full + k, 0))
                    else:
                        _, first, sequence, offset = rows[at[i]]
                        out.append((doc, k * window, int(rest[i]), crc, n, int(sequence + rank[i] - first), int(offset)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(released(pieces), schema)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
