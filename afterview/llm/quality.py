"""Quality classifier by importance resampling of hashed n-grams.

Two generative models over hashed n-grams (words and word pairs), one of the
target text and one of the raw text, each with two factors: how often an n-gram
is drawn, and in which share of the documents it is present at all. The second
is not moved by one document that repeats itself, and speaks up only against an
n-gram: one that raw documents have and target ones clearly have not. The log
ratio of the models, for each n-gram of a text, is its log importance weight;
labels at most move and stretch that scale (an increasing line, to log odds).
The sample is the top k of the weights with Gumbel noise, which draws without
replacement in proportion to them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import documents, flat, numbered, released, slices, stored
from .packs import MESSAGE, bundle, letters, messages, unbundle
from .textnum import WHITE, byte_sums, mix, span_hashes, word_spans

BUCKETS = 1 << 20
#: The buckets' counts travel in so many messages a task, and are added up by a tree with so many first nodes for each.
PARTS, NODES = 16, 1024
#: Documents' worth of evidence that the presence ratio is shrunk by; log ratios that count; their weight beside the frequencies.
SHRINK, CLEAR, PRESENCE = 5.0, -1.0, 30.0
#: At most so many labelled rows are used, those with the least hash of their id.
LABELLED = 200_000
SLICE_BYTES = 1 << 19
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def buckets(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, times) of the distinct n-grams of each document, sorted."""
    raw = LOWER[buf]
    starts, ends, first = word_spans(raw, WHITE, bounds)
    word = span_hashes(byte_sums(raw), starts, ends)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    pair = mix(word[:-1]) + word[1:]
    same = doc[1:] == doc[:-1]
    gram = np.concatenate([word, mix(pair[same])])
    key = np.concatenate([doc, doc[1:][same]]) * BUCKETS + (mix(gram) % np.uint64(BUCKETS)).astype(np.int64)
    key, times = np.unique(key, return_counts=True)
    return key // BUCKETS, key % BUCKETS, times


def fold(doc_id: Column) -> Column:
    """0: calibration, 1: never trained on, 2 to 4: the target model."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)).cast("int")


def labelled(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """(doc_id, good, toxic, fold), one row for each labelled id: good if the quality
    is 1 and nothing says toxic. Rows without an id or a quality are left out."""
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.coalesce(F.max("toxic"), F.lit(0)).cast("int").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", (F.col("quality") * (1 - F.col("toxic"))).alias("good"), "toxic", fold(F.col("doc_id")).alias("fold"))


def _counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket: documents that have it, raw and target, and occurrences, raw
    and target; and the numbers of raw and target documents.

    docs: (text, target). Each task sends its sums; they are added up by a tree of
    two levels, so that no worker holds more messages than NODES or tasks / NODES.
    The result has a fixed size."""

    def count(batches):
        seen, total, task = np.zeros((4, BUCKETS), np.int64), np.zeros(2, np.int64), TaskContext.get().partitionId()
        for b in batches:
            buf, bounds = flat(b.column(0))
            target = b.column(1).to_numpy(zero_copy_only=False)
            total += len(target), target.sum()
            for x, y in slices(bounds, SLICE_BYTES):
                doc, bucket, times = buckets(buf[bounds[x] : bounds[y]], bounds[x : y + 1] - bounds[x])
                own = target[x:y][doc]
                for k, (g, n) in enumerate(((bucket, None), (bucket[own], None), (bucket, times), (bucket[own], times[own]))):
                    seen[k] += np.bincount(g, n, BUCKETS).astype(np.int64)
        width = BUCKETS // PARTS
        yield from messages([(p, task % NODES, 0, bundle(*seen[:, p * width : (p + 1) * width], total)) for p in range(PARTS)]).to_batches()

    def add(table: pa.Table) -> pa.Table:
        sums = None
        for part, node, data in letters(table):
            arrays = unbundle(data)
            sums = arrays if sums is None else [a + b for a, b in zip(sums, arrays, strict=True)]
        return messages([(part, node, 0, bundle(*sums))])

    added = docs.mapInArrow(released(count), MESSAGE).groupBy("part", "chunk").applyInArrow(add, MESSAGE).groupBy("part").applyInArrow(add, MESSAGE)
    rows = sorted((r["part"], bytes(r["data"])) for r in added.collect())  # PARTS rows
    if not rows:
        return np.zeros((4, BUCKETS), np.int64), np.zeros(2, np.int64)
    parts = [unbundle(d) for _, d in rows]
    return np.stack([np.concatenate([p[k] for p in parts]) for k in range(4)]), parts[0][4]


def log_ratios(counts: np.ndarray, docs: np.ndarray, shrink: float = SHRINK, smooth: float = 0.1) -> np.ndarray:
    """Two rows: of each bucket the log ratio of the smoothed frequencies, and that of
    presence, log((target documents + s) / (those expected from raw + s)), where
    it is below CLEAR."""
    raw, target = ((c + smooth) / (c.sum() + smooth * BUCKETS) for c in counts[2:4].astype(float))
    present = np.log((counts[1] + shrink) / (counts[0] * (docs[1] / max(1, docs[0])) + shrink))
    return np.stack([np.log(target / raw), np.where(present < CLEAR, present, 0.0)]).astype(np.float32)


WEIGHTS = "doc_id long, text_key long, n_grams long, log_ratio double, weight double"


def _weights(docs: DataFrame, ratios) -> DataFrame:
    """Of (doc_id, text_key, text): the log ratio of the text under the frequency
    models, and its log importance weight for each n-gram."""
    names = [c.split()[0] for c in WEIGHTS.split(", ")]

    def run(batches):
        r = ratios.value
        for b in batches:
            buf, bounds = flat(b.column(2))
            for x, y in slices(bounds, SLICE_BYTES):
                doc, bucket, times = buckets(buf[bounds[x] : bounds[y]], bounds[x : y + 1] - bounds[x])
                own = r[:, bucket].astype(float)
                distinct, grams, often, absent = (np.bincount(doc, w, y - x) for w in (None, times, own[0] * times, own[1]))
                weight = often / np.maximum(grams, 1) + PRESENCE * absent / np.maximum(distinct, 1)
                yield pa.RecordBatch.from_arrays([b.column(0)[x:y], b.column(1)[x:y], pa.array(grams.astype(np.int64)), pa.array(often), pa.array(weight)], names)

    return docs.mapInArrow(released(run), WEIGHTS)


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float] | None:
    """The increasing line a + b * x that best gives the log odds of good (logistic
    regression by Newton's method); None where there is nothing to learn it from."""
    if not len(y) or y.min() == y.max() or x.std() < 1e-12 or x[y == 1].mean() <= x[y == 0].mean():
        return None
    middle, scale = x.mean(), x.std()
    a = np.column_stack([np.ones(len(x)), (x - middle) / scale])
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + ridge * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + (ridge + 1e-9) * np.eye(2), grad)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    slope = max(w[1] / scale, 1e-9)
    return float(w[0] - slope * middle), float(slope)


def gumbel(seed: int, *keys: Column) -> Column:
    """Noise that depends on the row and the seed only."""
    u = (F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, log_ratio, weight, log_odds, key, place, kept.

    The target text are labelled good documents (three folds in five; at most
    LABELLED rows, by the hash of their ids), the raw text all documents. One
    fold calibrates the weight to log odds, an increasing line, and one is left
    for measuring. kept: among the k greatest of log odds plus Gumbel noise; by
    default k is the number of documents with odds above one.

    Texts are read twice, whole, and not shuffled. A null or empty text has no
    n-grams and weight 0. Where the calibrating fold has not both kinds, the
    odds are the weight less that of the target's lowest hundredth, and without
    any target text the weight. Repeated rows draw equal keys and stand next to
    each other, ties in any order; a null id is never labelled; an empty table
    gives no rows. Of the columns only doc_id and text are read.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    known = stored(labelled(labels), "labelled")  # at most LABELLED rows of 20 bytes
    target = F.broadcast(known.where("good = 1 and fold >= 2").select("doc_id", F.lit(True).alias("target")))
    counted = base.join(target, "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(*_counts(counted)))  # BUCKETS times two numbers
    told = stored(_weights(base, ratios), "weights")
    fold_0 = told.join(F.broadcast(known.where("fold = 0").select("doc_id", "good")), "doc_id").groupBy("doc_id").agg(F.first("weight").alias("weight"), F.first("good").alias("good"))
    data = np.array([(r["weight"], r["good"]) for r in fold_0.collect()], float).reshape(-1, 2)  # at most LABELLED rows
    line = calibrate(data[:, 0], data[:, 1])
    if line is None:
        lowest = told.join(target, "doc_id", "left_semi").agg(F.percentile_approx("weight", 0.01, 10_000).alias("w")).first()["w"]
        line = (-(lowest or 0.0) + 1e-9, 1.0)
    scored = told.withColumn("log_odds", F.lit(line[0]) + F.lit(line[1]) * F.col("weight"))
    scored = scored.select("doc_id", "text_key", "log_ratio", "weight", "log_odds", (F.col("log_odds") + gumbel(seed, F.col("doc_id"), F.col("text_key"))).alias("key"))
    if k is None:
        k = scored.where("log_odds > 0").count()
    ranked = numbered(scored, [F.col("key").desc(), F.col("doc_id"), F.col("text_key")], "ranked")
    return ranked.select("doc_id", "log_ratio", "weight", "log_odds", "key", F.col("row_number").alias("place"), (F.col("row_number") < k).alias("kept"))


def op5_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
