"""Benchmark decontamination by one Aho-Corasick automaton over normalised items."""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import documents, mark, released

#: A-Z to lower case; every byte that is not a digit, a letter or above 0x7F to a space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Normalised bytes of all items that one automaton may hold; every worker process builds it.
AUTOMATON_BYTES = 32 << 20

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
])


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


class Items:
    """The automaton over all items, and the items' words behind it.

    Patterns are the whole items of fewer than `width` words, and of the others
    the aligned blocks of half a window: any `width` consecutive words hold one
    of them whole. So the patterns are as long as the items and not `width` times
    that; a block found in a text is extended, word by word, to the longest run
    that the text shares with the item there, and counts from `width` words on.
    """

    def __init__(self, texts: dict[bytes, tuple[str, ...]], width: int):
        """texts: the normalised words of distinct items, joined by a space, and their ids."""
        self.width, self.ids, self.words = width, [], []
        block, known = (width + 1) // 2, {}
        found: dict[bytes, tuple[list[int], list[tuple[int, int]]]] = {}
        for k, (text, ids) in enumerate(sorted(texts.items())):
            words = [known.setdefault(w, w) for w in text.split()]
            self.ids.append(ids)
            self.words.append(words)
            if len(words) < width:
                found.setdefault(text, ([], []))[0].append(k)
                continue
            for i in range(0, len(words) - block + 1, block):
                found.setdefault(b" ".join(words[i : i + block]), ([], []))[1].append((k, i))
        self.machine = ahocorasick.Automaton()
        for pattern, (whole, blocks) in found.items():
            self.machine.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, whole, blocks))
        if found:
            self.machine.make_automaton()

    def find(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged runs of hit words [from, to), ids of the items that occur."""
        words = normal_words(text)
        if not words or not len(self.machine):
            return len(words), [], set()
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        runs: list[tuple[int, int]] = []
        hit: set[int] = set()
        reached: dict[tuple[int, int], int] = {}
        gaps = None
        for end, (n, whole, blocks) in self.machine.iter(line):
            if gaps is None:
                gaps = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
            to = int(np.searchsorted(gaps, end))
            if whole:
                runs.append((to - n, to))
                hit.update(whole)
            for k, i in blocks:
                shift = to - n - i  # of the item's words to the text's
                if reached.get((k, shift), 0) >= to:
                    continue
                own, a, b = self.words[k], to - n, to
                while a > max(shift, 0) and words[a - 1] == own[a - 1 - shift]:
                    a -= 1
                last = min(len(words), shift + len(own))
                while b < last and words[b] == own[b - shift]:
                    b += 1
                reached[k, shift] = b
                if b - a >= self.width:
                    runs.append((a, b))
                    hit.add(k)
        return len(words), merged(runs), {i for k in hit for i in self.ids[k]}


def distinct_items(rows, width: int) -> dict[bytes, tuple[str, ...]]:
    """Normalised texts of (id, text) with the ids that have each; items without an id or words are left out."""
    found: dict[bytes, set[str]] = {}
    for item, text in rows:
        words = normal_words(text)
        if item is not None and words:
            found.setdefault(b" ".join(words), set()).add(item)
    return {text: tuple(sorted(ids)) for text, ids in found.items()}


_built: dict[str, Items] = {}


def built(texts: dict[bytes, tuple[str, ...]], width: int) -> Items:
    """Built once for each worker process; the last one is kept."""
    key = hashlib.sha256(repr((width, sorted(texts.items()))).encode()).hexdigest()
    if key not in _built:
        _built.clear()
        _built[key] = Items(texts, width)
    return _built[key]


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as [start, end) in characters of the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    inside = np.frombuffer(raw.translate(NORMAL), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    chars = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return [(int(chars[starts[a]]) - 1, int(chars[ends[b - 1] - 1])) for a, b in runs]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 13, out: str = "contamination", most_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """docs with one struct column: n_words, n_hit (words inside any occurrence
    of a window), item_ids (strings, sorted) and spans (the hit runs as character
    ranges of the original text).

    Each text is normalised and scanned once, by one automaton over all items,
    without a shuffle. The items, a test set and not a corpus, are broadcast;
    their size is measured first, and above `most_bytes` the call is refused:
    such a set is checked in several calls whose item_ids and spans are joined.

    A null or empty text has no words and no hits; texts of any length are
    scanned whole. An item without words has no windows, one with a null id is
    left out; items with equal texts are all named. Repeated documents get equal
    results; empty tables give no rows, or no hits. A column named `out` is
    replaced; all others pass through.
    """
    spark = docs.sparkSession
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(item_text).cast("long")), F.lit(0))).first()[0]
    if size > most_bytes:
        raise ValueError(f"the items have {size} bytes, one automaton may hold {most_bytes}: raise most_bytes, or check parts of the benchmark one by one")
    rows = benchmark.select(F.col(item_id).cast("string"), item_text).toLocalIterator()  # at most most_bytes of text
    shared = spark.sparkContext.broadcast(distinct_items(((r[0], r[1]) for r in rows), width))
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(out, HITS)])

    def scan(batches):
        items = built(shared.value, width)
        for b in batches:
            found = []
            for t in b.column(b.schema.get_field_index(text)):
                t = t.as_py()
                n, runs, ids = items.find(t)
                spans = original_spans(t, runs) if runs else []
                found.append({"n_words": n, "n_hit": sum(y - x for x, y in runs), "item_ids": sorted(ids), "spans": [{"start": s, "end": e} for s, e in spans]})
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in kept), pa.array(found, _ARROW)], [*kept, out])

    return docs.mapInArrow(released(scan), schema)


_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def contaminated(hits: str = "contamination"):
    """The contract's rule: some words are hit, and they are a twentieth of all words or more."""
    return (F.col(f"{hits}.n_hit") > 0) & (F.col(f"{hits}.n_hit") * 20 >= F.col(f"{hits}.n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the contaminated ones, same columns, whatever their names.

    A null or empty text is never contaminated and stays; of repeated rows all
    stay or all go; long texts are judged whole; an empty table stays empty.
    """
    held = mark(docs.columns) + "contamination"
    return benchmark_hits(docs, benchmark, out=held).where(~contaminated(held)).select(*docs.columns)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row for each document, ids of any type as strings; a null text
    has no words, and documents without hits have the digest of the empty string."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    hits = benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text")
    return hits.select(
        "doc_id", "contamination.n_words", "contamination.n_hit",
        F.size("contamination.item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "contamination.item_ids"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
