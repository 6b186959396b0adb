"""Near duplicates by BagMinHash over multisets of word shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import documents, flat, mark, released, slices, stored
from .components import components
from .packs import bundle, steps, unbundle
from .textnum import WHITE, byte_sums, mix, prefix_sums, span_hashes, word_spans

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 20, 4
SLICE_BYTES = 1 << 18
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def bags(buf: np.ndarray, bounds: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, multiplicity), sorted by document and shingle.

    A document with fewer words than a shingle, but not none, has one shingle
    of all its words.
    """
    starts, ends, first = word_spans(buf, WHITE, bounds)
    sums = prefix_sums(span_hashes(byte_sums(buf), starts, ends))
    n = np.diff(first)
    shingles = np.where(n == 0, 0, np.maximum(1, n - words + 1))
    doc = np.repeat(np.arange(len(n)), shingles)
    at = first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    key = span_hashes(sums, at, np.minimum(at + words, first[1:][doc]))
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    head = np.flatnonzero(new)
    return doc[head], key[head], np.diff(np.append(head, len(doc)))


def bag_names(doc: np.ndarray, key: np.ndarray, count: np.ndarray, docs: int) -> list[bytes | None]:
    """16 bytes that equal bags share; None for an empty bag."""
    out = np.zeros((docs, 2), np.uint64)
    if len(doc):
        x = mix(key ^ mix(count.astype(np.uint64)))
        head = np.flatnonzero(np.diff(doc, prepend=-1) != 0)
        out[doc[head], 0] = mix(np.add.reduceat(x, head))
        out[doc[head], 1] = mix(np.add.reduceat(mix(x + GOLDEN), head))
    empty = np.ones(docs, bool)
    empty[doc] = False
    raw = out.tobytes()
    return [None if empty[i] else raw[16 * i : 16 * i + 16] for i in range(docs)]


def signatures(doc: np.ndarray, key: np.ndarray, count: np.ndarray, docs: int, size: int) -> np.ndarray:
    """BagMinHash: `size` registers per document; two documents agree in a
    register with the probability of their weighted Jaccard similarity.

    Each shingle owns Poisson processes over (weight level, time): one for the
    levels [0, 1) and one for each [2^j, 2^(j+1)), with as many points per unit
    of time as it spans levels. A point belongs to a random register and to a
    random level, found by halving the interval (the bits of one random
    number); it counts where the level lies below the shingle's weight, so a
    greater weight sees a superset of the points. A register keeps its earliest
    point. Points come in rising time, so a process ends when it is later than
    all registers of its document.
    """
    least = np.full(docs * size, np.inf)
    level = np.zeros(len(key), np.int64)
    owner = np.arange(len(key))
    top = np.frexp(count.astype(float))[1]  # bits of the weight
    parts = [(owner, level)]
    for j in range(1, int(top.max(initial=0))):
        more = np.flatnonzero(count > (1 << (j - 1)))
        parts.append((more, np.full(len(more), j)))
    more = np.flatnonzero(count > (1 << (int(top.max(initial=1)) - 1))) if len(key) else owner
    if len(more) and int(top.max()) > 0:
        parts.append((more, np.full(len(more), int(top.max()))))
    owner, level = (np.concatenate(p) for p in zip(*parts, strict=True))
    span = np.where(level == 0, 1, 1 << np.maximum(level - 1, 0)).astype(float)
    base = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0)).astype(float)
    seed = mix(key[owner] ^ mix(level.astype(np.uint64) + np.uint64(1)))
    time, made, block = np.zeros(len(owner)), 0, 1
    while len(owner):
        index = np.arange(made + 1, made + block + 1, dtype=np.uint64) * GOLDEN
        r = mix(seed[:, None] + index[None, :])
        wait = -np.log(((r >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / span[:, None]
        at = time[:, None] + np.cumsum(wait, 1)
        r = mix(r ^ GOLDEN)
        register = ((r >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        where = base[:, None] + span[:, None] * ((r & np.uint64(0xFFFFFFFF)).astype(float) * 2.0**-32)
        fits = where < count[owner][:, None]
        np.minimum.at(least, (doc[owner][:, None] * size + register)[fits], at[fits])
        time, made = at[:, -1], made + block
        on = np.flatnonzero(time < least.reshape(docs, size).max(1)[doc[owner]])
        owner, seed, time, span, base = owner[on], seed[on], time[on], span[on], base[on]
        block = min(2 * block, 256)
    return least.reshape(docs, size)


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = registers.view(np.uint64).reshape(len(registers), bands, rows)
    out = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(registers), bands)).copy()
    for k in range(rows):
        out = mix(out ^ bits[:, :, k])
    return out.view(np.int64)


def _described(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_key, node, bands) of (doc_id, text_key, text)."""
    names = ["doc_id", "text_key", "node", "bands"]

    def run(batches):
        for b in batches:
            buf, bounds = flat(b.column(2))
            for x, y in slices(bounds, SLICE_BYTES):
                bag = bags(buf[bounds[x] : bounds[y]], bounds[x : y + 1] - bounds[x], words)
                keys = band_keys(signatures(*bag, y - x, bands * rows), bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (y - x + 1) * bands, bands, dtype=np.int32)), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays([b.column(0)[x:y], b.column(1)[x:y], pa.array(bag_names(*bag, y - x), pa.binary()), lists], names)

    return docs.mapInArrow(released(run), "doc_id long, text_key long, node binary, bands array<long>")


def _packed_bags(texts: DataFrame, words: int) -> DataFrame:
    """(node, bag) of (node, text)."""

    def run(batches):
        for b in batches:
            buf, bounds = flat(b.column(1))
            for x, y in slices(bounds, SLICE_BYTES):
                doc, key, count = bags(buf[bounds[x] : bounds[y]], bounds[x : y + 1] - bounds[x], words)
                at = np.searchsorted(doc, np.arange(y - x + 1))
                out = [bundle(steps(key[at[i] : at[i + 1]]), count[at[i] : at[i + 1]].astype(np.uint32)) for i in range(y - x)]
                yield pa.RecordBatch.from_arrays([b.column(0)[x:y], pa.array(out, pa.binary())], ["node", "bag"])

    return texts.mapInArrow(released(run), "node binary, bag binary")


#: Longs of a sketch: 2048 bits, each the parity of the number of shingles that fall on it.
SKETCH_WORDS = 32


def parities(doc: np.ndarray, key: np.ndarray, count: np.ndarray, docs: int) -> np.ndarray:
    """A sketch for each document. Where two sketches differ in a bit, at least one
    shingle (with multiplicity) is in one document and not in the other."""
    cells = 64 * SKETCH_WORDS
    at = doc * cells + (mix(key) % np.uint64(cells)).astype(np.int64)
    odd = np.bincount(at, count & 1, docs * cells).astype(np.int64) & 1
    return np.packbits(odd.astype(np.uint8).reshape(docs, cells), axis=1).view(np.int64)


def can_overlap(differ: np.ndarray, a: np.ndarray, b: np.ndarray, similar: float) -> np.ndarray:
    """False only if multisets of a and b shingles, of which at least `differ` have no
    partner, cannot overlap by `similar`: with d of them the overlap is (a + b - d) / (a + b + d)."""
    percent = round(similar * 1000)
    return np.maximum(differ, np.abs(a - b)) * (1000 + percent) <= (a + b) * (1000 - percent)


SKETCH = "node binary, size long, sketch binary, bands binary"
_SKETCH_NAMES = ["node", "size", "sketch", "bands"]


def _sketches(bag: DataFrame) -> DataFrame:
    """SKETCH of (node, bag, bands): the number of shingles, the parities, the band keys."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 32):
                part = b.slice(at, 32)
                opened = [_opened(x) for x in part.column(1).to_pylist()]
                doc = np.repeat(np.arange(len(opened)), [len(k) for k, _ in opened])
                bits = parities(doc, np.concatenate([k for k, _ in opened]), np.concatenate([c for _, c in opened]), len(opened))
                bands = [np.array(x, np.int64).tobytes() for x in part.column(2).to_pylist()]
                columns = [pa.array([int(c.sum()) for _, c in opened], pa.int64()), pa.array([x.tobytes() for x in bits], pa.binary()), pa.array(bands, pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], _SKETCH_NAMES)

    return bag.mapInArrow(released(run), SKETCH)


#: Nodes of a bucket that are compared together with those of another block.
BLOCK = 256


def _candidates(apart: DataFrame, others: DataFrame, similar: float) -> DataFrame:
    """(u, v) of each node of `apart` and each of `others` in its bucket that has another
    class and may overlap enough, once: in the first band that they share.

    Both are (band, label, size, node, sketch, bands). A bucket is cut by size, a
    step of which is a factor of `similar`, and by hash into blocks of about BLOCK
    nodes; blocks of the same size or the next meet and are compared as matrices.
    So what is joined are blocks, and what comes out are pairs that may be near.
    """
    step = F.floor(F.log(F.col("size").cast("double")) / float(-np.log(similar) * 1.000001)).cast("int")  # a shade wider, for rounding

    def blocks(rows: DataFrame, side: str) -> DataFrame:
        rows = rows.withColumn("step", step)
        many = rows.groupBy("band", "step").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        cut = rows.join(many, ["band", "step"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        return cut.groupBy("band", "step", "block").agg(F.collect_list(F.struct("node", "label", "size", "sketch", "bands")).alias(side))

    left = blocks(apart, "a").withColumn("step", F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1)))
    met = left.join(blocks(others, "b").drop("block"), ["band", "step"]).select("band", "a", "b")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                band = batch.column(0)[i].as_py()
                sides = []
                for k in (1, 2):
                    rows = batch.column(k)[i].as_py()
                    sides.append([[r[c] for r in rows] for c in ("node", "label", "size", "sketch", "bands")])
                (u, la, sa, xa, ba), (v, lb, sb, xb, bb) = sides
                xa, xb, ba, bb = (np.frombuffer(b"".join(x), np.int64).reshape(len(x), -1) for x in (xa, xb, ba, bb))
                sa, sb, lb = np.array(sa), np.array(sb), np.array(lb, object)
                out = []
                for j in range(len(u)):
                    differ = np.bitwise_count((xa[j] ^ xb).view(np.uint64)).sum(1).astype(np.int64)
                    same = ba[j] == bb
                    first = bb[np.arange(len(v)), same.argmax(1)] == band
                    near = np.flatnonzero(can_overlap(differ, sa[j], sb, similar) & same.any(1) & first & (lb != la[j]))
                    out += [(max(u[j], v[k]), min(u[j], v[k])) for k in near.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.binary()) for k in (0, 1)], ["u", "v"])

    return met.mapInArrow(released(run), "u binary, v binary").distinct()


def _opened(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    key, count = unbundle(bag)
    return np.cumsum(key, dtype=np.uint64), count.astype(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Sizes of the intersection and the union of two multisets."""
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][x], b[1][y]).sum())
    return common, int(a[1].sum() + b[1].sum()) - common


def _verified(pairs: DataFrame, bag: DataFrame, similar: float, name: str) -> DataFrame:
    """The pairs (u, v) whose multisets overlap enough."""
    percent = round(similar * 1000)

    def run(batches):
        last: tuple = (None, None)
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b.column(2), b.column(3), strict=True)):
                x, y = x.as_py(), y.as_py()
                if last[0] != x:
                    last = (x, _opened(x))
                common, union = overlap(last[1], _opened(y))
                if common * 1000 >= percent * union:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([b.column(k).take(pa.array(keep, pa.int64())) for k in (0, 1)], ["u", "v"])

    left, right = bag.select(F.col("node").alias("u"), F.col("bag").alias("bag_u")), bag.select(F.col("node").alias("v"), F.col("bag").alias("bag_v"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", "bag_u", "bag_v")
    return stored(both.mapInArrow(released(run), "u binary, v binary"), name)


def _pair(a: str, b: str) -> DataFrame:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def near_duplicates(docs: DataFrame, similar: float = SIMILAR, words: int = WORDS, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_key (hash of the text), class_id (least
    id of its class), class_docs, kept (it stands for its class), copies (equal rows).

    Documents are linked if the multisets of their word shingles overlap by
    `similar` or more; classes are the connected components. Equal bags are
    merged first, so copies cost one row each. Different bags that share a band
    are compared: each with the least of its bucket and with the bucket's
    best-linked one, and then those that are not in that one's class with all of
    the bucket that are in another class, but for pairs whose sizes and 2048-bit
    sketches prove that they overlap less (see can_overlap; no pair is lost).
    So a bucket of n near copies of one text costs n comparisons and not their
    square; what is left meets in blocks (see _candidates), and no row is made
    for a pair that is not near. A pair at 0.8 shares no band with probability 0.59^20, 3 in 100,000;
    with the bands given, the classes are exact.

    A text without words (null too) is in no class but its own; texts of any
    length are taken whole. A null id is the greatest; repeated rows are copies of
    each other; an empty table gives no rows. Of the columns only the two named
    are read.
    """
    key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("text_key"), F.col(text).alias("text"))
    told = stored(_described(base, words, bands, rows), "signatures")
    ranked = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_key"))
    nodes = told.where("node is not null").groupBy("node").agg(F.min(ranked).alias("first"), F.any_value("bands").alias("bands"))
    buckets = nodes.select("node", "first", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("leader")).where("n > 1").drop("n")
    members = stored(buckets.join(shared, "band"), "buckets")

    wanted = members.groupBy("node").agg(F.min("first").alias("first")).select("node", "first.*")
    # merged at every size: a broadcast for small inputs alone would make the plan depend on the size
    texts = base.join(wanted.hint("merge"), base["doc_id"].eqNullSafe(wanted["doc_id"]) & (base["text_key"] == wanted["text_key"])).select("node", "text")
    bag = stored(_packed_bags(texts, words).groupBy("node").agg(F.any_value("bag").alias("bag")), "bags")
    members = members.select("band", "node", "leader")

    # each with the least of its bucket
    tested = stored(members.where("node <> leader").select(*_pair("node", "leader")).distinct(), "pairs")
    edges = _verified(tested, bag, similar, "edges")
    # each with the one of its bucket that has most links so far
    links = edges.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    ranks = members.join(links, "node", "left").select("band", "node", F.coalesce("links", F.lit(0)).alias("links"))
    hubs = ranks.groupBy("band").agg(F.max(F.struct("links", "node"))["node"].alias("hub"))
    members = stored(members.select("band", "node").join(hubs, "band"), "members")
    pairs = members.where("node <> hub").select(*_pair("node", "hub")).distinct().join(tested, ["u", "v"], "left_anti")
    pairs = stored(pairs, "pairs")
    edges = stored(edges.unionByName(_verified(pairs, bag, similar, "edges")), "edges")
    found = components(edges, "labels")
    # those that are not in the hub's class, with all of the bucket that have another class and may overlap enough
    labels = members.select("band", "node", "hub").join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_hub = labels.where("node = hub").select("band", F.col("label").alias("hub_label"))
    open_ = stored(labels.join(of_hub, "band"), "classes")
    apart = open_.where("label <> hub_label")
    open_ = open_.join(apart.select("band").distinct(), "band", "left_semi").select("band", "node", "label")
    wanted = bag.join(open_.select("node").distinct(), "node", "left_semi").join(nodes.select("node", "bands"), "node")
    sketch = stored(_sketches(wanted.select("node", "bag", "bands")), "sketches")
    with_sketch = lambda rows: rows.select("band", "node", "label").join(sketch, "node")
    near = _candidates(with_sketch(apart), with_sketch(open_), similar)
    more = _verified(stored(near, "pairs"), bag, similar, "edges")
    if not more.isEmpty():  # classes that these links join, then each node through its class
        of = lambda side: found.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))
        joins = more.join(of("u"), "u", "left").join(of("v"), "v", "left").select(F.coalesce("u_label", "u").alias("u"), F.coalesce("v_label", "v").alias("v"))
        merged = stored(components(joins, "labels"), "merged")
        through = found.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        found = stored(through.unionByName(merged.join(found, "node", "left_anti").select("node", "label")), "labels")

    labelled = told.select("doc_id", "text_key", "node").join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    apart = labelled.where("node is null")
    rows_ = stored(labelled.where("node is not null").groupBy("label", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies")), "rows")
    classes = rows_.groupBy("label").agg(F.min(ranked).alias("first"), F.sum("copies").alias("class_docs"))
    joined = rows_.join(classes, "label")
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    out = joined.select("doc_id", "text_key", F.col("first.doc_id").alias("class_id"), "class_docs", is_first.alias("kept"), "copies")
    alone = apart.select("doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_docs"), F.lit(True).alias("kept"), F.lit(1).cast("long").alias("copies"))
    return out.unionByName(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one document of each class, same columns, whatever their names;
    texts without words (null, empty) all stay, of repeated rows one does; an
    empty table stays empty."""
    m = mark(docs.columns)
    own, key_of, id_of = m + "text_key", m + "key", m + "id"
    held = docs.withColumn(own, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    kept = stored(near_duplicates(docs).where("kept and class_docs is not null"), "kept")
    words = F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\f\r")) != ""

    def of(ids: DataFrame, rows: DataFrame) -> DataFrame:
        ids = ids.select(F.col("doc_id").alias(id_of), F.col("text_key").alias(key_of))
        return rows.join(ids.hint("merge"), rows["doc_id"].eqNullSafe(ids[id_of]) & (rows[own] == ids[key_of]), "left_semi")

    worded, twice = held.where(words), kept.where("copies > 1")
    out = of(kept.where("copies = 1"), worded)
    if not twice.isEmpty():  # repeated rows: one of them
        out = out.unionByName(of(twice, worded).dropDuplicates(["doc_id", own]))
    return out.unionByName(held.where(~words)).select(*docs.columns)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "class_id", "class_docs", "kept", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")
