"""What the two operators on repeated spans share: anchors, contexts, marks.

Every window of `span` units (words or bytes) has an anchor: its leftmost least
k-gram under a hash. Equal windows have equal anchors at the same offset, so a
window whose anchor occurs once in the corpus cannot repeat, and the windows of
one anchor need only be compared with each other.

1. Chunks send the hashes of their anchors; parts say which ones repeat, and
   which are frequent.
2. Chunks send the context of each repeated anchor (the units that its windows
   span), equal contexts once, with their first place; a part puts different
   contexts of one prefix into memory-sized indexes, which say which of the
   windows also start earlier.
3. Chunks mark the units that such windows cover.

The prefix that sends a window to its part and index is the anchor, of `gram`
units. Where an anchor occurs more than `hot` times, and may have ever new
contexts, its windows go by a longer prefix, all of their units: then no
prefix has more than one text, and a frequent anchor spreads over all parts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .base import flat, slices
from .packs import MESSAGE, Chunks, bundle, by_part, ids, letters, messages, steps, unbundle
from .textnum import WHITE, byte_sums, mix, prefix_sums, rolling_marks, sliding_min, span_hashes, word_spans

BLOCK = 1 << 18
LOW = np.uint64((1 << 24) - 1)
FIRST, SECOND = 1, 2

@dataclass
class Context:
    """A distinct context in a part: windows of one prefix, and the text that they span."""

    key: int  # the prefix
    place: tuple[int, int]  # document and start of its first occurrence
    count: int  # windows
    anchor: int  # units from its start to the anchor
    text: bytes


#: Returns for each context a boolean array over its windows: some other context has it earlier.
Index = Callable[[list[Context]], list[np.ndarray]]


@dataclass(frozen=True)
class Law:
    words: bool  # units are words, else bytes
    span: int  # units of a window
    gram: int  # units of an anchor
    same_doc: bool  # an earlier start in the same document counts too
    hot: int = 1000  # an anchor with more occurrences (by chunk, each at most 255) goes by the longer prefix
    slice_bytes: int = 1 << 16


@dataclass
class Slice:
    """Some documents of a chunk with their units and anchors."""

    docs: np.ndarray  # ids
    raw: np.ndarray
    bounds: np.ndarray  # of documents, in bytes
    first: np.ndarray  # of documents, in units
    starts: np.ndarray | None  # of words, in bytes
    ends: np.ndarray | None
    sums: np.ndarray
    key: np.ndarray  # of each run of windows with one anchor: the anchor's hash
    low: np.ndarray  # its first window
    count: np.ndarray  # of windows
    rel: np.ndarray  # the anchor's offset from the first window
    doc: np.ndarray  # index of the document


def minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least gram (by its upper 40 bits) of each window of `width` grams."""
    n = len(grams) - width + 1
    out = [np.zeros(0, np.int64)]
    for at in range(0, max(n, 0), BLOCK):
        part = grams[at : min(at + BLOCK, n) + width - 1]
        key = (part & ~LOW) | np.arange(len(part), dtype=np.uint64)
        out.append((sliding_min(key, width) & LOW).astype(np.int64) + at)
    return np.concatenate(out)


def cut(table: pa.Table, law: Law):
    buf, bounds = flat(table["text"])
    doc_ids = ids(table)
    for a, b in slices(bounds, law.slice_bytes):
        raw, at = buf[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
        if law.words:
            starts, ends, first = word_spans(raw, WHITE, at)
            sums = prefix_sums(span_hashes(byte_sums(raw), starts, ends))
        else:
            starts = ends = None
            first, sums = at, byte_sums(raw)
        grams = rolling_marks(sums, law.gram)
        owner = minimizers(grams, law.span - law.gram + 1)
        place = np.arange(len(owner))
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(owner)]
        fits = place + law.span <= first[doc + 1]
        place, owner, doc = place[fits], owner[fits], doc[fits]
        head = np.flatnonzero(np.diff(owner, prepend=-1) != 0)
        # least hashes crowd at the low end; mixed anew, they spread over the parts
        key = mix(grams[owner[head]]) if len(head) else np.zeros(0, np.uint64)
        yield Slice(doc_ids[a:b], raw, at, first, starts, ends, sums, key, place[head], np.diff(np.append(head, len(place))), owner[head] - place[head], doc[head])


def _anchors(parts: list[Slice], law: Law) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors of a chunk, sorted, and how often they occur (documents or places, up to 255)."""
    keys = np.concatenate([np.zeros(0, np.uint64), *(s.key for s in parts)])
    if law.same_doc:
        keys, counts = np.unique(keys, return_counts=True)
    else:
        docs = np.concatenate([np.zeros(0, np.int64), *(s.docs[s.doc] for s in parts)])
        at = np.lexsort((docs, keys))
        keys, docs = keys[at], docs[at]
        new_doc = np.ones(len(keys), bool)
        new_doc[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
        keys, counts = np.unique(keys[new_doc], return_counts=True)
    return keys, np.minimum(counts, 255).astype(np.uint8)


def ask_anchors(law: Law, parts: int):
    def run(table: pa.Table) -> pa.Table:
        keys, counts = _anchors(list(cut(table, law)), law)
        chunk = table["chunk"][0].as_py()
        return messages([(p, chunk, FIRST, bundle(steps(keys[a:b]), counts[a:b])) for p, a, b in by_part(keys, parts)])

    return run


def answer_anchors(law: Law):
    def run(table: pa.Table) -> pa.Table:
        said = []
        for part, chunk, data in letters(table):
            keys, counts = unbundle(data)
            said.append((part, chunk, np.cumsum(keys, dtype=np.uint64), counts))
        every = np.concatenate([s[2] for s in said])
        at = np.argsort(every, kind="stable")
        every, counts = every[at], np.concatenate([s[3] for s in said])[at].astype(np.int64)
        head = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        total = np.add.reduceat(counts, head)
        keys, status = every[head], (total > 1).astype(np.uint8) + (total > law.hot)
        return messages([(part, chunk, FIRST, bundle(status[np.searchsorted(keys, own)])) for part, chunk, own, _ in said])

    return run


@dataclass
class Pieces:
    """The windows of a slice that go to a part: runs of windows of one prefix."""

    key: np.ndarray
    low: np.ndarray  # first window
    count: np.ndarray
    rel: np.ndarray  # the anchor's offset
    doc: np.ndarray  # ids
    start: np.ndarray  # what decides beside the document: the place in it, or 0


def pieces(s: Slice, law: Law, status: np.ndarray, keys: np.ndarray) -> Pieces:
    """Runs of repeated anchors as they are; those of frequent ones window by window."""
    st = status[np.searchsorted(keys, s.key)] if len(keys) else np.zeros(0, np.uint8)
    cold, hot = np.flatnonzero(st == 1), np.flatnonzero(st == 2)
    n = s.count[hot]
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    windows, owner = np.repeat(s.low[hot], n) + inner, np.concatenate([cold, np.repeat(hot, n)])
    low = np.concatenate([s.low[cold], windows])
    doc, one = s.doc[owner], np.ones(len(windows), np.int64)
    key = np.concatenate([s.key[cold], span_hashes(s.sums, windows, windows + law.span)])
    rel = np.concatenate([s.rel[cold], 0 * one])
    return Pieces(key, low, np.concatenate([s.count[cold], one]), rel, s.docs[doc], low - s.first[doc] if law.same_doc else np.zeros(len(low), np.int64))


@dataclass
class Contexts:
    """What a chunk knows of its repeated prefixes."""

    pieces: list[Pieces]  # of each slice
    of: list[np.ndarray]  # for each slice: the context of each piece
    key: np.ndarray  # of each distinct context, sorted
    doc: np.ndarray  # its first place
    start: np.ndarray
    source: list[tuple[int, int]]  # slice and piece of that


def _distinct(columns: list[np.ndarray], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by columns, then place: the order, the heads of equal columns in it, the group of each element."""
    at = np.lexsort((start, doc, *columns[::-1]))
    new = np.zeros(len(at), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[at][1:] != c[at][:-1]
    group = np.empty(len(at), np.int64)
    group[at] = np.cumsum(new) - 1
    return at, np.flatnonzero(new), group


def contexts(parts: list[Slice], law: Law, status: np.ndarray, keys: np.ndarray) -> Contexts:
    found = [pieces(s, law, status, keys) for s in parts]
    cols = []
    for k, (s, p) in enumerate(zip(parts, found, strict=True)):
        identity = span_hashes(s.sums, p.low, p.low + p.count + law.span - 1) ^ mix((p.rel << 32 | p.count).astype(np.uint64))
        cols.append((p.key, identity, p.doc, p.start, np.full(len(p.key), k), np.arange(len(p.key))))
    key, identity, doc, start, piece, place = (np.concatenate(c) for c in zip(*cols, strict=True))
    at, head, group = _distinct([key, identity], doc, start)
    first = at[head]
    of = np.split(group, np.cumsum([len(p.key) for p in found])[:-1])
    return Contexts(found, of, key[first], doc[first], start[first], list(zip(piece[first].tolist(), place[first].tolist(), strict=True)))


def _heard(table: pa.Table, kind: int) -> list[list[np.ndarray]]:
    return [unbundle(d) for _, _, d in letters(table, kind)]


def _known(table: pa.Table, answers: pa.Table, law: Law) -> tuple[list[Slice], Contexts]:
    parts = list(cut(table, law))
    keys, _ = _anchors(parts, law)
    status = np.concatenate([np.zeros(0, np.uint8), *(a[0] for a in _heard(answers, FIRST))])
    return parts, contexts(parts, law, status, keys)


def ask_contexts(law: Law, parts: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return messages([])
        cuts, known = _known(table, answers, law)
        chunk, out, texts = table["chunk"][0].as_py(), [], []
        counts = np.array([known.pieces[i].count[r] for i, r in known.source], np.uint32)
        rels = np.array([known.pieces[i].rel[r] for i, r in known.source], np.uint16)
        for i, r in known.source:
            s, p = cuts[i], known.pieces[i]
            a, b = p.low[r], p.low[r] + p.count[r] + law.span - 1
            texts.append(s.raw[s.starts[a] : s.ends[b - 1]].tobytes() if law.words else s.raw[a:b].tobytes())
        sizes = np.array([len(t) for t in texts], np.uint32)
        for p, a, b in by_part(known.key, parts):
            blob = np.frombuffer(b"".join(texts[a:b]), np.uint8)
            out.append((p, chunk, SECOND, bundle(steps(known.key[a:b]), known.doc[a:b], known.start[a:b], counts[a:b], rels[a:b], sizes[a:b], blob)))
        return messages(out)

    return run


def answer_contexts(index: Index):
    def run(table: pa.Table) -> pa.Table:
        said = [(part, chunk, unbundle(data)) for part, chunk, data in letters(table)]
        found: dict[tuple[int, int, int, bytes], int] = {}
        rows: list[Context] = []
        which = []
        for _, _, (keys, docs, starts, counts, rels, sizes, blob) in said:
            ends, raw, own, at = np.cumsum(sizes).tolist(), blob.tobytes(), [], 0
            for key, doc, start, count, rel, end in zip(np.cumsum(keys, dtype=np.uint64).tolist(), docs.tolist(), starts.tolist(), counts.tolist(), rels.tolist(), ends, strict=True):
                text, at = raw[at:end], end
                i = found.setdefault((key, count, rel, text), len(rows))
                if i == len(rows):
                    rows.append(Context(key, (doc, start), count, rel, text))
                elif (doc, start) < rows[i].place:
                    rows[i].place = (doc, start)
                own.append(i)
            which.append(own)
        flags, out = index(rows), []
        for (part, chunk, m), own in zip(said, which, strict=True):
            mine = np.array([rows[i].place == (d, s) for i, d, s in zip(own, m[1].tolist(), m[2].tolist(), strict=True)], bool)
            bits = np.concatenate([np.zeros(0, bool), *(flags[i] for i in own)])
            out.append((part, chunk, SECOND, bundle(np.packbits(mine), np.packbits(bits), np.array([len(mine), len(bits)]))))
        return messages(out)

    return run


def covered(cuts: list[Slice], known: Contexts, answers: pa.Table, law: Law) -> list[np.ndarray]:
    """For each slice: which units a window covers that also starts earlier. A later
    occurrence of a whole context has all its windows earlier."""
    heard = [[np.unpackbits(bits, count=n).astype(bool) for bits, n in zip(m[:2], m[2].tolist(), strict=True)] for m in _heard(answers, SECOND)]
    mine, bits = (np.concatenate([np.zeros(0, bool), *(h[k] for h in heard)]) for k in range(2))
    counts = np.array([known.pieces[i].count[r] for i, r in known.source], np.int64)
    at = np.cumsum(counts) - counts
    out = []
    for s, p, of in zip(cuts, known.pieces, known.of, strict=True):
        marks = np.zeros(len(s.sums) + law.span, np.int32)
        first = mine[of] & (p.doc == known.doc[of]) & (p.start == known.start[of])
        inner = np.arange(p.count.sum()) - np.repeat(np.cumsum(p.count) - p.count, p.count)
        windows = np.repeat(p.low, p.count) + inner
        again = np.where(np.repeat(first, p.count), bits[np.repeat(at[of], p.count) + inner] if len(bits) else False, True)
        np.add.at(marks, windows[again], 1)
        np.add.at(marks, windows[again] + law.span, -1)
        out.append(np.cumsum(marks[: s.first[-1]]) > 0)
    return out


SCHEMA = "doc_id long, n_units long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_units", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary())])


def remove(law: Law):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if table.num_rows:
            cuts, known = _known(table, answers, law)
            for s, gone in zip(cuts, covered(cuts, known, answers, law), strict=True):
                for i in range(len(s.docs)):
                    raw = s.raw[s.bounds[i] : s.bounds[i + 1]]
                    g = gone[s.first[i] : s.first[i + 1]]
                    removed, spans = int(g.sum()), []
                    if removed:
                        edge = np.flatnonzero(np.diff(np.concatenate(([False], g, [False])).astype(np.int8)))
                        spans = [{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()]
                    if law.words:
                        words = raw.tobytes().split()
                        kept = b" ".join([w for w, x in zip(words, g.tolist(), strict=True) if not x] if removed else words)
                    else:
                        kept = raw[~g].tobytes() if removed else raw.tobytes()
                    rows.append((int(s.docs[i]), len(g), removed, spans, kept))
        ids_ = table["doc_id"].to_pylist()
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.table([pa.array(ids_, pa.int64()), *(pa.array(list(c), f.type) for c, f in list(zip(columns, ARROW, strict=True))[1:])], schema=ARROW)

    return run


def without_repeats(docs: DataFrame, law: Law, index: Index, id_col: str, text: str, chunk_bytes: int) -> DataFrame:
    """One row per document: doc_id, n_units, n_removed, spans (in units), kept (bytes)."""
    chunks = Chunks(docs, id_col, text, chunk_bytes, 4 * chunk_bytes)
    first = chunks.answer(chunks.ask(ask_anchors(law, chunks.parts)), answer_anchors(law))
    second = chunks.answer(chunks.hear(first, ask_contexts(law, chunks.parts), MESSAGE), answer_contexts(index))
    return chunks.hear(first.unionByName(second), remove(law), SCHEMA)
