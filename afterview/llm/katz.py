"""Language-model scoring: Katz backoff over words, pairs and triples of the whole corpus.

P(w | h) = d(c) * c / c(h)            if the n-gram h w occurred c > 0 times in training,
           alpha(h) * P(w | h')       otherwise; h' is h without its first word,
P(w)     = (c(w) + 1) / (N + V + 1)   (one share is for all unknown words),

with Good-Turing discounts d(r) for r <= DISCOUNTED, of each order, and alpha(h)
such that the probabilities of all words after h, the unknown one included, add
up to one. A text starts after a start mark and ends with an end token. `order`
is 2 or 3; a history that was never seen has alpha 1.

The n-gram tables are cut into parts: words by their hash, pairs and triples by
their history. Chunks of documents send a part their distinct n-grams with
training counts; the part adds up the counts of all chunks and sends back what
the asking chunk cannot know: what others add to each count, whether others have
the n-gram, and then its number, which names it as a history of the next order.
The sums over a history from which alpha follows (without what the chunk has
itself) go only to chunks with something unseen after it; of other histories one
bit says whether any count is discounted. Words are numbered by falling count; in
the messages of pairs a word is its count and its number among those of the same
count, and in those of triples, whose history ends in v, its place among the words
that follow v. Frequent histories are split over several parts by their last word,
and their sums are added in the chunk.

What occurs in one chunk alone is counted there: a word or pair of one chunk
alone is a history whose sums need no exchange, and an n-gram that ends in such a
word or pair is of that chunk alone too. Of those after a history that other
chunks have, the part hears the counts, for its sums, but not which they are.

For alpha of a pair (u, v) the mass of P(w | v) over the seen triples is needed.
Each such (v, w) was seen too, so that mass is a sum of discounted counts over
c(v), and whole numbers are exchanged: how many of the triples have c(v, w) = r.
"""

from __future__ import annotations

import functools
import json
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import documents, flat, slices
from .packs import MESSAGE, NO_ID, Chunks, bundle, by_part, ids, letters, messages, part_of, steps, unbundle
from .textnum import WHITE, byte_sums, mix, span_hashes, word_spans

ORDER = 3
DISCOUNTED = 5
#: Training tokens after which a history is split over one more part.
HOT_CONTEXT = 500_000
END, START = np.uint64(1), np.int64(-1)
WORDS, PAIRS, TRIPLES, STATS = 1, 2, 3, 9
#: Words of text that one chunk may hold, about: the sorts of its n-grams fit in memory.
CHUNK_BYTES = 8 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SLICE_BYTES = 1 << 18
BLOCKS = 8
#: Masks of the first 0 .. 8 bytes.
LEADING = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def tight(a: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in the least type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


def held_out(doc_ids: np.ndarray) -> np.ndarray:
    """A seventh of the documents, by their ids, that training leaves out; a null id is trained on."""
    return np.array([i != NO_ID and zlib.crc32(str(i).encode()) % 7 == 2 for i in doc_ids.tolist()], bool)


def inner_steps(a: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Differences within runs of the given sizes, whose first numbers stay; below zero they wrap round."""
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    a = tight(a)
    out = steps(a)
    out[first] = a[first]
    return out


def inner_sums(d: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Undoes inner_steps."""
    sizes = sizes[sizes > 0]
    first = np.cumsum(sizes) - sizes
    out = np.cumsum(d, dtype=d.dtype)
    return out - np.repeat(out[first] - d[first], sizes)


def sparse(columns: np.ndarray) -> list[np.ndarray]:
    """Which of at most 16 columns are above zero in each row, and each column's numbers that are."""
    return [sum(((c > 0).astype(np.uint16) << i for i, c in enumerate(columns)), np.uint16(0)), *(c[c > 0] for c in columns)]


def word_keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of raw[start:end] for each word: eight bytes at a time, and that of all
    spans for words of more than BLOCKS times eight."""
    length = ends - starts
    eights = np.ndarray(len(raw) + 1, "<u8", np.append(raw, np.zeros(8, np.uint8)), strides=(1,))
    out, on = mix(length.astype(np.uint64)), np.arange(len(length))
    for block in range(BLOCKS):
        left = length[on] - 8 * block
        out[on] = mix(out[on] ^ (eights[starts[on] + 8 * block] & LEADING[np.minimum(left, 8)]))
        on = on[left > 8]
    if len(on):
        out[on] = span_hashes(byte_sums(raw), starts[on], ends[on])
    return out


def in_order(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 on sorted, and their places, those of equal ones in order;
    sorted as one number each where that has 63 bits."""
    bits = len(a).bit_length()
    if int(a.max(initial=0)) >> (63 - bits):
        at = np.argsort(a, kind="stable")
        return a[at], at
    both = np.sort(a << bits | np.arange(len(a)))
    return both >> bits, both & ((1 << bits) - 1)


def heads(*columns: np.ndarray) -> np.ndarray:
    """Where in sorted columns something new begins."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def runs(a: np.ndarray) -> np.ndarray:
    """How often each number stands in a row."""
    return np.diff(np.append(np.flatnonzero(heads(a)), len(a))) if len(a) else np.zeros(0, np.int64)


class Tokens:
    """The tokens of a chunk: their distinct keys and the place of each among them."""

    def __init__(self, table: pa.Table):
        self.docs = ids(table)
        self.out = held_out(self.docs)
        buf, bounds = flat(table["text"])
        keys, counts = [], []
        for a, b in slices(bounds, SLICE_BYTES):
            raw, at = LOWER[buf[bounds[a] : bounds[b]]], bounds[a : b + 1] - bounds[a]
            starts, ends, first = word_spans(raw, WHITE, at)
            words = word_keys(raw, starts, ends)
            n = np.diff(first)
            every = np.full(len(words) + len(n), END, np.uint64)
            inside = np.ones(len(every), bool)
            inside[first[1:] + np.arange(len(n))] = False
            every[inside] = words
            keys.append(every)
            counts.append(n + 1)
        self.sizes = np.concatenate([np.zeros(0, np.int64), *counts])
        found = pa.array(np.concatenate([np.zeros(0, np.uint64), *keys])).dictionary_encode()
        self.key, self.place = found.dictionary.to_numpy(), found.indices.to_numpy()
        self.renumber(np.argsort(self.key))
        self.first = np.cumsum(self.sizes) - self.sizes
        self.trained = np.repeat(~self.out, self.sizes)

    def train(self) -> np.ndarray:
        """Training counts of the keys."""
        return np.bincount(self.place[self.trained], minlength=len(self.key))

    def before(self) -> np.ndarray:
        """The place of what stands before each token; the start mark's is behind all keys."""
        out = np.empty_like(self.place)
        out[1:] = self.place[:-1]
        out[self.first] = len(self.key)
        return out

    def renumber(self, order: np.ndarray) -> None:
        """Puts the keys in another order."""
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.key, self.place = self.key[order], rank[self.place]


def _stat(part: int, n: int = 0, v: int = 0, pairs=None, triples=None) -> tuple[int, int, int, bytes]:
    """To no chunk, but spread over the exchange like what goes to chunks."""
    none = [0] * (DISCOUNTED + 1)
    return part, -1 - part % 997, STATS, json.dumps({"n": n, "v": v, "pairs": pairs or none, "triples": triples or none}).encode()


def _rare(counts: np.ndarray) -> list[int]:
    """How many of the counts are 1, 2, ... DISCOUNTED + 1."""
    return np.bincount(np.minimum(counts, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2].tolist()


def ask_words(parts: int):
    def run(table: pa.Table) -> pa.Table:
        t, chunk = Tokens(table), table["chunk"][0].as_py()
        train = t.train()
        return messages([(p, chunk, WORDS, bundle(steps(t.key[a:b]), tight(train[a:b]))) for p, a, b in by_part(t.key, parts)])

    return run


def answer_words(table: pa.Table) -> pa.Table:
    """To each chunk: which of its words other chunks have (all, if no other chunk asks
    the part); their numbers within the part, by falling count; of the last number to the
    first the training counts, and of each count that occurs, the number at which it begins."""
    said = [(p, c, *unbundle(d)) for p, c, d in letters(table)]
    own = [np.cumsum(k, dtype=np.uint64) for _, _, k, _ in said]
    keys, place = np.unique(np.concatenate(own), return_inverse=True)
    total = np.bincount(place, np.concatenate([c for *_, c in said]), len(keys)).astype(np.int64)
    shared = np.bincount(place, minlength=len(keys)) >= min(2, len(said))
    rank = np.empty(len(keys), np.int64)
    order = np.lexsort((-total, ~shared))
    rank[order] = np.arange(len(keys))
    falling = -total[order[: shared.sum()]]
    out = [_stat(said[0][0], n=int(total.sum()), v=int((total > 0).sum()))]
    at = 0
    for (part, chunk, *_), k in zip(said, own, strict=True):
        mine = place[at : at + len(k)]
        at += len(k)
        named = mine[shared[mine]]
        by = rank[named]
        count = total[named[np.argsort(-by)]]
        begins = np.searchsorted(falling, -count[heads(count)][::-1]) if len(count) else count
        out.append((part, chunk, WORDS, bundle(np.packbits(shared[mine]), *map(tight, (by, steps(count), steps(begins))))))
    return messages(out)


def _joined(arrays: list[np.ndarray], dtype: type = np.int64) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *arrays]).astype(dtype)


def _bits(packed: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    return _joined([np.unpackbits(x, count=n) for x, n in zip(packed, sizes.tolist(), strict=True)], bool)


def _words(t: Tokens, answers: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The number (place * parts + part) of each distinct word that other chunks have, and
    that among the words of the same count; the training count of all, and whether other
    chunks have it."""
    said = [(part, *unbundle(data)) for part, _, data in letters(answers, WORDS)]
    shared = _bits([bits for _, bits, *_ in said], np.array([b - a for _, a, b in by_part(t.key, parts)], np.int64))
    name, near, count = np.full(len(t.key), NO_ID), np.full(len(t.key), NO_ID), t.train()
    names, nears, counts = [], [], []
    for part, _, rank, risen, begins in said:
        rank, total, at = rank.astype(np.int64), np.cumsum(risen, dtype=np.int64), np.argsort(-rank.astype(np.int64))
        begin, each = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        if len(rank):
            begin[at] = np.cumsum(begins, dtype=np.int64)[::-1][np.cumsum(heads(total)) - 1]
        each[at] = total
        names.append(rank * parts + part)
        nears.append((rank - begin) * parts + part)
        counts.append(each)
    name[shared], near[shared], count[shared] = _joined(names), _joined(nears), _joined(counts)
    return name, near, count, shared


class Grams:
    """The distinct n-grams of a chunk as (history, word), grouped by entry (a
    history, or a share of a frequent one) and part."""

    def __init__(self, history: np.ndarray, place: np.ndarray, trained: np.ndarray, words: int):
        """history, place: of each occurrence, as small numbers."""
        code, at = in_order(history * (words + 1) + place)
        new = heads(code)
        self.of = np.empty(len(code), np.int64)
        self.of[at] = np.cumsum(new) - 1
        code, self.at = code[new], at[new]  # an occurrence of each
        self.train = np.bincount(self.of[trained], minlength=len(code)).astype(np.uint32)
        self.history = code // (words + 1)
        self.word = code - self.history * (words + 1)

    def deal(self, wanted: np.ndarray, named: np.ndarray, name: np.ndarray, total: np.ndarray, home: np.ndarray, salted: np.ndarray, parts: int) -> None:
        """Puts the n-grams of the wanted histories in the order in which they are sent.
        wanted, name, total, home: of each history; named: the n-grams that other chunks
        may have trained on; salted: a hash of each word. The shares of a history go to the part
        `home` and those behind it."""
        histories = np.flatnonzero(wanted)
        shares = 1 + total[histories] // HOT_CONTEXT
        at = np.cumsum(shares) - shares
        entry_history = np.repeat(np.arange(len(histories)), shares)
        entry_salt = np.arange(len(entry_history)) - at[entry_history]
        part = (home[histories][entry_history] + entry_salt) % parts
        by = in_order(name[histories][entry_history] - START)[1]  # then salts are in order, as they were made
        order = by[np.argsort(part[by].astype(np.uint16 if parts < 1 << 16 else np.int64), kind="stable")]
        self.histories, self.entry_order = histories, order
        self.entry_bounds = np.searchsorted(part[order], np.arange(parts + 1))
        self.entry_history, self.entry_salt = histories[entry_history[order]], entry_salt[order]
        self.entry_name = name[self.entry_history]
        of, split = np.zeros(len(wanted), np.int64), np.ones(len(wanted), np.int64)
        of[histories], split[histories] = at, shares
        held = wanted[self.history]
        self.entry_asks = (split > 1)[self.entry_history]  # a share doesn't hear whether another has something unseen
        unseen = np.zeros(len(wanted), bool)
        unseen[self.history[~named & (self.train == 0)]] = True
        self.entry_asks |= unseen[self.entry_history]
        self.sent, self.size, self.sent_bounds = self._dealt(held & named, of, split, salted)
        self.rest, self.rest_size, self.rest_bounds = self._dealt(held & ~named & (self.train > 0), of, split, salted)

    def _dealt(self, which: np.ndarray, of: np.ndarray, split: np.ndarray, salted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those n-grams by entry, then by word; their number in each entry, and the bounds of the parts among them."""
        which = np.flatnonzero(which)
        history = self.history[which]
        entry, hot = of[history], np.flatnonzero(split[history] > 1)
        if len(hot):
            entry[hot] += (salted[self.word[which[hot]]] % split[history[hot]].astype(np.uint64)).astype(np.int64)
            which = which[np.argsort(entry, kind="stable")]
        size = np.bincount(entry, minlength=len(self.entry_order))
        begin = (np.cumsum(size) - size)[self.entry_order]
        size = size[self.entry_order]
        ends = np.cumsum(size)
        return which[np.repeat(begin - ends + size, size) + np.arange(len(which))], size, np.append(0, ends)[self.entry_bounds]

    def letters(self, chunk: int, kind: int, word_name: np.ndarray, lower: np.ndarray, parts: int) -> list[tuple[int, int, int, bytes]]:
        """word_name: of each word among those of its count, for triples of each n-gram's word after its history;
        lower: the count of each n-gram's end in the order below."""
        out = []
        for p in self.asked().tolist():
            e, b, r = slice(*self.entry_bounds[p : p + 2]), self.sent[slice(*self.sent_bounds[p : p + 2])], self.rest[slice(*self.rest_bounds[p : p + 2])]
            entries = (steps(self.entry_name[e] - START), self.entry_salt[e], self.size[e], self.rest_size[e])
            if kind == PAIRS:  # whose words are in the order of falling counts
                words, at = in_order(self.word[b])
                new = heads(words)
                index = np.empty(len(b), np.int64)
                index[at] = np.cumsum(new) - 1
                count = lower[b[at[new]]]
                place, ends = index, (steps(count[::-1]), inner_steps(word_name[words[new]], runs(count)))
            else:
                place, ends = word_name[b], (np.where(self.train[b] > 0, lower[b], 0),)
            out.append((p, chunk, kind, bundle(*map(tight, (*entries, self.train[b], self.train[r], lower[r], np.packbits(self.entry_asks[e]))), inner_steps(place, self.size[e]), *map(tight, ends))))
        own = np.ones(len(self.word), bool)
        own[self.sent] = False
        return [(chunk % parts, chunk, STATS, bundle(np.array(_rare(self.train[own]), np.int64))), *out]

    def asked(self) -> np.ndarray:
        """The parts that are asked, and so answer."""
        return np.flatnonzero(np.diff(self.entry_bounds))

    def shared(self, said: list[list[np.ndarray]]) -> np.ndarray:
        """Of the pairs sent, which other chunks have."""
        return _bits([x[SUMS[PAIRS] + 2] for x in said], np.diff(self.sent_bounds)[self.asked()])

    def totals(self, answers: pa.Table, kind: int) -> np.ndarray:
        """Training counts of the n-grams: the chunk's own, and what the parts add to those sent."""
        out = self.train.astype(np.int64)
        said = [unbundle(x) for _, _, x in letters(answers, kind)]
        to = self.sent[self.shared(said)] if kind == PAIRS else self.sent
        out[to] += _joined([x[SUMS[kind] + 1] for x in said])
        return out

    def masses(self, answers: pa.Table, kind: int, often: np.ndarray, total: np.ndarray, star: np.ndarray, lower: np.ndarray, d: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each history that has something unseen here the sum of the discounted counts of
        its n-grams, and that of their `lower`: of those of this chunk, and of the others as
        the parts say; of each history whether any of its counts is discounted. often: the
        counts of the histories; total, star, lower: the counts of the n-grams, plain and
        discounted, and what each has in the order below; d, below: the discounts of both orders."""
        n = len(often)
        mass, low = np.bincount(self.history, star, n), np.bincount(self.history, np.where(total > 0, lower, 0), n)
        some = np.zeros(n, bool)
        some[self.history[(total > 0) & (total <= DISCOUNTED)]] = True
        said = [unbundle(x) for _, _, x in letters(answers, kind)]
        if not said:
            return mass, low, some
        some[self.entry_history[_bits([h[SUMS[kind]] for h in said], np.diff(self.entry_bounds)[self.asked()])]] = True
        asks = self.entry_asks.copy()
        asks[np.repeat(np.arange(len(self.size)), self.size)[total[self.sent] == 0]] = True
        history = self.entry_history[asks]
        filled = np.concatenate([h[0] for h in said])

        def row(i: int) -> np.ndarray:
            out = np.zeros(len(filled))
            out[np.flatnonzero(filled >> (i - 1) & 1)] = np.concatenate([h[i] for h in said])
            return out

        at = lambda x: np.bincount(history, x, n)  # noqa: E731 (shares of a history together)
        rows = [(r, row(r - 1)) for r in range(2, DISCOUNTED + 1)]  # row 0 of sums_of is not sent
        high = row(DISCOUNTED)
        # something follows each time that a history occurs, so what follows once is what is left
        once = often - np.bincount(self.history, total, n) - at(sum(r * x for r, x in rows) + high)
        mass += at(sum(d[r] * r * x for r, x in rows) + high)
        heard = np.zeros(n, bool)
        heard[history] = True
        mass[heard] += d[1] * once[heard]
        if kind == PAIRS:
            return mass, low + at(row(DISCOUNTED + 1)), some
        return mass, low + at(sum(below[r] * r * row(DISCOUNTED + r) for r in range(1, DISCOUNTED + 1)) + row(2 * DISCOUNTED + 1)), some


def spread(owner: np.ndarray, counts: np.ndarray, out: np.ndarray) -> None:
    """By owner: how many counts are 1, 2, ... DISCOUNTED, and the sum of the greater ones."""
    n = out.shape[1]
    low = counts <= DISCOUNTED
    at = owner[low]
    out[:DISCOUNTED] = np.bincount(at * (DISCOUNTED + 1) + counts[low], minlength=n * (DISCOUNTED + 1)).reshape(n, DISCOUNTED + 1).T[1:]
    high = np.flatnonzero(~low)
    out[DISCOUNTED] = np.bincount(owner[high], counts[high], out.shape[1])


#: Rows of sums_of.
SUMS = {PAIRS: DISCOUNTED + 2, TRIPLES: 2 * DISCOUNTED + 2}


def sums_of(owner: np.ndarray, total: np.ndarray, lower: np.ndarray, n: int, kind: int) -> np.ndarray:
    """What alpha of a history is made from: the spread of its n-grams' counts, and
    for pairs the unigram shares, for triples the spread of the lower counts."""
    out = np.zeros((SUMS[kind], n), np.int64)
    spread(owner, total, out[: DISCOUNTED + 1])
    lower = np.where(total > 0, lower + (kind == PAIRS), 0)
    if kind == TRIPLES:
        spread(owner, lower, out[DISCOUNTED + 1 :])
    else:
        out[DISCOUNTED + 1] = np.bincount(owner, lower, n)
    return out


def answer_grams(kind: int):
    """To each chunk: for those of its entries in which it has something unseen the sums of
    sums_of but for the first, of what it has not itself; for all entries whether any count
    is discounted; what the other chunks add to the training count of each n-gram that it
    has; and (of pairs) which of them other chunks have, the number of the entry's first
    such pair in the part and how far each comes behind it."""

    def run(table: pa.Table) -> pa.Table:
        said = [(p, c, unbundle(d)) for p, c, d in letters(table, kind)]
        rare = np.zeros(DISCOUNTED + 1, np.int64)
        for *_, d in letters(table, STATS):
            rare += unbundle(d)[0]
        part = table["part"][0].as_py()
        if not said:
            return messages([_stat(part, **{"pairs" if kind == PAIRS else "triples": rare.tolist()})])
        gather = lambda i: np.concatenate([m[i] for *_, m in said]).astype(np.int64)
        name = np.concatenate([np.cumsum(m[0], dtype=np.int64) for *_, m in said])
        salt = gather(1)
        order = np.lexsort((salt, name)) if salt.any() else in_order(name)[1]
        new = heads(name[order], salt[order])
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        entries = int(new.sum())
        held, held_rest = (np.repeat(np.arange(len(entry)), gather(i)) for i in (2, 3))
        owner = entry[held]
        places = [inner_sums(m[8], m[2]) for *_, m in said]
        if kind == PAIRS:
            counts = [np.cumsum(m[9], dtype=np.int64)[::-1] for *_, m in said]
            count, near = np.concatenate(counts), np.concatenate([inner_sums(m[10].astype(np.int64), runs(c)) for (*_, m), c in zip(said, counts, strict=True)])
            place = np.repeat(np.cumsum([0, *map(len, counts[:-1])]), [len(m[4]) for *_, m in said]) + np.concatenate(places)
            order = np.lexsort((near, -count))
            new = heads(count[order], near[order])
            word = np.empty(len(order), np.int64)
            word[order] = np.cumsum(new) - 1
            code, lower = word[place], count[place]
        else:
            code, lower = _joined(places), gather(9)
        span = int(code.max(initial=0)) + 1
        order = in_order(owner * span + code)[1] if entries * span < 2**62 else np.lexsort((code, owner))
        new = heads(owner[order], code[order])
        head = np.flatnonzero(new)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        of, train, rest, rest_lower = owner[order[head]], gather(4), gather(5), gather(6)
        total = np.add.reduceat(train[order], head) if len(head) else np.zeros(0, np.int64)
        if kind == PAIRS:
            lower = lower[order[head]]
        else:
            lower = np.maximum.reduceat(lower[order], head) if len(head) else lower
        del order, new
        added = total[group]
        some = np.zeros(entries, bool)
        some[of[(total > 0) & (total <= DISCOUNTED)]] = True
        some[entry[held_rest[rest <= DISCOUNTED]]] = True
        asks = _bits([m[7] for *_, m in said], np.array([len(m[0]) for *_, m in said]))
        asks[held[added == 0]] = True
        sums = sums_of(of, total, lower, entries, kind) + sums_of(entry[held_rest], rest, rest_lower, entries, kind)
        to, mine, mine_rest = np.cumsum(asks) - 1, asks[held], asks[held_rest]
        others = sums_of(to[np.concatenate([held[mine], held_rest[mine_rest]])], np.concatenate([added[mine], rest[mine_rest]]), np.concatenate([lower[group[mine]], rest_lower[mine_rest]]), int(asks.sum()), kind)
        added -= train
        for i, own in enumerate(others):
            np.subtract(sums[i, entry[asks]], own, out=own)
        shared = np.bincount(group, minlength=len(head)) > 1  # by chunks, whether they train on it or not
        number = np.cumsum(shared) - 1
        base = np.cumsum(np.bincount(of[shared], minlength=entries))
        base = np.append(0, base[:-1])
        behind = number - base[of]
        out = [_stat(part, **{"pairs" if kind == PAIRS else "triples": (rare + _rare(total)).tolist()})]
        at = gram = ask = 0
        for p, chunk, m in said:
            its, grams, more = entry[at : at + len(m[0])], group[gram : gram + len(m[4])], int(asks[at : at + len(m[0])].sum())
            extra = added[gram : gram + len(grams)]
            answer = [*sparse(others[1:, ask : ask + more]), np.packbits(some[its])]
            if kind == PAIRS:
                both = shared[grams]
                size = np.bincount(held[gram : gram + len(grams)][both] - at, minlength=len(its))
                numbers = [np.packbits(both), tight(steps(base[its])), inner_steps(behind[grams[both]], size)]
            else:
                both, numbers = slice(None), []
            out.append((p, chunk, kind, bundle(*map(tight, answer), tight(extra[both]), *numbers)))
            at, gram, ask = at + len(its), gram + len(grams), ask + more
        return messages(out)

    return run


@dataclass
class Pairs:
    """Tokens and pairs of a chunk, dealt."""

    tokens: Tokens
    name: np.ndarray  # of words
    near: np.ndarray  # the same among the words of one count
    count: np.ndarray
    grams: Grams
    often: np.ndarray  # how often words occur as histories; the start mark last
    total: np.ndarray | None = None  # of pairs, where the parts have answered

    @classmethod
    def of(cls, table: pa.Table, answers: pa.Table, parts: int) -> Pairs:
        t = Tokens(table)
        name, near, count, shared = _words(t, answers, parts)
        words = len(t.key)
        ends = count[np.searchsorted(t.key, END)] if words else 0
        order = np.lexsort((near, -count))
        t.renumber(order)
        name, near, count, shared = name[order], near[order], count[order], shared[order]
        g = Grams(t.before(), t.place, t.trained, words)
        total = np.append(count, ends)  # the start mark occurs once per text, like the end
        wanted = np.append(shared, True) & (np.bincount(g.history, minlength=words + 1) > 0) & (total > 0)
        g.deal(wanted, (shared & (count > 0))[g.word], np.append(name, START), total, part_of(mix(np.append(t.key, np.uint64(2))), parts), mix(t.key), parts)
        return cls(t, name, near, count, g, total)

    def lower(self) -> np.ndarray:
        return self.count[self.grams.word]

    def listen(self, answers: pa.Table) -> None:
        self.total = self.grams.totals(answers, PAIRS)


@dataclass
class Triples:
    """Triples of a chunk, those of shared histories dealt."""

    grams: Grams
    inner: np.ndarray  # the tokens that have two before them
    lower: np.ndarray  # of each triple the pair at its end
    place: np.ndarray  # of that pair's word among all that follow the middle word, where other chunks have the pair

    @classmethod
    def of(cls, p: Pairs, answers: pa.Table, parts: int) -> Triples:
        t, pairs = p.tokens, p.grams
        inner = np.ones(len(t.place), bool)
        inner[t.first] = False
        inner = np.flatnonzero(inner)
        g = Grams(pairs.of[inner - 1], t.place[inner], t.trained[inner], len(t.key))
        lower = pairs.of[inner[g.at]]
        said = [unbundle(x) for *_, x in letters(answers, PAIRS)]
        name, place, shared = np.full(len(pairs.word), -1, np.int64), np.zeros(len(pairs.word), np.int64), np.zeros(len(pairs.word), bool)
        both = pairs.shared(said)
        to, entry = pairs.sent[both], np.repeat(np.arange(len(pairs.size)), pairs.size)[both]
        shared[to] = True
        size = np.bincount(entry, minlength=len(pairs.size))
        behind = _joined([inner_sums(x[-1], size[slice(*pairs.entry_bounds[k : k + 2])]) for k, x in zip(pairs.asked(), said, strict=True)])
        base = _joined([np.cumsum(x[-2], dtype=np.int64) | k << 32 for k, x in zip(pairs.asked(), said, strict=True)])
        name[to] = base[entry] + behind
        place[to] = behind * (1 + p.often[pairs.entry_history[entry]] // HOT_CONTEXT) + pairs.entry_salt[entry]
        wanted = shared & (np.bincount(g.history, minlength=len(shared)) > 0) & (p.total > 0)
        # where the pair is numbered: then the numbers that go to a part lie close together
        g.deal(wanted, (shared & (p.total > 0))[lower], name, p.total, name >> 32, mix(t.key), parts)
        return cls(g, inner, lower, place)


def ask_pairs(parts: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return messages([])
        p = Pairs.of(table, answers, parts)
        return messages(p.grams.letters(table["chunk"][0].as_py(), PAIRS, p.near, p.lower(), parts))

    return run


def ask_triples(parts: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return messages([])
        p = Pairs.of(table, answers, parts)
        p.listen(answers)
        t = Triples.of(p, answers, parts)
        return messages(t.grams.letters(table["chunk"][0].as_py(), TRIPLES, t.place[t.lower], p.total[t.lower], parts))

    return run


def discounts(counts: list[int]) -> np.ndarray:
    """Good-Turing discounts d[0..DISCOUNTED] of Katz from the numbers of n-grams
    that occurred 1 .. DISCOUNTED + 1 times, and the 1 of greater counts behind them.
    Where the numbers are too few to give one strictly between 0 and 1, half a count
    is taken off."""
    d = np.ones(DISCOUNTED + 2)
    n = [0, *counts]
    high = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    for r in range(1, DISCOUNTED + 1):
        value = ((r + 1) * n[r + 1] / (r * n[r]) - high) / (1 - high) if n[r] and high < 1 else 0.0
        d[r] = value if 0 < value < 1 else 1 - 0.5 / r
    return d


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return d[np.minimum(c, DISCOUNTED + 1)] * c


def history_weights(total: np.ndarray, mass: np.ndarray, below: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scale of the discounted counts of seen words, alpha) of each history from its
    count, the sum of those discounted counts, the lower order's mass of the same
    words, and whether any is discounted. A history whose seen words take all the mass
    gives one count of it to the others, so that alpha is above zero everywhere."""
    safe = np.maximum(total, 1)
    scale = np.where(some, 1.0, safe / (safe + 1.0))
    alpha = np.where(total > 0, (1 - mass / safe * scale) / np.maximum(1 - below, 1e-300), 1.0)
    return scale / safe, alpha


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def evaluate(parts: int, order: int = ORDER):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return ARROW.empty_table()
        stats = json.loads(next(d for p, _, d in letters(answers, STATS) if p == -1))
        n, v = stats["n"], stats["v"]
        p = Pairs.of(table, answers, parts)
        p.listen(answers)
        t, g, d = p.tokens, p.grams, discounts(stats["pairs"])
        one = (p.count + 1.0) / (n + v + 1.0)
        star = discounted(p.total, d)
        mass, low, some = g.masses(answers, PAIRS, p.often, p.total, star, p.lower() + 1.0, d, d)
        scale, alpha = history_weights(p.often, mass, low / (n + v + 1.0), some)
        # of each distinct pair, then of each token: seen at this order, or down by one
        two = np.where(p.total > 0, star * scale[g.history], alpha[g.history] * one[g.word])
        chance = np.log10(two)[g.of]
        if order > 2:
            x, d3 = Triples.of(p, answers, parts), discounts(stats["triples"])
            own, h = x.grams.totals(answers, TRIPLES), x.grams.history
            star3 = discounted(own, d3)
            mass, low, some = x.grams.masses(answers, TRIPLES, p.total, own, star3, star[x.lower], d3, d)
            # the word that a history (u, v) shares with the pairs (v, w) is its last
            scale3, alpha3 = history_weights(p.total, mass, low * scale[g.word], some)
            three = np.where(own > 0, star3 * scale3[h], alpha3[h] * two[x.lower])
            chance[x.inner] = np.log10(three)[x.grams.of]
        add = lambda a: np.add.reduceat(a, t.first)
        known = add((p.count[t.place] > 0).astype(np.int64))
        columns = [pa.array(t.out), pa.array(t.sizes), pa.array(known), pa.array(np.full(len(t.docs), n)), pa.array(add(np.log10(one)[t.place])), pa.array(add(chance))]
        return pa.table([table["doc_id"].combine_chunks(), *columns], schema=ARROW)

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", order: int = ORDER, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams), score (the model's log10 probability).

    A null or empty text is the end token alone; texts and words of any length are
    taken whole. Repeated rows count each time and get equal scores. A null id is
    trained on. Ties don't matter: only sums are formed. An empty table gives no
    rows; of the columns only the two named are read.
    """
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    chunks = Chunks(docs, id_col, text, chunk_bytes, 2 * chunk_bytes, level=6)
    parts = chunks.parts
    tables = [chunks.answer(chunks.ask(ask_words(parts)), answer_words)]
    for kind, ask in ((PAIRS, ask_pairs), (TRIPLES, ask_triples))[: order - 1]:
        tables.append(chunks.answer(chunks.hear(_all(tables), ask(parts), MESSAGE), answer_grams(kind)))
    stat = F.from_json(F.col("data").cast("string"), "n long, v long, pairs array<long>, triples array<long>")
    each = lambda c: F.array(*(F.sum(F.col(f"s.{c}")[i]) for i in range(DISCOUNTED + 1))).alias(c)
    # all columns are used and the filter, being random in form, is not pushed down, taken apart or given a null check: the exchange is the one that the chunks hear from
    found = _all(tables).where(F.coalesce(F.col("kind"), F.lit(0)) + F.floor(F.rand()) == STATS).select("part", "chunk", stat.alias("s"))
    added = found.agg(F.sum("s.n").alias("n"), F.sum("s.v").alias("v"), each("pairs"), each("triples"), F.max("part").alias("_1"), F.max("chunk").alias("_2"))
    told = added.select(F.lit(-1).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(chunks.count - 1))).alias("chunk"), F.lit(STATS).alias("kind"), F.to_json(F.struct("n", "v", "pairs", "triples", "_1", "_2")).cast("binary").alias("data"))
    return chunks.hear(_all([*tables, told.repartition(chunks.count, "chunk")]), evaluate(parts, order), SCHEMA)


def _all(tables: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, tables)


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole model, with triples."""
    return score_documents(documents(spark, sf_dir))
