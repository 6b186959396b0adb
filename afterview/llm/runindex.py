"""Repeated byte strings by a run-length index (run-compressed BWT with sampled run ends)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import documents
from .repeats import Context, Law, without_repeats

SPAN = 100
#: Symbols in one 63-bit word; 0 ends a string, then come the bytes, then block marks.
PACKED, BITS, BYTES = 7, 9, 257
BLOCKS = (1 << BITS) - BYTES
#: Symbols of the contexts that are indexed and streamed together.
GROUP_BYTES = 1_000_000


class RunLengthIndex:
    """Index of several strings of symbols, each closed by an end symbol.

    Kept are the runs of the Burrows-Wheeler transform (symbol, first row, the
    row that it maps to) and the text position at the first and last row of each
    run. Patterns are streamed against the runs; positions come from the samples
    alone. The suffix array is dropped when the index is built. `depth` bounds
    the lengths of matches that are told.

    For the common prefix of two text positions the ranks of the suffixes by
    their first 7, 14, 28, ... symbols are kept as well.
    """

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, depth: int):
        bounds = np.asarray(bounds, np.int64)
        strings, lengths = len(bounds) - 1, np.diff(bounds)
        self.depth = depth
        ends = bounds[1:] + np.arange(strings)  # of the end symbols
        n = len(symbols) + strings
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = symbols
        self.owner = np.repeat(np.arange(strings), lengths + 1)
        self.rest = (ends + 1)[self.owner] - np.arange(n)
        begins = np.append(0, ends[:-1] + 1) if strings else np.zeros(0, np.int64)
        rows = self._sorted(text)
        before = text[rows - 1]
        before[np.isin(rows, begins)] = 0
        new = np.append(True, before[1:] != before[:-1]) if n else np.zeros(0, bool)
        self.rows, self.begins = n, begins
        self.run_row = np.flatnonzero(new)
        self.run_symbol = before[self.run_row]
        size = np.diff(np.append(self.run_row, n))
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        through = np.cumsum(size[by_symbol]) - size[by_symbol]
        self.run_to = np.empty(len(size), np.int64)
        self.run_to[by_symbol] = through  # rows before which a symbol stands keep their order under that symbol
        self.run_last = self.run_row + size - 1
        self.head_at, self.tail_at = rows[self.run_row], rows[self.run_last]
        self.run_of = np.repeat(np.arange(len(size)), size)
        self.runs_by_symbol = by_symbol
        self.symbol_run = self.run_symbol[by_symbol] * max(1, len(size)) + by_symbol

    def _sorted(self, text: np.ndarray) -> np.ndarray:
        """The suffixes in order, equal ones by their string: prefix doubling, in which
        only suffixes that still tie are sorted again."""
        n = len(text)
        padded = np.append(text, np.zeros(PACKED, np.int64))
        self.word = np.zeros(n, np.int64)
        for k in range(PACKED):
            self.word = self.word << BITS | np.where(self.rest > k, padded[k : n + k], 0)
        order = np.argsort(self.word, kind="stable")
        rank, self.levels = np.zeros(n, np.int64), []
        key, open_, width = self.word[order], np.arange(n), PACKED
        while True:
            # open_: rows whose suffixes tied so far; key: what tells them apart now
            new = np.ones(len(open_), bool)
            new[1:] = key[1:] != key[:-1]
            head = np.flatnonzero(new)
            size = np.diff(np.append(head, len(open_)))
            rank[order[open_]] = np.repeat(open_[head], size)
            if width <= self.depth:
                self.levels.append((width, rank.copy()))
            open_ = open_[np.repeat(size > 1, size)]
            if not len(open_):
                return order
            suffix = order[open_]
            ended = self.rest[suffix] <= width  # all of a tie have ended, or none
            ahead = np.where(ended, self.owner[suffix], rank[np.minimum(suffix + width, n - 1)])
            key = rank[suffix] * (n + 1) + ahead
            by = np.argsort(key, kind="stable")
            order[open_], key = suffix[by], key[by]
            width *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of text positions, as far as `depth`."""
        n, out = self.rows, np.zeros(len(a), np.int64)
        for width, rank in self.levels[::-1]:
            x, y = np.minimum(a + out, n - 1), np.minimum(b + out, n - 1)
            same = (rank[x] == rank[y]) & (self.rest[a] > out + width) & (self.rest[b] > out + width)
            out[same] += width
        x, y = a + out, b + out
        differ = self.word[x] ^ self.word[y]
        bits = np.frexp(differ.astype(np.float64))[1]  # of 63
        left = np.where(differ == 0, PACKED, (PACKED * BITS - np.minimum(bits, PACKED * BITS)) // BITS)
        return np.minimum(out + left, np.minimum(self.rest[a], self.rest[b]) - 1)

    def stream(self, symbols: np.ndarray, bounds: np.ndarray, useful=None):
        """All patterns at once, from their ends backwards: (patterns, place, length of
        the longest match from there on, its text position).

        A row and its text position are carried along. Where the next symbol stands
        before the row, the match grows; where another one does, the nearest run
        of the symbol above or below takes over at its end, whichever has more in
        common, and the sample there gives the position. `useful(pattern, place,
        length)` may say which patterns are still worth their while.
        """
        lengths = np.diff(bounds)
        live = np.flatnonzero(lengths > 0)
        place = lengths[live] - 1
        row, at, length = np.zeros(len(live), np.int64), np.full(len(live), self.head_at[0] if self.rows else 0), np.zeros(len(live), np.int64)
        runs = max(1, len(self.run_row))
        while len(live):
            c = symbols[bounds[live] + place]
            run = self.run_of[row] if self.rows else row
            other = np.flatnonzero(self.run_symbol[run] != c) if self.rows else np.arange(len(live))
            if len(other):
                own = c[other] * runs + run[other]
                k = np.searchsorted(self.symbol_run, own)
                up, down = k - 1, k
                above = (up >= 0) & (self.symbol_run[up] // runs == c[other]) if self.rows else np.zeros(len(other), bool)
                below = down < len(self.symbol_run)
                below[below] = self.symbol_run[down[below]] // runs == c[other][below]
                best, best_row, best_at = np.full(len(other), -1), np.zeros(len(other), np.int64), np.full(len(other), self.head_at[0] if self.rows else 0)
                for there, which, rows_, samples in ((above, up, self.run_last, self.tail_at), (below, down, self.run_row, self.head_at)):
                    i = np.flatnonzero(there)
                    r = self.runs_by_symbol[which[i]]
                    fits = np.minimum(self.common(samples[r], at[other[i]]), length[other[i]])
                    better = fits > best[i]
                    i, r, fits = i[better], r[better], fits[better]
                    best[i], best_row[i], best_at[i] = fits, rows_[r], samples[r]
                row[other], at[other], length[other] = best_row, best_at, best
            found = length >= 0
            run = self.run_of[row] if self.rows else row
            if self.rows:
                row = np.where(found, self.run_to[run] + row - self.run_row[run], 0)
            at = np.where(found, at - 1, at)
            length = np.where(found, np.minimum(length + 1, self.depth), 0)
            yield live, place, length, at
            on = place > 0
            if useful is not None:
                on &= useful(live, place, length)
            live, place, row, at, length = live[on], place[on] - 1, row[on], at[on], length[on]

    def matching_statistics(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the patterns: the length of the longest prefix of the rest
        that occurs in a string of the index (at most `depth`), and where."""
        length, position = np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64)
        for pattern, place, n, at in self.stream(symbols, bounds):
            length[bounds[pattern] + place], position[bounds[pattern] + place] = n, at
        return length, position

    def long_matches(self, symbols: np.ndarray, bounds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, place) among the first counts[p] places of each pattern p, where the
        matching statistic reaches `depth`. A pattern is left when no place before
        can reach it any more."""
        found = []
        for pattern, place, length, _ in self.stream(symbols, bounds, lambda p, at, n: n + at >= self.depth):
            hit = (length >= self.depth) & (place < counts[pattern])
            if hit.any():
                found.append((pattern[hit], place[hit]))
        return tuple(np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in range(2))


def marked(contexts: list[Context], blocks: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts as symbols, with the digits of their block's number put in before the
    anchor; and their bounds. Contexts of different blocks then match nowhere
    across an anchor, and every window holds its anchor."""
    sizes = np.array([len(c.text) for c in contexts], np.int64)
    bounds = np.append(0, np.cumsum(sizes + digits))
    out = np.empty(bounds[-1], np.int64)
    at = bounds[:-1] + np.array([c.anchor for c in contexts], np.int64)
    inside = np.ones(len(out), bool)
    for k in range(digits):
        out[at + k] = BYTES + blocks // BLOCKS**k % BLOCKS
        inside[at + k] = False
    out[inside] = np.frombuffer(b"".join(c.text for c in contexts), np.uint8).astype(np.int64) + 1
    return out, bounds


def run_indexes(span: int = SPAN):
    """The later contexts of a prefix are streamed against an index of the earlier ones.

    Contexts of one prefix are put in order of their first place. For each bit of
    that number, those with the bit form patterns and those without it the index,
    block by block of equal higher bits: so every context meets all earlier ones,
    each once, in as many rounds as the number has bits. One index serves
    all blocks and prefixes of a group."""

    def index(rows: list[Context]) -> list[np.ndarray]:
        flags = [np.zeros(c.count, bool) for c in rows]
        order = sorted(range(len(rows)), key=lambda i: (rows[i].key, rows[i].place))
        key = np.array([rows[i].key for i in order], np.uint64)
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        total = np.diff(np.append(head, len(key)))
        number, total = np.arange(len(key)) - np.repeat(head, total), np.repeat(total, total)
        for bit in range(int(total.max(initial=1) - 1).bit_length()):
            block = number >> (bit + 1)
            met = np.flatnonzero((block << (bit + 1)) + (1 << bit) < total)
            sizes = np.cumsum([len(rows[order[i]].text) for i in met])
            digits = 1
            while int(block.max(initial=0)) >= BLOCKS**digits:
                digits += 1
            cut, at = [], 0
            while at < len(met):  # between prefixes
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + GROUP_BYTES)))
                while to < len(met) and key[met[to]] == key[met[to - 1]]:
                    to += 1
                cut.append(met[at:to])
                at = to
            for group in cut:
                later = (number[group] >> bit & 1).astype(bool)
                held, asked = group[~later], np.array([i for i in group[later] if not flags[order[i]].all()], np.int64)
                if not len(asked):
                    continue
                made = RunLengthIndex(*marked([rows[order[i]] for i in held], block[held], digits), span + digits)
                patterns = [rows[order[i]] for i in asked]
                which, place = made.long_matches(*marked(patterns, block[asked], digits), np.array([c.count for c in patterns]))
                for w, p in zip(asked[which].tolist(), place.tolist(), strict=True):
                    flags[order[w]][p] = True
        return flags

    return index


def remove_repeated_bytes(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text: str = "text", chunk_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: doc_id, n_units (bytes), n_removed, spans of removed
    bytes (maximal runs), kept (the other bytes; they may cut characters).

    A byte goes if a string of `span` bytes covers it that also starts earlier:
    in a document with a smaller id, or before in the same one. A null text is
    empty; shorter texts keep all; texts of any length are taken whole; a null id
    comes after all others, and rows with the same id (or none) count as one
    document with several texts, of which only an earlier start takes from the
    others; whole repeated rows get equal results. An empty table gives no rows;
    of the columns only the two named are read.
    """
    law = Law(words=False, span=span, gram=max(1, span * 2 // 5), same_doc=True)
    return without_repeats(docs, law, run_indexes(span), id_col, text, chunk_bytes)


def op9_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeated_bytes(documents(spark, sf_dir))
    return done.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
