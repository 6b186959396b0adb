"""Substring dedup by prefix-partitioned suffix trees over words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import documents
from .repeats import Context, Law, without_repeats
from .textnum import WHITE, byte_sums, span_hashes, word_spans

SPAN = 50
#: Words of one subtree.
GROUP_WORDS = 400_000


class SuffixTree:
    """The suffix tree of several strings of 64-bit codes, as its sorted leaves
    and the depths between them; an internal node is a run of leaves between
    shallower depths. No suffix reaches over the end of its string.

    Leaves are sorted by prefix doubling; the ranks of each doubling also give
    the depth of the lowest common ancestor of two leaves.
    """

    def __init__(self, codes: np.ndarray, bounds: np.ndarray):
        n = len(codes)
        self.bounds = bounds
        self.rest = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)  # length of each suffix
        self.levels = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
        width, longest = 1, int(self.rest.max(initial=0))
        while width < longest and self.levels[-1].max(initial=0) < n - 1:
            self.levels.append(self._pairs(self.levels[-1], width))
            width *= 2
        self.leaves = np.lexsort((np.arange(n), self.levels[-1]))
        self.depths = self.common(self.leaves[:-1], self.leaves[1:])

    def _pairs(self, rank: np.ndarray, width: int) -> np.ndarray:
        """Ranks of twice the width; a suffix that ends before sorts first."""
        ahead = np.zeros(len(rank), np.int64)
        far = np.flatnonzero(self.rest > width)
        ahead[far] = rank[far + width] + 1
        return np.unique(rank * (len(rank) + 2) + ahead, return_inverse=True)[1]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Depth of the lowest common ancestor: the length of the common prefix."""
        out = np.zeros(len(a), np.int64)
        most = np.minimum(self.rest[a], self.rest[b])
        for k in range(len(self.levels) - 1, -1, -1):
            for _ in range(2 if k == len(self.levels) - 1 else 1):
                x, y = np.minimum(a + out, len(self.rest) - 1), np.minimum(b + out, len(self.rest) - 1)
                fit = (out + (1 << k) <= most) & (self.levels[k][x] == self.levels[k][y])
                out[fit] += 1 << k
        return out

    def deep_nodes(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The highest internal nodes of at least this depth, as runs of leaves [left,
        right): all suffixes of a node, and no others, share its first `depth` codes."""
        cut = np.append(0, np.flatnonzero(self.depths < depth) + 1) if len(self.leaves) else np.zeros(0, np.int64)
        ends = np.append(cut[1:], len(self.leaves)) if len(cut) else cut
        many = ends - cut > 1
        return cut[many], ends[many]

    def maximal_repeats(self, depth: int) -> list[tuple[int, list[int]]]:
        """(length, starts) of each internal node at least so deep: its prefix
        can't be extended to the right without losing an occurrence."""
        out, stack = [], []
        for i, d in enumerate([*self.depths.tolist(), 0]):
            left = i
            while stack and stack[-1][0] > d:
                deep, left = stack.pop()
                if deep >= depth:
                    out.append((deep, sorted(self.leaves[left : i + 1].tolist())))
            if d and (not stack or stack[-1][0] < d):
                stack.append((d, left))
        return out


def groups(rows: list[Context], size) -> list[list[int]]:
    """Contexts sorted by prefix, cut between different prefixes into groups of
    about GROUP_WORDS; a prefix whose contexts are all one has no other occurrence
    than that context's copies, and is left out."""
    order = sorted(range(len(rows)), key=lambda i: rows[i].key)
    out, now, words, at = [], [], 0, 0
    while at < len(order):
        to = at
        while to < len(order) and rows[order[to]].key == rows[order[at]].key:
            to += 1
        if to - at > 1:
            now += order[at:to]
            words += sum(size(rows[i]) for i in order[at:to])
            if words >= GROUP_WORDS:
                out.append(now)
                now, words = [], 0
        at = to
    return [*out, now] if now else out


def later_leaves(tree: SuffixTree, depth: int, window: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which windows (suffixes of the tree) hang under an internal node of at least
    this depth together with one of an earlier (doc, start). Other suffixes of
    the node are no windows of this group and don't count."""
    left, right = tree.deep_nodes(depth)
    of_leaf = np.full(len(tree.leaves), -1)
    at = np.full(len(tree.leaves), -1)
    at[window] = np.arange(len(window))
    of_leaf[:] = at[tree.leaves]  # the window of each leaf, in the order of leaves
    node = np.repeat(np.arange(len(left)), right - left)
    leaf = np.arange(len(node)) - np.repeat(np.cumsum(right - left) - (right - left), right - left) + np.repeat(left, right - left)
    held = of_leaf[leaf] >= 0
    node, w = node[held], of_leaf[leaf][held]
    order = np.lexsort((start[w], doc[w], node))
    node, w = node[order], w[order]
    head = np.append(True, node[1:] != node[:-1]) if len(node) else np.zeros(0, bool)
    first = w[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(node) else w
    out = np.zeros(len(window), bool)
    out[w] = (doc[first] != doc[w]) | (start[first] != start[w])
    return out


def subtrees(span: int = SPAN):
    """Removal from the deep internal nodes of a part's suffix trees."""

    def index(rows: list[Context]) -> list[np.ndarray]:
        flags = [np.zeros(c.count, bool) for c in rows]
        for group in groups(rows, lambda c: c.count + span - 1):
            held = [rows[i] for i in group]
            raw = np.frombuffer(b"".join(c.text for c in held), np.uint8)
            starts, ends, bounds = word_spans(raw, WHITE, np.append(0, np.cumsum([len(c.text) for c in held])))
            tree = SuffixTree(span_hashes(byte_sums(raw), starts, ends), bounds)
            counts = np.array([c.count for c in held])
            inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            doc = np.repeat(np.array([c.place[0] for c in held]), counts)
            again = later_leaves(tree, span, np.repeat(bounds[:-1], counts) + inner, doc, np.zeros(len(doc), np.int64))
            for i, f in zip(group, np.split(again, np.cumsum(counts)[:-1]), strict=True):
                flags[i] = f
        return flags

    return index


def remove_repeated_passages(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text: str = "text", chunk_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: doc_id, n_units (words), n_removed, spans of removed
    words, kept (the other words joined by one space, as bytes).

    A word goes if a window of `span` words covers it whose words also start in
    a document with a smaller id. A null or empty text has no words; a document
    of fewer words keeps all; texts and words of any length are taken whole; a
    null id counts as larger than all others; rows with the same id don't take
    from each other; whole repeated rows get equal results; an empty table gives
    no rows. Of the columns only the two named are read.

    Suffixes are split by prefixes of two lengths, a fifth of the span, and the
    whole span where that is frequent (see Law.hot), into parts, and within a
    part into groups that fit in memory, a suffix tree for each.
    """
    law = Law(words=True, span=span, gram=max(1, span // 5), same_doc=False)
    return without_repeats(docs, law, subtrees(span), id_col, text, chunk_bytes)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeated_passages(documents(spark, sf_dir))
    return done.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
