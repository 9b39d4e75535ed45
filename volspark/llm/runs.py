"""Periodic runs of words, by an enhanced suffix array.

A run is a stretch of consecutive words that repeats itself with a smallest period q, is at least
``max(shortest, times * q)`` words long, and cannot be extended by a neighbouring word. Texts are
searched whole, many short ones together:

1. *Suffix array.* Prefix doubling; only suffixes that are not yet apart are sorted again. Every
   document ranks by itself, so nothing is compared across documents. The ranks of each doubling
   are kept: two blocks of 2^k words are equal if their k-th ranks are, which gives the LCP table.
2. *Branching tandems.* An LCP interval is an inner node of the suffix tree, here only the pair of
   its ends, found by halving steps over minima of the LCP table. For an interval of depth d, every
   suffix i of all its children but the largest is tested: is i + d (or i - d) in the interval too,
   by its place in the inverse suffix array, and does another word follow? Then two equal blocks of
   d words meet there, and the square cannot be moved to the right.
3. *Rotation.* A square is moved to the left as long as the words repeat, by halving steps over the
   kept ranks. Squares of one stretch merge into a run; the least d is its period.

Memory grows with the words of a batch of texts (or of one longer text) times the doublings that
its longest repeat needs.

Defined results: a null or empty text has no words and no runs, and collapses to an empty text.
Null and repeated ids are rows of their own; equal texts get equal runs; an empty table gives an
empty result. Words are cut at ASCII white space only. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .corpus import slices

SHORTEST, TIMES = 6, 4
#: Bytes of the texts that are searched together (a longer text is searched alone).
BATCH_BYTES = 1 << 20
#: Suffixes tested together.
TESTED_TOGETHER = 1 << 21
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def suffix_array(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of all suffixes, each document by itself, and the ranks by 2^k words for each k.

    ``ends`` is, for each position, where its document ends. Suffixes of equal rank are not apart
    yet; a block that its document cuts short equals no other.
    """
    n = len(words)
    key = (ends.astype(np.int64) << 32) | words
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.diff(key[order], prepend=-1))
    ranks = np.empty(n, np.int32)
    ranks[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    levels, step = [ranks], 1
    while True:
        size = np.diff(np.append(heads, n))
        if len(size) == n:
            return order, levels
        tied = np.flatnonzero(np.repeat(size > 1, size))
        at = order[tied]
        after = at + step
        inside = after < ends[at]
        key = (ranks[at].astype(np.int64) << 32) | (ranks[np.where(inside, after, 0)] + 1) * inside
        turn = np.argsort(key)
        key, order[tied] = key[turn], at[turn]
        new = tied[np.flatnonzero(np.diff(key, prepend=-1))]
        single = np.ones(n, bool)
        single[tied] = False
        single[new] = True
        heads = np.flatnonzero(single)
        ranks = np.empty(n, np.int32)
        ranks[order] = np.repeat(heads, np.diff(np.append(heads, n)))
        levels.append(ranks)
        step *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """The words that each suffix shares with the one before it in order; 0 for the first, and one 0 more."""
    lcp = np.zeros(len(order) + 1, np.int32)
    at = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    left, right = order[at - 1], order[at]
    last, shared = np.minimum(ends[left] - left, ends[right] - right), np.zeros(len(at), np.int64)
    for k in reversed(range(len(levels))):
        can = shared + (1 << k) <= last
        a, b = left + np.where(can, shared, 0), right + np.where(can, shared, 0)
        shared += (can & (levels[k][a] == levels[k][b])).astype(np.int64) << k
    lcp[at] = shared
    return lcp


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """Children of the LCP intervals of depth 1 and more: (interval, first, last, size) of each
    child, and (depth, first, last) of each interval. Children of an interval are neighbours."""
    at = np.flatnonzero(lcp > 0)
    value = lcp[at]
    minima, widest = [lcp], int(np.diff(np.flatnonzero(lcp == 0)).max(initial=1))
    while 1 << len(minima) <= widest:
        below, half = minima[-1], 1 << (len(minima) - 1)
        minima.append(np.minimum(below[: len(below) - half], below[half:]))
    after, before = at.copy(), at.copy()
    for k in reversed(range(len(minima))):
        # lcp[after] ends up as the first value to the right below the own, lcp[before] to the left
        can = after + (1 << k) <= len(lcp)
        after += (can & (minima[k][np.where(can, after, 0)] >= value)).astype(np.int64) << k
        start = before - (1 << k) + 1
        can = start >= 0
        before -= (can & (minima[k][np.where(can, start, 0)] >= value)).astype(np.int64) << k
    turn = np.lexsort((at, value, before))
    at, value, before, after = at[turn], value[turn], before[turn], after[turn]
    new = np.ones(len(at), bool)
    new[1:] = (before[1:] != before[:-1]) | (value[1:] != value[:-1])
    head = np.flatnonzero(new)
    depth, first, last = value[head], before[head], after[head] - 1
    own = np.cumsum(new) - 1
    # a child begins at each boundary of its interval, and one more at the interval's begin
    end = np.append(at[1:], 0) - 1
    tail = np.append(new[1:], True)[: len(at)]
    end[tail] = last[own[tail]]
    group = np.concatenate((own, np.arange(len(head))))
    begin, end = np.concatenate((at, first)), np.concatenate((end, at[head] - 1))
    turn = np.lexsort((begin, group))
    return group[turn], begin[turn], end[turn], depth, first, last


def squares(words: np.ndarray, ends: np.ndarray, order: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, half) of every square whose next word breaks the repeat; some more than once."""
    group, begin, end, depth, first, last = intervals(lcp)
    if not len(group):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = end - begin + 1
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    largest = np.maximum.reduceat(size, heads)
    biggest = np.flatnonzero(size == largest[group])
    small = np.ones(len(group), bool)
    small[biggest[np.unique(group[biggest], return_index=True)[1]]] = False
    group, begin, size = group[small], begin[small], size[small]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    cuts = np.searchsorted(np.cumsum(size), np.arange(0, size.sum(), TESTED_TOGETHER), side="right")
    for a, b in zip(cuts, [*cuts[1:], len(size)]):
        if a == b:
            continue
        part = size[a:b]
        inner = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
        i = order[np.repeat(begin[a:b], part) + inner]
        g = np.repeat(group[a:b], part)
        d = depth[g].astype(np.int64)
        for start in (i, i - d):
            other = np.where(start == i, i + d, start)
            can = (start >= 0) & (other < len(order))
            at = place[np.where(can, other, 0)]
            can &= (at >= first[g]) & (at <= last[g])
            s, h = start[can], d[can]
            beyond = s + 2 * h
            stops = beyond >= ends[s]
            stops |= words[s + h] != words[np.where(stops, s, beyond)]
            found.append((s[stops], h[stops]))
    return np.concatenate([s for s, _ in found]), np.concatenate([h for _, h in found])


def find(words: np.ndarray, ends: np.ndarray, shortest: int = SHORTEST, times: int = TIMES):
    """(start, length, period) of all runs of the documents in ``words``, in order of start and period."""
    if not len(words):
        return (np.zeros(0, np.int64),) * 3
    order, levels = suffix_array(words, ends)
    start, half = squares(words, ends, order, common_prefixes(order, levels, ends))
    stop, begins = start + 2 * half, np.zeros(len(words), np.int64)
    begins[1:][ends[1:] != ends[:-1]] = np.flatnonzero(ends[1:] != ends[:-1]) + 1
    begins = np.maximum.accumulate(begins)
    floor = begins[start]
    for k in reversed(range(len(levels))):
        to = start - (1 << k)
        can = to >= floor
        to = np.where(can, to, start)
        start = np.where(can & (levels[k][to] == levels[k][to + half]), to, start)
    turn = np.lexsort((half, stop, start))
    start, stop, half = start[turn], stop[turn], half[turn]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    keep &= stop - start >= np.maximum(shortest, times * half)
    start, stop, half = start[keep], stop[keep], half[keep]
    turn = np.lexsort((half, start))
    return start[turn], (stop - start)[turn], half[turn]


def search(texts: Sequence[bytes | None], shortest: int = SHORTEST, times: int = TIMES):
    """For each text: its words, and its runs as an array of (start, length, period)."""
    cut = [text.split() if text else [] for text in texts]
    codes: defaultdict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(w) for w in cut], np.int64)
    words = np.fromiter((codes[w] for one in cut for w in one), np.int64, sizes.sum())
    stops = np.cumsum(sizes)
    runs = np.stack(find(words, np.repeat(stops, sizes), shortest, times), axis=1)
    owner = np.searchsorted(stops, runs[:, 0], side="right")
    runs[:, 0] -= (stops - sizes)[owner]
    bounds = np.searchsorted(owner, np.arange(len(cut) + 1))
    return [(cut[i], runs[bounds[i] : bounds[i + 1]]) for i in range(len(cut))]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, of every run only its first period, joined by single spaces."""
    if not len(runs):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    inside = np.cumsum(step)[:-1]
    return b" ".join([words[i] for i in np.flatnonzero(inside == 0)])


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed text (UTF-8)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches, BATCH_BYTES):
            found = search(texts, shortest, times)
            flat = np.concatenate([r for _, r in found])
            offsets = np.cumsum([0, *(len(r) for _, r in found)])
            listed = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN.value_type))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(w) for w, _ in found], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), listed),
                    pa.array([collapse(w, r) for w, r in found], pa.binary()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return texts.mapInArrow(run, SCHEMA).withColumn("collapsed", F.col("collapsed").cast("string"))
