"""Operator 11: periodic runs of words by enumeration of maximal pairs.

A run with period q, from word s on and of length L, is the maximal pair (s, s + q): the words before the
two places differ or one is missing, the L - q words from both on are equal, and the next ones differ. So the
maximal pairs whose distance is at most a third of their common length are the runs; nothing has to
be extended.

1. Texts in which no five words repeat have no run. Of the others all words of a stretch of texts get
   one suffix array, by prefix doubling in numpy; words of different texts never compare equal. The
   ranks of each doubling also give the common prefixes of neighbours (LCP).
2. Suffixes that share five words or more form a group, of which the LCP-interval tree is walked from
   the deepest interval up. An interval keeps its places in order, each in the class of the word to its
   left. Joining two children, each place of the smaller one is held against its neighbours in the
   other. That is enough: places of equal words closer than a third of what they share form one
   arithmetic progression, of which all but the first have the same left word, and the two places
   of a smallest period are next to each other. Pairs of one class are no maximal pairs.
3. Groups of a single class, or whose closest places are too far apart, are left out beforehand.

A text is worked on in one task, in time n log n and with about 150 bytes a word; nothing is shuffled.

Defined results: a null or empty text has no words, no runs and an empty collapsed text. Equal rows give
equal results, one row each; rows without an id are kept; an empty table gives no rows. Very long texts
are taken whole. A stretch with several periods counts with the smallest. Words are compared by 64-bit
hashes. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mailfacts.llm.common import chunks, text_or_empty
from mailfacts.llm.words import mix, ngrams, words_of

# A run is at least this long, and at least so many periods.
MIN_LENGTH, MIN_PERIODS = 6, 4
# The least that the two places of a run have in common: length less period.
MIN_COMMON = 5

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def repeating_rows(hashes: np.ndarray, doc: np.ndarray, rows: int) -> np.ndarray:
    """Rows in which ``MIN_COMMON`` consecutive words occur twice."""
    found = np.zeros(rows, bool)
    if len(hashes) >= MIN_COMMON:
        at = np.flatnonzero(doc[: len(hashes) - MIN_COMMON + 1] == doc[MIN_COMMON - 1 :])
        keys = mix(ngrams(hashes, MIN_COMMON)[at] + mix(doc[at].astype(np.uint64)))
        order = np.argsort(keys)
        found[doc[at[order[1:]][keys[order][1:] == keys[order][:-1]]]] = True
    return found


def suffix_array(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and what each has in common with the one before.

    ``words`` are numbers that differ between texts; ``ends`` is where the text of each ends."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    new = np.ones(n, bool)
    new[1:] = words[order[1:]] != words[order[:-1]]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, width = [rank], 1
    while True:
        # Places in the order that still share their rank.
        shared = ~new
        shared[:-1] |= ~new[1:]
        slots = np.flatnonzero(shared)
        if not len(slots):
            break
        at = order[slots]
        beyond = at + width
        following = np.where(beyond < ends[at], rank[np.minimum(beyond, n - 1)].astype(np.int64) + 1, 0)
        keys = rank[at].astype(np.int64) * (n + 1) + following
        by = np.argsort(keys, kind="stable")
        order[slots], keys = at[by], keys[by]
        fresh = np.ones(len(slots), bool)
        fresh[1:] = keys[1:] != keys[:-1]
        new[slots] = fresh
        rank = rank.copy()
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        levels.append(rank)
        width *= 2
    common = np.zeros(n, np.int64)
    x, y = order[:-1], order[1:]
    for k in range(len(levels) - 1, -1, -1):
        a, b = x + common[1:], y + common[1:]
        inside = (a < ends[x]) & (b < ends[y])
        a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
        common[1:] += np.where(inside & (levels[k][a] == levels[k][b]), 1 << k, 0)
    return order, common


def maximal_pairs(places: list[int], common: list[int], left: list[int]) -> Iterator[tuple[int, int, int]]:
    """(place, distance, common length) of the maximal pairs of one group that are near enough for a
    run. ``common[i]`` belongs to ``places[i - 1]`` and ``places[i]``."""
    sets: list[list[int]] = [[p] for p in places]
    first, last = list(range(len(places))), list(range(len(places)))  # the interval around its ends
    class_of = dict(zip(places, left, strict=True))
    for i in sorted(range(1, len(places)), key=lambda i: -common[i]):
        low, high, shared = first[i - 1], last[i], common[i]
        some, others = sets[low], sets[i]
        if len(some) > len(others):
            some, others = others, some
        for p in some:
            at = bisect_left(others, p)
            for q in others[max(at - 1, 0) : at + 1]:
                distance = abs(p - q)
                length = shared + distance
                if length >= max(MIN_LENGTH, MIN_PERIODS * distance) and class_of[p] != class_of[q]:
                    yield min(p, q), distance, shared
        if len(some) * 32 < len(others):
            for p in some:
                insort(others, p)
        else:
            others.extend(some)
            others.sort()
        sets[low] = others
        first[high], last[low] = low, high


def runs_of(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period. ``starts`` and ``ends`` bound the
    text of each word."""
    if len(words) < MIN_LENGTH:
        return []
    order, common = suffix_array(words, ends)
    joined = common >= MIN_COMMON
    group = np.cumsum(~joined) - 1
    left = np.where(order > starts[order], words[order - 1].astype(np.int64), -1)
    bounds = np.flatnonzero(~joined)
    deepest = np.maximum.reduceat(common * joined, bounds)
    by_class, by_place = np.lexsort((left, group)), np.lexsort((order, group))
    same = group[1:] == group[:-1]
    several = np.zeros(len(bounds), bool)
    several[group[1:][same & (left[by_class][1:] != left[by_class][:-1])]] = True
    closest = np.full(len(words), len(words), np.int64)
    closest[1:][same] = np.diff(order[by_place])[same]
    near = (MIN_PERIODS - 1) * np.minimum.reduceat(closest, bounds) <= deepest
    sizes = np.diff(np.append(bounds, len(words)))
    periods: dict[tuple[int, int], int] = {}
    for g in np.flatnonzero(several & near & (sizes > 1)):
        inside = slice(bounds[g], bounds[g] + sizes[g])
        pairs = maximal_pairs(order[inside].tolist(), common[inside].tolist(), left[inside].tolist())
        for place, distance, shared in pairs:
            stretch = place, shared + distance
            periods[stretch] = min(distance, periods.get(stretch, distance))
    return sorted(((s, n, q) for (s, n), q in periods.items()), key=lambda run: (run[0], run[2]))


def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
    column = batch.column("text")
    words = words_of(column)
    hashes, rows = words.hashes(), batch.num_rows
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(rows)]
    wanted = repeating_rows(hashes, words.doc, rows)[words.doc]
    if wanted.any():
        doc = words.doc[wanted]
        # Every text's words as numbers of their own.
        _, own = np.unique(mix(hashes[wanted] + mix(doc.astype(np.uint64))), return_inverse=True)
        starts, ends = np.searchsorted(doc, doc), np.searchsorted(doc, doc, "right")
        for start, length, period in runs_of(own, starts, ends):
            runs[doc[start]].append((start - int(starts[start]), length, period))
    collapsed = []
    for i, text in enumerate(column.to_pylist()):
        parts = text.encode("utf-8", "surrogatepass").split()
        if runs[i]:
            gone = np.zeros(len(parts) + 1, np.int64)
            for start, length, period in runs[i]:
                gone[start + period] += 1
                gone[start + length] -= 1
            parts = [w for w, dropped in zip(parts, np.cumsum(gone)[:-1], strict=True) if not dropped]
        collapsed.append(b" ".join(parts))
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
    flat = np.array([run for r in runs for run in r], np.int64).reshape(-1, 3)
    structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(words.counts, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), structs),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The runs of each row of ``docs`` (doc_id, text), and its text without what repeats in them:
    the words left, joined by one space."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            yield scan(part)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(work, SCHEMA)
