"""Periodic runs of words (operator 12) by Baier's grouping and Lyndon roots.

Phase one of the grouping suffix sorter goes through the groups of suffixes from the largest
down.  A suffix's context is its longest Lyndon prefix found so far; when its group's turn comes, the
context is final, which is the Lyndon array, and the nearest position to the left that is still waiting
takes it on at its end and moves to a higher group.  No suffix array is built.  It is run
under the order of the words and under the reverse order: every run holds Lyndon words of
its period's length for one of the two.  Each such root is extended to both sides by LCE: the longest common
extension of two places, by names of the blocks of 1, 2, 4, ... words.  Names are 64-bit hashes,
so every run found is compared word by word, and looked for without hashes if it fails.

A word found fewer than three times in a stretch of text is in no run whose length is three periods
(a run holds each of its words three times), so such words cut the text before; stretches shorter
than the shortest run are left out.  All else is searched whole.

Cases: a null text, or one without words, has no runs.  Null and repeated doc_ids are rows like any
other; ties for the strongest run go to the smallest start, then period.  Texts are taken whole, and memory
follows the longest text.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from zonewatch.llm.common import mix, slices, utf8

MIN_LENGTH, MIN_TURNS = 24, 3


def lyndon_array(ids: list[int]) -> list[int]:
    """Length of the longest Lyndon prefix of every suffix; ``ids`` are ranks from 0 on, each taken."""
    n = len(ids)
    groups = max(ids, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(groups)]  # ascending; who has moved on stays listed
    for i, c in enumerate(ids):
        members[c].append(i)
    size = [len(m) for m in members]  # without who has moved on
    below, above = list(range(-1, groups - 1)), [*range(1, groups), -1]  # the next smaller and larger group
    group, length = ids[:], [1] * n
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))  # the nearest waiting suffixes

    def lift(old: int, moved: list[int]) -> int:
        """A new group right above ``old``."""
        new, up = len(members), above[old]
        members.append(moved)
        size.append(len(moved))
        below.append(old)
        above.append(up)
        above[old] = new
        if up >= 0:
            below[up] = new
        for j in moved:
            group[j] = new
        return new

    at = groups - 1
    while at >= 0:
        takes: dict[int, int] = {}
        grown = 0
        for i in members[at]:
            if group[i] == at:  # ascending, so nobody waiting to the left is of this group
                j, k = left[i], right[i]
                if k < n:
                    left[k] = j
                if j >= 0:
                    right[j] = k
                    takes[j] = takes.get(j, 0) + 1
                grown = length[i]
        moved: dict[int, dict[int, list[int]]] = {}
        for j, times in takes.items():
            length[j] += times * grown
            if size[group[j]] > 1:  # one alone keeps its place
                moved.setdefault(group[j], {}).setdefault(times, []).append(j)
        for old, by_times in moved.items():
            if len(by_times) > 1 or len(next(iter(by_times.values()))) < size[old]:  # all alike keep it too
                place = old
                for times in sorted(by_times):  # more turns of a smaller word make a larger context
                    size[old] -= len(by_times[times])
                    place = lift(place, by_times[times])
        at = below[at]
        while at >= 0 and not size[at]:
            at = below[at]
    return length


class Extension:
    """Longest common extensions by names of blocks of 1, 2, 4, ... words."""

    def __init__(self, ids: np.ndarray):
        self.names = [mix(ids.astype(np.uint64) + np.uint64(1))]
        with np.errstate(over="ignore"):
            while len(self.names[-1]) > (half := 1 << len(self.names) - 1):
                last = self.names[-1]
                self.names.append(mix(last[:-half] * np.uint64(0x9E3779B97F4A7C15) + last[half:]))

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words from ``i`` on that equal those from ``j`` on; i < j."""
        found = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            inside = np.flatnonzero(j + found < len(names))
            same = inside[names[(i + found)[inside]] == names[(j + found)[inside]]]
            found[same] += 1 << k
        return found

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words before ``i`` that equal those before ``j``; i < j."""
        found = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            inside = np.flatnonzero(i - found >= 1 << k)
            same = inside[names[(i - found)[inside] - (1 << k)] == names[(j - found)[inside] - (1 << k)]]
            found[same] += 1 << k
        return found


def _plain(ids: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """(start, end) of the run of period ``p`` around ``i`` and ``i + p``, word by word."""
    differ = np.flatnonzero(ids[:-p] != ids[p:])
    k = int(np.searchsorted(differ, i))
    return int(differ[k - 1]) + 1 if k else 0, int(differ[k]) + p if k < len(differ) else len(ids)


def _runs_of_stretch(ids: np.ndarray, min_length: int, min_turns: int) -> set[tuple[int, int, int]]:
    found: set[tuple[int, int, int]] = set()
    ranks = np.unique(ids, return_inverse=True)[1]
    extension = Extension(ranks)
    for order in (ranks, ranks.max() - ranks):
        period = np.array(lyndon_array(order.tolist()), np.int64)
        i = np.arange(len(ids))
        i = i[i + min_turns * period <= len(ids) + period]  # a later turn of the root must fit in
        p = period[i]
        i, p = (x[extension.names[0][i] == extension.names[0][np.minimum(i + p, len(ids) - 1)]] for x in (i, p))
        start = i - extension.backward(i, i + p)
        end = i + p + extension.forward(i, i + p)
        long = np.flatnonzero(end - start >= np.maximum(min_length, min_turns * p))
        seen: set[tuple[int, int, int]] = set()
        for s, e, q, at in zip(start[long].tolist(), end[long].tolist(), p[long].tolist(), i[long].tolist(), strict=True):
            if (s, e, q) in seen:
                continue
            seen.add((s, e, q))
            if not (ranks[s:e - q] == ranks[s + q:e]).all():  # two blocks of one name
                s, e = _plain(ranks, at, q)
                if e - s < max(min_length, min_turns * q):
                    continue
            found.add((s, e - s, q))
    return found


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH, min_turns: int = MIN_TURNS) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of the maximal runs of at least ``min_length`` ids and
    ``min_turns`` (2 or more) periods, by start and period."""
    out, pending = set(), [(0, len(ids))]
    while pending:
        s, e = pending.pop()
        if e - s < min_length:
            continue
        _, rank, times = np.unique(ids[s:e], return_inverse=True, return_counts=True)
        rare = np.flatnonzero(times[rank] < min_turns)
        if len(rare):
            edges = [s - 1, *(rare + s).tolist(), e]
            pending += [(x + 1, y) for x, y in zip(edges, edges[1:], strict=False) if y - x > min_length]
        else:
            out |= {(s + start, length, p) for start, length, p in _runs_of_stretch(ids[s:e], min_length, min_turns)}
    return sorted(out, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most turns (compared exactly), then of the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, p in runs:
        edge[start + p] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_DDL = "struct<start: long, length: long, period: long>"


def _find(min_length: int, min_turns: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, texts = part.column(0).to_pylist(), utf8(part.column(1))
            for at, to in slices(texts):
                number: dict[bytes, int] = {}
                runs, best, left = [], [], []
                for text in texts[at:to]:
                    words = text.split()
                    coded = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
                    found = find_runs(coded, min_length, min_turns)
                    first = strongest(found)
                    runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                    best.append(first and dict(zip(("start", "length", "period"), first, strict=True)))
                    left.append(b" ".join(collapse(words, found)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:to], pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(best, RUN), pa.array(left, pa.binary())],
                    names=["doc_id", "runs", "strongest", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_turns: int = MIN_TURNS) -> DataFrame:
    """One row per document: doc_id, runs (by start, period), strongest, collapsed (UTF-8)."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(
        _find(min_length, min_turns), f"doc_id long, runs array<{_RUN_DDL}>, strongest {_RUN_DDL}, collapsed binary")
