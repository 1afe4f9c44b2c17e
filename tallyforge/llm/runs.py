"""Periodic runs of words: a stretch that repeats itself with a smallest period, and the text with each run cut to its first period.

The suffixes of all texts of a block are sorted by prefix doubling. Kruskal over the longest common prefixes, the
longest first, unites suffix classes; each class keeps its positions in order, and the smaller one of two is put into
the larger. Two positions that become neighbours in a class of common prefix l, at a distance d <= l, start a stretch of
l + d words with smallest period d: were a part of d a period too, a position between the two would be in the class. Where
the words before the two differ, the stretch can't be extended, so each run is found once, at its first word.
"""

from __future__ import annotations

import hashlib
import sys
from bisect import bisect_left
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import spans
from .repetition import suffix_array

#: Periods that a run has at least, and its words.
MIN_EXPONENT = 4
MIN_WORDS = 6

COLUMNS = {"n_runs": "long", "start": "long", "length": "long", "period": "long", "exponent_milli": "long", "runs_sha256": "string", "collapsed_sha256": "string"}


def seeds(suffixes: list[int], common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Kruskal over edges between neighbouring suffixes: (a, b, l) for positions a < b that become neighbours in a class of common prefix l >= ``least``, where b - a <= l.

    ``suffixes`` and ``common`` are those of one text, or a part of them that holds whole classes.
    """
    edges = sorted((k for k, l in enumerate(common) if l >= least), key=common.__getitem__, reverse=True)
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for k in edges:
        length = common[k]
        large, small = root(suffixes[k]), root(suffixes[k + 1])
        held, moved = members.get(large) or [large], members.pop(small, None) or [small]
        if len(held) < len(moved):
            members.pop(large, None)
            large, small, held, moved = small, large, moved, held
        parent[small] = large
        members[large] = held
        if 8 * len(moved) > len(held):
            inside = set(moved)
            held += moved
            held.sort()  # two ascending runs: a merge
            for a, b in pairwise(held):
                if b - a <= length and (a in inside) != (b in inside):
                    yield a, b, length
            continue
        last = -1
        for x, following in pairwise([*moved, sys.maxsize]):
            at = bisect_left(held, x)
            if at and held[at - 1] != last and x - held[at - 1] <= length:
                yield held[at - 1], x, length
            if at < len(held) and held[at] < following and held[at] - x <= length:
                yield x, held[at], length
            held.insert(at, x)
            last = x


def find_runs(symbols: np.ndarray, owner: np.ndarray, min_exponent: int = MIN_EXPONENT, min_words: int = MIN_WORDS) -> np.ndarray:
    """Rows (start, length, period) of the runs of all texts, by start and then period. Equal symbols are equal words of one text; ``min_exponent`` is 2 at least."""
    suffixes, common = suffix_array(symbols, owner)
    least = max(min_exponent - 1, min_words - min_words // min_exponent)  # of l, as l + d >= min_words and l >= (min_exponent - 1) * d
    near = np.flatnonzero(common >= least)
    found = []
    for first, last in _parts(suffixes, common, near, min_exponent):
        edges = seeds(suffixes[first : last + 2].tolist(), common[first : last + 1].tolist(), least)
        found += [(a, l + b - a, b - a) for a, b, l in edges if l >= (min_exponent - 1) * (b - a)]
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.array(found, np.int64)
    before, other = rows[:, 0] - 1, rows[:, 0] + rows[:, 2] - 1
    starts = (before < 0) | (symbols[before] != symbols[other])
    rows = rows[starts & (rows[:, 1] >= np.maximum(min_words, min_exponent * rows[:, 2]))]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _parts(suffixes: np.ndarray, common: np.ndarray, near: np.ndarray, min_exponent: int) -> list[list[int]]:
    """First and last edge of each part of ``near`` that can unite, being neighbours in the order of suffixes, if any two of its positions are close enough for a run."""
    if not len(near):
        return []
    breaks = np.flatnonzero(np.diff(near) > 1)
    first, last = near[np.r_[0, breaks + 1]], near[np.r_[breaks, len(near) - 1]]
    nodes = np.union1d(near, near + 1)
    part = np.searchsorted(first, nodes, "right") - 1
    order = np.lexsort((suffixes[nodes], part))
    at, part = suffixes[nodes][order], part[order]
    longest = np.maximum.reduceat(common[near], np.r_[0, breaks + 1])
    close = (part[1:] == part[:-1]) & ((at[1:] - at[:-1]) * (min_exponent - 1) <= longest[part[1:]])
    chosen = np.unique(part[1:][close])
    return np.stack([first[chosen], last[chosen]], axis=1).tolist()


def collapse(n: int, rows: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay: all but those that a run has after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, rows[:, 0] + rows[:, 2], 1)
    np.add.at(edge, rows[:, 0] + rows[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def _measured(data: np.ndarray, offsets: np.ndarray, min_exponent: int, min_words: int) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
    """COLUMNS of each text, and the collapsed texts as bytes with offsets."""
    n = len(offsets) - 1
    starts, ends, owner = spans.words(data, offsets)
    symbols = spans.join_hashes(spans.mix(owner.astype(np.uint64)), spans.hash_spans(data, starts, ends))
    rows = find_runs(symbols, owner, min_exponent, min_words)
    kept = collapse(len(starts), rows)
    bare = np.append(data, np.uint8(32))
    # Each kept word goes with a space after it, which is the byte at the end where the text has none there.
    size = ends[kept] - starts[kept]
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size + 1, out=at[1:])
    gather = np.repeat(starts[kept] - at[:-1], size + 1) + np.arange(at[-1])
    gather[at[1:] - 1] = len(data)
    text = bare[gather]
    first = np.searchsorted(owner[kept], np.arange(n + 1), "left")
    begin, end = at[first[:-1]], at[first[1:]]
    end = np.where(end > begin, end - 1, end)  # no space after the last word
    base = np.searchsorted(owner, np.arange(n + 1), "left")
    split, base = np.searchsorted(rows[:, 0], base, "left"), base.tolist()
    out: dict[str, list] = {c: [] for c in COLUMNS}
    for i in range(n):
        mine = [(a - base[i], l, p) for a, l, p in rows[split[i] : split[i + 1]].tolist()]
        best = None
        for a, l, p in mine:
            if best is None or l * best[2] > best[1] * p:
                best = (a, l, p)
        values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{a},{l},{p}\n" for a, l, p in mine)
        whole = hashlib.sha256(text[begin[i] : end[i]]).hexdigest()
        for c, v in zip(COLUMNS, (len(mine), *values, hashlib.sha256(listed.encode()).hexdigest(), whole)):
            out[c].append(v)
    return out, text, np.stack([begin, end])


def with_runs(docs: DataFrame, *, text: str = "text", collapsed: str | None = None, min_exponent: int = MIN_EXPONENT, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` and those of COLUMNS; an own column of such a name gives way. ``collapsed`` names a further column for the text without what runs repeat.

    ``start``, ``length`` and ``period`` are of the run with the greatest length over period; of equals the first, then the shortest
    period. ``runs_sha256`` is of all runs as ``start,length,period`` lines, ``collapsed_sha256`` of the kept words joined by a space. A
    null or empty text, or one without words, has no runs and an empty collapsed text. Rows that repeat are measured each; an
    empty table gives no rows. Memory is that of a megabyte of text, or of the longest text.
    """
    extra = {**COLUMNS, **({collapsed: "string"} if collapsed else {})}
    keep = [c for c in docs.columns if c.lower() not in extra]
    schema = docs.select(*keep).schema
    for name, kind in extra.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = spans.text_bytes(batch.column(keep.index(text)))
            for i, j in spans.blocks(offsets):
                found, joined, cuts = _measured(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], min_exponent, min_words)
                columns = [pa.array(found[c], pa.string() if kind == "string" else pa.int64()) for c, kind in COLUMNS.items()]
                if collapsed:
                    columns.append(spans.strings(joined, *cuts))
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, *columns], names=[*keep, *extra])

    return docs.select(*keep).mapInArrow(run, schema)
