"""Quality rules: repetition inside a text, by a suffix array over its words.

The suffix arrays of all texts of a block are built together by prefix doubling: a symbol is the hash of a
word and its text, so suffixes of different texts never share a prefix. Only suffixes that still tie are sorted
again. The ranks of each level then give the longest common prefix of neighbours. The deepest
longest-common-prefix interval around a suffix tells the longest maximal repeat that starts there; the union of
these spans is what repeats cover.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans

#: A repeat counts from this many words on.
MIN_REPEAT = 5
#: Share of the word characters that repeats may cover, all occurrences counted, as the published rule for five-word repeats has it.
MAX_COVERED = 0.15
#: Words that the longest repeat may have, and its share of the text's words; a text fails beyond both.
MAX_REPEAT_WORDS = 100
MAX_REPEAT_SHARE = 0.05

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

COLUMNS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "covered_chars": "long", "longest_repeat": "long"}


def suffix_array(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of all texts in order, and the words of the common prefix of each two that follow each other; suffixes of two texts share none."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(symbols, kind="stable")
    levels = [_ranks(order, symbols[order], n)]
    last = np.searchsorted(owner, owner, "right")  # end of each position's text
    k = 1
    while True:
        rank = levels[-1]
        sizes = np.bincount(rank, minlength=n)
        active = np.flatnonzero(sizes[rank] > 1)
        if not len(active):
            break
        follow = active + k
        second = np.where(follow < last[active], rank[np.minimum(follow, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        old, key = rank[active][order], key[order]
        at = np.arange(len(key))
        group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], at, 0))
        pair = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], at, 0))
        rank = rank.copy()
        rank[active[order]] = old + pair - group
        levels.append(rank)
        k *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1]] = np.arange(n)
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank, step = levels[level], 1 << level
        fits = np.flatnonzero((left < n) & (right < n))
        fits = fits[(owner[left[fits]] == owner[suffixes[fits]]) & (owner[right[fits]] == owner[suffixes[fits + 1]])]
        fits = fits[rank[left[fits]] == rank[right[fits]]]
        fits = fits[owner[left[fits]] == owner[right[fits]]]
        common[fits] += step
        left[fits] += step
        right[fits] += step
    return suffixes, common


def repeat_lengths(symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each position, the words of the longest prefix of its suffix that occurs elsewhere in its text."""
    suffixes, common = suffix_array(symbols, owner)
    out = np.zeros(len(symbols), np.int64)
    out[suffixes[1:]] = common
    out[suffixes[:-1]] = np.maximum(out[suffixes[:-1]], common)
    return out


def _ranks(order: np.ndarray, ordered: np.ndarray, n: int) -> np.ndarray:
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(np.r_[True, ordered[1:] != ordered[:-1]], np.arange(n), 0))
    return rank


def _covered(at: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray, min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """The columns of COLUMNS for each text."""
    n = len(offsets) - 1
    starts, ends, owner = spans.words(data, offsets)
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    chars = chars[ends] - chars[starts]
    symbols = spans.join_hashes(spans.mix(owner.astype(np.uint64)), spans.hash_spans(data, starts, ends))
    repeats = repeat_lengths(symbols, owner)
    at = np.flatnonzero(repeats >= min_repeat)
    covered = _covered(at, repeats[at], len(starts))
    thrice = _covered(np.flatnonzero(repeats >= 3), 3, len(starts))
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, owner, repeats)
    first, last, line_owner = spans.lines(data, offsets)
    full = np.searchsorted(starts, last, "left") > np.searchsorted(starts, first, "left")
    key = np.unique(spans.join_hashes(spans.mix(line_owner[full].astype(np.uint64)), spans.hash_spans(data, first[full], last[full])), return_index=True)[1]
    symbol_at = np.flatnonzero(_SYMBOL[data])
    return {
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": spans.per_text(chars, owner, n),
        "n_symbols": np.bincount(np.searchsorted(offsets, symbol_at, "right") - 1, minlength=n),
        "n_dup_lines": np.bincount(line_owner[full], minlength=n) - np.bincount(line_owner[full][key], minlength=n),
        "n_repeat_words": np.bincount(owner[thrice], minlength=n),
        "covered_chars": spans.per_text(chars[covered], owner[covered], n),
        "longest_repeat": longest,
    }


def with_repetition(docs: DataFrame, *, text: str = "text", min_repeat: int = MIN_REPEAT) -> DataFrame:
    """All columns of ``docs`` (an own column of a name in COLUMNS gives way) and those of COLUMNS.

    Null and empty texts have zeros; rows that repeat are measured each. Memory is that of a few megabytes of
    text, or of the longest text.
    """
    keep = [c for c in docs.columns if c not in COLUMNS]
    schema = docs.select(*keep).schema
    for name, kind in COLUMNS.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = spans.text_bytes(batch.column(batch.schema.get_field_index(text)))
            for i, j in spans.blocks(offsets):
                part = data[offsets[i] : offsets[j]]
                found = measure(part, offsets[i : j + 1] - offsets[i], min_repeat)
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, *(pa.array(found[c].astype(np.int64)) for c in COLUMNS)], names=[*keep, *COLUMNS])

    return docs.select(*keep).mapInArrow(run, schema)


def judge(measured: DataFrame, *, max_covered: float = MAX_COVERED, max_repeat_words: int = MAX_REPEAT_WORDS, max_repeat_share: float = MAX_REPEAT_SHARE) -> DataFrame:
    """Adds ``base_failed`` and ``kept``: a text goes if it fails the base rules, if repeats cover too much of it or if its longest repeat is too long. Own columns of these names give way."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    covered = F.col("covered_chars") > max_covered * F.col("word_chars")
    long = (F.col("longest_repeat") > max_repeat_words) & (F.col("longest_repeat") > max_repeat_share * F.col("n_words"))
    return measured.withColumn("base_failed", base).withColumn("kept", ~(base | covered | long))
