"""Token counts by byte-pair merging with a heap and a linked list.

A vocabulary file of the ``tokenizers`` library gives the merges; counting needs their ranks alone. The symbols of a
piece start as its bytes, the last one marked as a word end. The adjacent pair of lowest rank is popped from the heap
again and again and its two symbols become one in a linked list; the count is the symbols at first less the merges.
No identifier is made. Words recur, so each task keeps the counts of words it has seen in a bounded table.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans

#: Unicode white space (fixed values of the Unicode standard).
WHITE = "\t-\r \x85\xa0  -     　"
#: Words, and pieces of words, that a worker remembers at most; then it starts anew.
REMEMBERED = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, more = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(more))
        more += b not in plain
    return out


def merge_table(vocab: dict[str, int], merges: list, end: str) -> tuple[list[int], list[int], dict[int, int]]:
    """Symbol of each byte, of each byte that ends a word, and for two symbols side by side their merge's rank and result."""
    chars = byte_symbols()
    table = {}
    for rank, merge in enumerate(merges):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        table[vocab[a] << 20 | vocab[b]] = rank << 20 | vocab[a + b]
    return [vocab[c] for c in chars], [vocab[c + end] for c in chars], table


class MergeCounter(dict):
    """Maps a word between white space to its number of tokens, and remembers it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.symbols, self.last_symbols, self.merges = merge_table(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")")
        self.special_hint = min(specials, key=len)[:2]
        self.piece = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
        self.white = re.compile(f"[{WHITE}]+")
        self.pieces: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        if word.isascii():
            text = word.lower()
        else:  # lower case goes by character
            text = "".join(c.lower() for c in unicodedata.normalize("NFC", word))
        n = 0
        for piece in self.piece.findall(text):
            found = self.pieces.get(piece)
            if found is None:
                if len(self.pieces) >= REMEMBERED:
                    self.pieces.clear()
                found = self.pieces[piece] = self.merged(piece)
            n += found
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = n
        return n

    def merged(self, piece: str) -> int:
        """Symbols of the piece less the merges that apply. A heap entry is a merge and the place of its left symbol."""
        data = piece.encode()
        word = [self.symbols[b] for b in data]
        word[-1] = self.last_symbols[data[-1]]
        n = count = len(word)
        merges = self.merges
        heap = []
        for i in range(n - 1):
            if (merge := merges.get(word[i] << 20 | word[i + 1])) is not None:
                heap.append(merge << 32 | i)
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i, merge = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if j >= n or merges.get(word[i] << 20 | word[j]) != merge:
                continue
            word[i], word[j] = merge & 0xFFFFF, -1
            count -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (merge := merges.get(word[i] << 20 | word[k])) is not None:
                    heappush(heap, merge << 32 | i)
            if (h := before[i]) >= 0 and (merge := merges.get(word[h] << 20 | word[i])) is not None:
                heappush(heap, merge << 32 | h)
        return count

    def plain(self, text: str, odd: bool = True) -> int:
        """Tokens of a text without special strings. odd: it may hold separators that str.split takes and Unicode doesn't count as white space."""
        return sum(map(self.__getitem__, self.white.split(text) if odd else text.split()))

    def count(self, text: str, odd: bool = True) -> int:
        """Tokens of a text; a special string is one token."""
        if self.special_hint in text and len(parts := self.special.split(text)) > 1:
            return sum(1 if i % 2 else self.plain(x, odd) for i, x in enumerate(parts))
        return self.plain(text, odd)


@cache
def counter(path: str) -> MergeCounter:
    """One for each worker process."""
    return MergeCounter(path)


def count_tokens(docs: DataFrame, path: str, *, id: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """``id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of each row.

    Null and empty texts have no tokens; rows with equal ids stay apart; other columns are not carried.
    """
    schema = docs.select(id).schema.add("n_bytes", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            data, offsets = spans.text_bytes(batch.column(1))
            for i, j in spans.blocks(offsets):
                part = data[offsets[i] : offsets[j]]
                odd = bool(((part >= 0x1C) & (part <= 0x1F)).any())
                tokens = [own.count(x, odd) if x else 0 for x in batch.column(1).slice(i, j - i).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(offsets[i : j + 1])), pa.array(tokens, pa.int64())], names=[id, "n_bytes", "n_tokens"])

    return docs.select(id, text).mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
