"""Best-fit packing of tokenized documents into sequences of fixed capacity.

``tokenize_pieces`` gives token ids, cut into pieces that fit a sequence. ``best_fit_pack`` places pieces by
best-fit decreasing: longest first, each into the open sequence with the least room that suffices. What that
algorithm does depends on lengths alone, and pieces of one length are alike, so it runs on the histogram of
lengths, which has ``capacity`` entries at most however large the corpus is. Open sequences with equal room are
kept as ranges of numbers, and a segment tree over the room left finds the tightest in logarithmic time. The result
is a table of runs ("the k-th to l-th piece of length n go to sequences from s on"), which Spark joins with the
rank of each piece among those of its length.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import spans
from .staging import staged

#: Units of text that a task remembers the ids of, at most; then it starts anew.
REMEMBERED = 100_000
_RUNS = "length int, rank_from long, rank_to long, first_sequence long, per_sequence int, room_used int"


class RoomTree:
    """Which amounts of room left (0 to capacity) have open sequences: a segment tree for the least one that suffices."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.leaves)

    def set(self, room: int, present: bool) -> None:
        i = room + self.leaves
        self.any[i] = present
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def least(self, wanted: int) -> int | None:
        """Least room of at least ``wanted`` that an open sequence has."""
        i = wanted + self.leaves
        if self.any[i]:
            return wanted
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


def plan_runs(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of _RUNS for as many pieces of each length as the histogram says.

    Each length splits two ranges at most and opens two, and a range is used by lengths that add up to the capacity
    at most, so the rows number under 10 * capacity * sqrt(2 * capacity) whatever the corpus.
    """
    tree = RoomTree(capacity)
    ranges: dict[int, list[list[int]]] = {}
    runs, opened = [], 0

    def give(room: int, first: int, n: int) -> None:
        if n and room:
            ranges.setdefault(room, []).append([first, n])
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of length {length} doesn't fit sequences of {capacity}")
        rank, left = 0, histogram[length]
        while left:
            room = tree.least(length)
            if room is None:
                room, (first, n) = capacity, (opened, -(-left // (capacity // length)))
                opened += n
            else:
                first, n = ranges[room].pop()
                if not ranges[room]:
                    tree.set(room, False)
            per = room // length
            full = min(n, left // per)
            if full:
                runs.append((length, rank, rank + full * per, first, per, capacity - room))
                give(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
                first, n = first + full, n - full
            if n and left:  # one sequence that gets the rest of this length
                runs.append((length, rank, rank + left, first, per, capacity - room))
                give(room - left * length, first, 1)
                left, first, n = 0, first + 1, n - 1
            give(room, first, n)
    return runs


def best_fit_pack(pieces: DataFrame, *, capacity: int = 2048, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: best-fit decreasing over all rows.

    Rows are written once to the shared folder; no column but ``length`` matters to the placement. A null length or
    one outside 1..capacity is an error. Own columns named sequence_id or offset give way; others may have any
    name. An empty table gives no rows. Equal lengths are placed in the order of the written rows.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    rows = staged(pieces.select(F.struct(*(F.col(f"`{c}`") for c in pieces.columns)).alias("piece"), F.col(length).alias("length"), F.monotonically_increasing_id().alias("row")), "pieces")
    rows = rows.withColumn("part", F.shiftright("row", 33))
    counts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {n: count for n, count in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most `capacity` rows
    if None in histogram:
        raise ValueError("a piece has no length")
    runs = spark.createDataFrame(plan_runs(histogram, capacity), _RUNS).withColumnRenamed("length", "run_length")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = Window.partitionBy("length", "part").orderBy("row")
    ranked = rows.withColumn("rank", F.row_number().over(own) - 1).join(counts, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    fits = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    nth = F.col("rank") - F.col("rank_from")
    return ranked.join(F.broadcast(runs), fits).select(
        "piece.*",
        (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).alias("sequence_id"),
        (F.col("room_used") + nth % F.col("per_sequence") * F.col("length")).cast("long").alias("offset"),
    )


#: How byte-level vocabularies of this kind cut text before merging (fixed value).
UNIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def unit_encoding(vocab: dict[str, int]):
    """The same vocabulary in ``tiktoken``, which takes short strings far faster: there a merge ranks by the id it makes."""
    import tiktoken

    from .bpe_count import byte_symbols

    byte = {c: b for b, c in enumerate(byte_symbols())}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items()}
    return tiktoken.Encoding("units", pat_str=UNIT_PATTERN, mergeable_ranks=ranks, special_tokens={})


class UnitIds(dict):
    """Maps a unit of text to its ids as bytes, and remembers it. A unit is a space and what follows it up to the next space.

    It lives as long as a task, so that the worker's next stage has its memory.
    """

    def __init__(self, path: str):
        import json

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.path = path
        self.specials = [t["content"] for t in file["added_tokens"]]
        self.mixed = re.compile(r"\s (?:\s|$)")
        self.encoding = unit_encoding(file["model"]["vocab"])

    @cached_property
    def tokenizer(self):
        """Only made where a text needs it."""
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __missing__(self, unit: str) -> bytes:
        """unit: without the space."""
        if len(self) >= REMEMBERED:
            self.clear()
        self[unit] = found = array("I", self.encoding.encode_ordinary(" " + unit)).tobytes()
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text.

        Pieces of byte-level vocabularies hold a space only as their first character, so a space after a word starts
        a piece. Texts where runs of white space make units depend on each other, and those with special strings, go
        whole to the tokenizer.
        """
        if self.mixed.search(text) or any(s in text for s in self.specials):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.split(" ")
        return b"".join([array("I", self.encoding.encode_ordinary(first)).tobytes(), *map(self.__getitem__, rest)])


def tokenize_pieces(docs: DataFrame, path: str, *, id: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Token ids of each text by the ``tokenizers`` file at ``path``, closed by ``end_id``, in pieces of at most ``capacity``.

    Columns: ``id``, ``piece`` (from 0), ``start`` (ids of the document before it), ``length``, ``ids`` (binary,
    little-endian unsigned 32-bit). A longer document is cut into pieces of ``capacity``, of which the first may be
    shorter. A null or empty text is ``end_id`` alone; rows with equal ids stay apart; other columns are not carried.
    """
    schema = docs.select(id).schema.add("piece", "integer").add("start", "long").add("length", "integer").add("ids", "binary")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = UnitIds(path)
        for batch in batches:
            _, offsets = spans.text_bytes(batch.column(1))
            for i, j in spans.blocks(offsets):
                doc, piece, start, length, ids = [], [], [], [], []
                for k, found in enumerate(batch.column(1).slice(i, j - i).to_pylist()):
                    found = own.encode(found or "") + end
                    n = len(found) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        doc.append(i + k), piece.append(p), start.append(a), length.append(b - a), ids.append(found[4 * a : 4 * b])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(ids, pa.binary())], names=schema.names)

    return docs.select(id, text).mapInArrow(run, schema)
