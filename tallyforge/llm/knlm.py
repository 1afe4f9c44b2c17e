"""LM scoring: an interpolated modified Kneser-Ney n-gram model, counted and looked up in Spark.

Texts are held as chunks of a few megabytes with their word hashes. For each order from the highest down, a chunk sends its
distinct n-grams (64-bit hashes) with their counts to shards of the hash range. A shard merges what it gets into sorted hash arrays
and stores them as a file of the model in the shared folder. It maps this file into memory and looks up every chunk's n-grams there: the
count, and whether the chunk is the one (of those that have it) to speak for that n-gram. So each distinct n-gram adds one to the count
of its suffix and to the statistics of its context in the next round, which is what Kneser-Ney smoothing counts. Nothing is
pruned. ``score_with`` scores other texts by a stored model in the same way: their n-grams go to the shards, whose workers map the files.

Chunks and shards both grow with the corpus, so no chunk speaks to all shards. N-grams travel in tiers: a tier's task takes what about
``Sizes.fan`` senders say of one range of hashes, merges it, and cuts the range for the next tier into at most as many ranges.
The last tier's ranges are the shards; answers go back the same way. Messages grow with the corpus times the number of tiers (one up to
32 GB of text, two up to 130 TB), and a frequent n-gram is at most one entry for each sender of a task.

A text of tokens w is scored as sum log10 p(w | the n - 1 tokens before), each text alone, with an end token that counts and begin
tokens that don't. Tokens not seen in training share one place of the V + 1 of the uniform distribution at the bottom.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .staging import fresh_path, staged

ORDER = 3
END, BEGIN = np.uint64(0xA5A5A5A5A5A5A5A5), np.uint64(0x5A5A5A5A5A5A5A5A)
_CHUNK = "chunk long, ids array<long>, train array<boolean>, sizes array<long>, tokens binary, n_tokens long"
_SENT = "k int, part long, shard int, chunk long, blob binary"
_REPLY = "chunk long, k int, shard int, blob binary"
_STATS = ["n1", "n2", "n3", "n4", "more", "total", "kinds", "raw_total"]


@dataclass(frozen=True)
class Sizes:
    """How the work is cut: bytes of text in a chunk, about (a longer text is a chunk of its own), tokens of the corpus for each shard, and senders of a task, about."""

    chunk_bytes: int = 8 << 20
    shard_tokens: int = 2_000_000
    fan: int = 4096


@dataclass(frozen=True)
class Route:
    """The way from chunks to shards: tier t has ``fan ** (tiers - t)`` parts of the chunks, and ranges of as many shards each."""

    shards: int
    tiers: int
    fan: int

    @classmethod
    def between(cls, chunks: int, shards: int, fan: int) -> Route:
        tiers = 1
        while fan**tiers < max(chunks, shards):
            tiers += 1
        return cls(shards, tiers, fan)

    def part(self, chunk: int) -> int:
        """The part of the first tier that a chunk belongs to; chunks have random ids of 62 bits, so parts are about as large."""
        return chunk * self.fan ** (self.tiers - 1) >> 62

    def ranges(self, tier: int, above: int = 0) -> tuple[int, np.ndarray]:
        """The first of the tier's ranges that range ``above`` of the tier before is cut into, and the hashes where the others begin."""
        step, first = self.fan ** (self.tiers - tier), above * self.fan
        last = min(first + self.fan, -(-self.shards // step))
        return first, np.array([(s * step << 64) // self.shards for s in range(first + 1, last)], np.uint64)


def _narrow(column: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the least width that holds them."""
    most = int(column.max(initial=0))
    return column.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


def pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers in their least widths, stored byte plane by byte plane and compressed."""
    columns = [_narrow(c) for c in columns]
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T) for c in columns]
    return bytes([len(columns), *(c.itemsize for c in columns)]) + zstandard.compress(b"".join(planes), 1)


def unpack(blob: bytes) -> list[np.ndarray]:
    widths = blob[1 : 1 + blob[0]]
    data = np.frombuffer(zstandard.decompress(blob[1 + len(widths) :]), np.uint8)
    n, at, out = len(data) // sum(widths), 0, []
    for w in widths:
        out.append(np.ascontiguousarray(data[at : at + w * n].reshape(w, n).T).view(f"<u{w}").ravel())
        at += w * n
    return out


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and each value's place among them. Sorts positions along in the low bits, which is several times faster than to sort indices."""
    n = len(values)
    mask = np.uint64((1 << max(1, (n - 1).bit_length())) - 1)
    mixed = values & ~mask | np.arange(n, dtype=np.uint64)
    mixed.sort()
    at = (mixed & mask).astype(np.int64)
    ordered = values[at]
    if (ordered[1:] < ordered[:-1]).any():  # two values agree in all high bits
        return np.unique(values, return_inverse=True)
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    place = np.empty(n, np.int64)
    place[at] = np.cumsum(new) - 1
    return ordered[new], place


def as_chunks(docs: DataFrame, id: str, text: str, train: str, chunk_bytes: int) -> DataFrame:
    """Rows of _CHUNK; tokens are word hashes, each text closed by END."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = spans.text_bytes(batch.column(2))
            data = spans.lowered(data)
            for i, j in spans.blocks(offsets, chunk_bytes):
                part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts, ends, owner = spans.words(part, off)
                words = spans.hash_spans(part, starts, ends)
                sizes = np.bincount(owner, minlength=j - i) + 1
                tokens = np.full(sizes.sum(), END)
                tokens[np.arange(len(words)) + owner] = words
                kinds, place = distinct(tokens)
                kept, places = pack(np.diff(kinds, prepend=np.uint64(0))), pack(place)
                blob = len(kept).to_bytes(8, "little") + kept + places
                lists = [pa.array([batch.column(c).slice(i, j - i).to_pylist()], t) for c, t in ((0, pa.list_(pa.int64())), (1, pa.list_(pa.bool_())))]
                yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 66]), *lists, pa.array([sizes.tolist()], pa.list_(pa.int64())), pa.array([blob], pa.binary()), pa.array([len(tokens)], pa.int64())], names=["chunk", "ids", "train", "sizes", "tokens", "n_tokens"])

    return docs.select(F.col(id).cast("long"), F.coalesce(F.col(train), F.lit(False)), text).mapInArrow(run, _CHUNK)


class Chunk:
    """The n-grams of a chunk: for each order their hashes by position."""

    def __init__(self, sizes: np.ndarray, train: np.ndarray, blob: bytes, order: int):
        n = int.from_bytes(blob[:8], "little")
        kinds = np.cumsum(unpack(blob[8 : 8 + n])[0], dtype=np.uint64)
        words = kinds[unpack(blob[8 + n :])[0]]
        self.first = np.cumsum(sizes) - sizes
        self.train = np.repeat(train, sizes)
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.grams, self.begins = [words], [BEGIN]
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for _ in range(2, order + 1):
            before = np.roll(self.grams[-1], 1)
            before[self.first] = self.begins[-1]
            self.grams.append(spans.join_hashes(before, words))
            self.begins.append(spans.join_hashes(np.array([self.begins[-1]]), np.array([BEGIN]))[0])

    def keys(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct n-grams of order k (and the begin context of the next order), and the place of each position's; the last is that of the begin."""
        if k not in self.known:
            keys, place = distinct(np.append(self.grams[k - 1], self.begins[k - 1]))
            self.known[k] = keys, place.astype(np.uint32)
        return self.known[k]

    def contexts(self, k: int) -> np.ndarray:
        """For each position, the place among the keys of order k - 1 of its n-gram's context."""
        place = self.keys(k - 1)[1]
        before = np.roll(place[:-1], 1)
        before[self.first] = place[-1]
        return before


def contributions(chunk: Chunk, k: int, order: int, above: list[np.ndarray] | None) -> tuple[np.ndarray, list[np.ndarray]]:
    """What a chunk says of its keys of order k: the count; below the highest order, sum and 1, 2, 3+ kinds of what follows as a context; at order 1, the count in training."""
    keys, place = chunk.keys(k)
    n = len(keys)
    raw = np.bincount(place[:-1][chunk.train], minlength=n) if k in (1, order) else None
    if k == order:
        return keys, [raw, *([np.zeros(n, np.int64)] * 4 + [raw] if k == 1 else [])]
    count, own = above[:2]
    upper, at = chunk.keys(k + 1)
    one = np.zeros(len(upper), np.int64)  # a position for each distinct n-gram above
    one[at[:-1]] = np.arange(len(at) - 1)
    speak = np.flatnonzero((own > 0) & (count > 0))
    where, count = one[speak], count[speak].astype(np.int64)
    context = chunk.contexts(k + 1)[where]
    kinds = [np.bincount(context[count == c], minlength=n) for c in (1, 2)] + [np.bincount(context[count > 2], minlength=n)]
    found = [np.bincount(place[where], minlength=n), np.bincount(context, count, n).astype(np.int64), *kinds]
    return keys, [*found, raw] if k == 1 else found


def _chunk_of(row: dict, order: int) -> Chunk:
    return Chunk(np.array(row["sizes"]), np.array(row["train"], bool), row["tokens"], order)


def _joined(blobs: list[dict]) -> list[np.ndarray]:
    """The columns of all ranges in order."""
    parts = [unpack(x["blob"]) for x in sorted(blobs, key=lambda x: x["shard"])]
    return [np.concatenate(columns) for columns in zip(*parts)]


def _messages(k: int, part: int, sender: int, keys: np.ndarray, values: list[np.ndarray] | np.ndarray, first: int, edges: np.ndarray) -> pa.Table:
    """Rows of _SENT: the keys with their values, cut at the edges of ranges."""
    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    found = [(first + s, pack(np.diff(keys[a:b], prepend=np.uint64(0)), *(v[a:b] for v in values))) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
    n = len(found)
    columns = [pa.array([k] * n, pa.int32()), pa.array([part] * n, pa.int64()), pa.array([s for s, _ in found], pa.int32()), pa.array([sender] * n, pa.int64()), pa.array([x for _, x in found], pa.binary())]
    return pa.table(columns, names=["k", "part", "shard", "chunk", "blob"])


def send(chunks: DataFrame, k: int, order: int, route: Route, replies: DataFrame | None = None) -> DataFrame:
    """What chunks say of their n-grams of order k to the first tier; ``replies`` are those of order k + 1."""
    first, edges = route.ranges(1)

    def say(row: dict, above: list[np.ndarray] | None) -> pa.Table:
        return _messages(k, route.part(row["chunk"]), row["chunk"], *contributions(_chunk_of(row, order), k, order, above), first, edges)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from say(batch.slice(i, 1).to_pylist()[0], None).to_batches()

    if replies is None:
        return chunks.mapInArrow(start, _SENT)
    own = replies.select("chunk", "shard", "blob")
    return chunks.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInArrow(lambda one, met: say(one.to_pylist()[0], _joined(met.to_pylist())), _SENT)


def _merged(sent: pa.Table) -> tuple[list[tuple[int, np.ndarray]], np.ndarray, np.ndarray, np.ndarray]:
    """What a task was sent: each sender with its keys, all keys, the sums of their values, and which sender is the first to have counted each."""
    senders = sent.column("chunk").to_pylist()
    parts = []
    for i in sorted(range(len(senders)), key=senders.__getitem__):
        keys, *values = unpack(sent.column("blob")[i].as_py())
        parts.append((senders[i], np.cumsum(keys, dtype=np.uint64), values))
    kinds = np.unique(np.concatenate([own for _, own, _ in parts]))
    totals = np.zeros((len(parts[0][2]), len(kinds)), np.int64)
    spoken = np.full(len(kinds), len(parts), np.int32)
    for i, (_, own, values) in enumerate(parts):
        at = np.searchsorted(kinds, own)
        for total, v in zip(totals, values):
            total[at] += v
        if values:
            at = at[values[0] > 0]
            spoken[at] = np.minimum(spoken[at], i)
    return [(sender, own) for sender, own, _ in parts], kinds, totals, spoken


def relay(sent: DataFrame, route: Route, tier: int) -> DataFrame:
    """What the tasks of a tier, having merged what they were sent, say to the next tier. Their part of the chunks is the sender."""

    def run(table: pa.Table) -> pa.Table:
        k, part, shard = (table.column(c)[0].as_py() for c in ("k", "part", "shard"))
        _, kinds, totals, _ = _merged(table)
        return _messages(k, part // route.fan, part, kinds, totals, *route.ranges(tier + 1, shard))

    return sent.groupBy("k", "part", "shard").applyInArrow(run, _SENT)


def pass_on(sent: DataFrame, replies: DataFrame, fan: int) -> DataFrame:
    """Replies (_REPLY) to the senders of a tier from those that its tasks got from the next. If a task is to speak for an n-gram, its first sender is."""

    def run(one: pa.Table, met: pa.Table) -> pa.Table:
        k, shard = one.column("k")[0].as_py(), one.column("shard")[0].as_py()
        senders, kinds, _, spoken = _merged(one)
        told, out = _joined(met.to_pylist()), []
        for n, (sender, own) in enumerate(senders):
            at = np.searchsorted(kinds, own)
            looked = [c[at] for c in told]
            looked[1] = looked[1] * (spoken[at] == n)
            out.append(pack(*looked))
        n = len(senders)
        return pa.table([pa.array([s for s, _ in senders], pa.int64()), pa.array([k] * n, pa.int32()), pa.array([shard] * n, pa.int32()), pa.array(out, pa.binary())], names=["chunk", "k", "shard", "blob"])

    own = replies.select("k", F.col("chunk").alias("part"), F.expr(f"cast(shard div {fan} as int)").alias("above"), "shard", "blob")
    return sent.groupBy("k", "part", "shard").cogroup(own.groupBy("k", "part", "above")).applyInArrow(run, _REPLY)


def _up(sent: DataFrame, route: Route) -> list[DataFrame]:
    """The messages of each tier; those that are merged on the way and met again by the answers are written."""
    tiers = [sent]
    for tier in range(1, route.tiers):
        tiers[-1] = staged(tiers[-1], "sent")
        tiers.append(relay(tiers[-1], route, tier))
    return tiers


def _down(tiers: list[DataFrame], replies: DataFrame, route: Route) -> DataFrame:
    """Replies to the chunks from those of the shards."""
    for sent in tiers[-2::-1]:
        replies = pass_on(sent, replies, route.fan)
    return replies if route.tiers == 1 else staged(replies, "replies")


def _store(path: str, columns: list[np.ndarray]) -> str:
    """Writes sorted hashes and the columns beside them, each in its least width, as a file; returns what ``_mapped`` needs."""
    columns = [columns[0], *map(_narrow, columns[1:])]
    system, at = fs.FileSystem.from_uri(path)
    system.create_dir(at.rpartition("/")[0], recursive=True)
    with system.open_output_stream(at) as out:
        for c in columns:
            out.write(np.ascontiguousarray(c).tobytes())
    return json.dumps([path, len(columns[0]), [c.dtype.str for c in columns]])


def _mapped(stored: str) -> list[np.ndarray]:
    """The arrays of a stored shard, mapped where the shared folder is a mounted one, else read."""
    path, n, kinds = json.loads(stored)
    system, at = fs.FileSystem.from_uri(path)
    if not n:
        return [np.zeros(0, k) for k in kinds]
    data = np.memmap(at, np.uint8, "r") if isinstance(system, fs.LocalFileSystem) else np.frombuffer(system.open_input_file(at).readall(), np.uint8)
    ends = np.cumsum([0, *(n * np.dtype(k).itemsize for k in kinds)])
    return [data[a:b].view(k) for a, b, k in zip(ends, ends[1:], kinds)]


def _remove(stored: str) -> None:
    system, at = fs.FileSystem.from_uri(json.loads(stored)[0])
    system.delete_file(at)


def _found(columns: list[np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the sorted ``keys`` in a stored shard, and which of them are there."""
    at = np.searchsorted(columns[0], keys)
    at[at == len(columns[0])] = 0
    return at, columns[0][at] == keys if len(columns[0]) else np.zeros(len(keys), bool)


def answer(sent: DataFrame, path: str, keep: bool) -> DataFrame:
    """For each shard and sender the totals of its keys (count, whether it speaks, then as ``contributions``); with chunk -1 the shard's file and statistics.

    Without ``keep`` the file goes once the senders are answered; it takes about twice the text's compressed size.
    """
    schema = f"{_REPLY}, stored string, " + ", ".join(f"{c} long" for c in _STATS)

    def run(table: pa.Table) -> pa.Table:
        k, shard = table.column("k")[0].as_py(), table.column("shard")[0].as_py()
        senders, kinds, totals, spoken = _merged(table)
        held = totals.any(axis=0)  # the rest is in no training text
        stored = _store(f"{path}/{shard}-{uuid.uuid4().hex}", [kinds[held], *totals[:, held]])
        spoken, count = spoken[held], totals[0]
        stats = [*(int((count == c).sum()) for c in (1, 2, 3, 4)), int((count > 2).sum()), int(count.sum()), int((count > 0).sum()), int(totals[-1].sum())]
        del kinds, totals, count
        columns, out = _mapped(stored), []
        for n, (sender, own) in enumerate(senders):
            at, there = _found(columns, own)
            looked = [np.where(there, c[at], 0) if len(c) else np.zeros(len(own), np.int64) for c in [columns[1], spoken == n, *columns[2:]]]
            out.append((sender, k, shard, pack(*looked), None, *[None] * len(_STATS)))
        if not keep:
            del columns
            _remove(stored)
        out.append((-1, k, shard, None, stored, *stats))
        types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string(), *[pa.int64()] * len(_STATS)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["chunk", "k", "shard", "blob", "stored", *_STATS])

    return sent.groupBy("shard").applyInArrow(run, schema)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams with count 1 to 4; where these are too few, half of a count at most."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    found = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))


def probabilities(chunk: Chunk, replies: list[list[np.ndarray]], stats: list[dict], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Model probability and training count of each token."""
    p = raw = None
    for k in range(1, order + 1):
        place = chunk.keys(k)[1][:-1]
        reply, s = replies[k - 1], stats[k - 1]
        d = np.array([0, *discounts(s["n1"], s["n2"], s["n3"], s["n4"])])
        own = reply[0].astype(np.int64)
        taken = np.maximum(own - d[np.minimum(own, 3)], 0)[place]
        if k == 1:
            raw = reply[6][place]
            whole = max(s["total"], 1)
            rest = (d[1] * s["n1"] + d[2] * s["n2"] + d[3] * s["more"]) / whole if s["total"] else 1.0
            p = taken / whole + rest / (s["kinds"] + 1)
        else:
            total, *kinds = (c.astype(np.int64) for c in replies[k - 2][2:6])
            at = chunk.contexts(k)
            rest = (d[1] * kinds[0] + d[2] * kinds[1] + d[3] * kinds[2]) / np.maximum(total, 1)
            p = np.where((total > 0)[at], taken / np.maximum(total, 1)[at] + rest[at] * p, p)
    return p, raw


@dataclass
class Model:
    """A stored model: its files (k, shard, stored; k is the order), the number of shards, and the statistics of each order from 1 on."""

    files: DataFrame
    shards: int
    stats: list[dict]

    @property
    def order(self) -> int:
        return len(self.stats)


def _scored(chunks: DataFrame, told: DataFrame, stats: list[dict], id: str) -> DataFrame:
    """Scores of the texts of ``chunks``; ``told`` (chunk, k, shard, blob) has the replies of all orders."""
    order, n_train, n_kinds = len(stats), stats[0]["raw_total"], stats[0]["kinds"]

    def run(one: pa.Table, met: pa.Table) -> pa.Table:
        row = one.to_pylist()[0]
        chunk, n = _chunk_of(row, order), len(row["ids"])
        p, raw = probabilities(chunk, [_joined(met.filter(pc.equal(met.column("k"), k)).to_pylist()) for k in range(1, order + 1)], stats, order)
        base = np.log10((raw + 0.5) / (n_train + 0.5 * (n_kinds + 1)))
        base, score = (np.bincount(chunk.owner, v, n) for v in (base, np.log10(p)))
        columns = [pa.array(row["ids"], pa.int64()), pa.array(row["sizes"], pa.int64()), pa.array(np.bincount(chunk.owner[raw > 0], minlength=n)), pa.array(np.full(n, n_train))]
        return pa.table([*columns, pa.array(base), pa.array(score), pa.array(10 ** (-score / np.array(row["sizes"])))], names=[id, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    schema = f"`{id}` long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, schema)


def _learned(chunks: DataFrame, order: int, keep: bool, sizes: Sizes) -> tuple[DataFrame, Model]:
    """The replies to the chunks' n-grams of all orders (_REPLY), and the model, whose files are there only with ``keep``."""
    n_chunks, n_tokens = chunks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    route = Route.between(n_chunks, max(4, -(-n_tokens // sizes.shard_tokens)), sizes.fan)
    path = fresh_path(chunks.sparkSession, "model")
    replies: dict[int, DataFrame] = {}
    files: list[DataFrame] = []
    stats: dict[int, dict] = {}
    for k in range(order, 0, -1):
        tiers = _up(send(chunks, k, order, route, replies.get(k + 1)), route)
        answered = staged(answer(tiers[-1], f"{path}/{k}", keep), f"order{k}")
        shards = answered.where("chunk = -1")
        stats[k] = shards.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _STATS)).first().asDict()
        files.append(shards.select("k", "shard", "stored"))
        replies[k] = _down(tiers, answered.where("chunk >= 0").select("chunk", "k", "shard", "blob"), route)
    model = Model(functools.reduce(DataFrame.unionByName, files), route.shards, [stats[k] for k in range(1, order + 1)])
    return functools.reduce(DataFrame.unionByName, replies.values()), model


def score_documents(docs: DataFrame, train: str, *, id: str = "doc_id", text: str = "text", order: int = ORDER, sizes: Sizes = Sizes()) -> DataFrame:
    """``id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-half unigrams), ``score`` (log10 of the model) and ``perplexity`` of each row.

    The model learns from rows where the column ``train`` is true. A null or empty text is the end token alone; rows
    that repeat count and are scored each. Ids are whole numbers or null. Other columns are not carried. Without training rows every token
    has probability 1; an empty table gives no rows. The model is stored shard by shard while it answers; ``train_model`` keeps it.
    """
    chunks = staged(as_chunks(docs, id, text, train, sizes.chunk_bytes), "chunks")
    told, model = _learned(chunks, order, False, sizes)
    return _scored(chunks, told, model.stats, id)


def train_model(docs: DataFrame, *, id: str = "doc_id", text: str = "text", order: int = ORDER, sizes: Sizes = Sizes()) -> Model:
    """A model of all rows of ``docs``, stored in the shared folder."""
    chunks = staged(as_chunks(docs.select(id, text).withColumn("_train", F.lit(True)), id, text, "_train", sizes.chunk_bytes), "chunks")
    return _learned(chunks, order, True, sizes)[1]


def score_with(docs: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """As ``score_documents``, of any texts by a stored model: each shard's worker maps its file and looks up the n-grams sent to it."""
    order = model.order
    chunks = staged(as_chunks(docs.select(id, text).withColumn("_train", F.lit(False)), id, text, "_train", sizes.chunk_bytes), "chunks")
    route = Route.between(chunks.count(), model.shards, sizes.fan)
    first, edges = route.ranges(1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = _chunk_of(row, order)
                for k in range(1, order + 1):
                    yield from _messages(k, route.part(row["chunk"]), row["chunk"], chunk.keys(k)[0], [], first, edges).to_batches()

    def look(asked: pa.Table, stored: pa.Table) -> pa.Table:
        files = stored.column("stored").to_pylist()
        columns = _mapped(files[0]) if files else [np.zeros(0, np.uint64)] * 7
        out = []
        for row in asked.to_pylist():
            keys = np.cumsum(unpack(row["blob"])[0], dtype=np.uint64)
            at, there = _found(columns, keys)
            looked = [np.where(there, c[at], 0) if len(c) else np.zeros(len(keys), np.int64) for c in columns[1:]]
            out.append((row["chunk"], row["k"], row["shard"], pack(looked[0], np.zeros(len(keys), np.int64), *looked[1:])))
        types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, types)], names=["chunk", "k", "shard", "blob"])

    tiers = _up(chunks.mapInArrow(ask, _SENT), route)
    answered = tiers[-1].groupBy("k", "shard").cogroup(model.files.groupBy("k", "shard")).applyInArrow(look, _REPLY)
    return _scored(chunks, _down(tiers, answered, route), model.stats, id)
