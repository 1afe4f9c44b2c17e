"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Of all ways to cut a text into pieces of the vocabulary the one with the greatest sum of log scores is taken; a character that no
piece covers costs a fixed penalty and becomes its UTF-8 bytes as byte pieces. Spaces are written as a marker, one in front
of the text too. A piece holds the marker only at its start or consists of markers, so the best cut of a text joins the best cuts
of its words, and each task remembers those of words it has seen in a bounded table. Words stay Arrow columns and ids numpy arrays
throughout: distinct words are found by dictionary encoding, cut side by side, and their ids copied to where the words stand.

The scores of a BPE model are merge ranks, whose sums mean nothing. For such a file log probabilities take their place: those of
a Zipf law over the ranks, or better ``fitted_scores``, which are estimated by Viterbi training on all words of a corpus.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from copy import copy
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans

MARK = "▁"
#: What an uncovered character costs below the least score of the vocabulary, as in the format's own encoder (fixed value).
UNKNOWN_PENALTY = 10.0
#: Words that a task remembers at most; then it starts anew.
REMEMBERED = 150_000
#: Distinct words that a task counts at most before it cuts them.
COUNTED = 150_000
#: Bytes of words that a task holds for either, however few the words; a single block of text may go beyond.
HELD = 1 << 24
#: Words that are cut side by side, and the bytes that such a word has at most.
TOGETHER, SHORT = 20_000, 64
#: Rounds of Viterbi training, and what a piece's count has on top.
ROUNDS, SMOOTH = 1, 0.5
_NORMAL, _USER, _BYTE = 1, 4, 6
_BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at : at + size]
        at += size


def read_pieces(path: str) -> list[tuple[str, float, int]]:
    """Text, score and kind of each piece of a model file."""
    with open(path, "rb") as f:
        data = f.read()
    out = []
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            out.append((piece[1].decode(), float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]), piece.get(3, _NORMAL)))
    return out


def is_bpe(path: str) -> bool:
    """Whether the file's trainer says that its scores are merge ranks."""
    with open(path, "rb") as f:
        data = f.read()
    return any(dict(_fields(value)).get(3) == _BPE for number, value in _fields(data) if number == 2)


class DoubleArray:
    """A trie over bytes: the child of node s by byte b is base[s] + b + 1 if check there is s; value holds a piece's id at its last node."""

    def __init__(self, keys: dict[bytes, int]):
        tree: dict = {}
        for key, value in keys.items():
            node = tree
            for b in key:
                node = node.setdefault(b, {})
            node[-1] = value
        size = 1 << 12
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        self.check[0] = 0
        tried: dict[int, int] = {}  # where the search for so many children goes on
        queue = [(0, tree)]
        for place, node in queue:
            self.value[place] = node.pop(-1, -1)
            if not node:
                continue
            bytes_ = sorted(node)
            many = min(len(bytes_), 16)
            base = tried.get(many, 0)
            while True:
                self._grow(base + 512)
                if all(self.check[base + b + 1] < 0 for b in bytes_):
                    break
                base += 1
            tried[many] = base
            self.base[place] = base
            for b in bytes_:
                self.check[base + b + 1] = place
            queue += [(base + b + 1, node[b]) for b in bytes_]
        self.base, self.check, self.value = (np.array(x, np.int32) for x in (self.base, self.check, self.value))

    def _grow(self, size: int) -> None:
        if len(self.base) <= size:
            more = max(size + 1 - len(self.base), len(self.base))
            self.base += [0] * more
            self.check += [-1] * more
            self.value += [-1] * more


class Unigram:
    """Cuts words (with their markers) into the ids of their best pieces, and remembers them."""

    def __init__(self, path: str):
        pieces = read_pieces(path)
        self.pieces = [p for p, _, _ in pieces]
        self.byte_ids = {int(p[3:-1], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == _BYTE}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.normal = np.array([i for i, (_, _, kind) in enumerate(pieces) if kind in (_NORMAL, _USER)])
        if any(MARK in self.pieces[i].lstrip(MARK) for i in self.normal):
            raise ValueError("a piece goes on after a marker; words can't be cut apart")
        self.bpe = is_bpe(path)
        scores = np.array([s for _, s, _ in pieces])
        self._score(self.logs(1 / np.maximum(1 - scores, 1)) if self.bpe else scores)
        self.byte_table = np.array([self.byte_ids.get(b, 0) for b in range(256)])
        self.is_byte = np.isin(np.arange(len(pieces)), list(self.bytes_of))
        self.written = [bytes((self.bytes_of[i],)) if i in self.bytes_of else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self._forget()

    def _score(self, scores: np.ndarray) -> None:
        self.scores = scores.tolist()
        self.unknown = float(scores[self.normal].min()) - UNKNOWN_PENALTY
        self.score_array = np.asarray(scores, float)

    def _forget(self) -> None:
        self.known, self.known_ids, self.known_ends = pa.array([], pa.large_string()), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    @cached_property
    def trie(self) -> DoubleArray:
        """Made where texts are encoded; decoding doesn't need it."""
        return DoubleArray({self.pieces[i].encode(): int(i) for i in self.normal})

    def logs(self, weights: np.ndarray) -> np.ndarray:
        """Log probabilities of the pieces that a text is cut into, in proportion to ``weights``; 0 for other pieces."""
        out = np.zeros(len(self.pieces))
        out[self.normal] = np.log(weights[self.normal]) - np.log(weights[self.normal].sum())
        return out

    def rescored(self, scores: np.ndarray | None) -> Unigram:
        """The same pieces with other scores if any, and nothing remembered."""
        self.trie  # noqa: B018  made once for all
        out = copy(self)
        out._forget()
        if scores is not None:
            out._score(scores)
        return out

    def __getitem__(self, word: str) -> bytes:
        return array("I", self.best(word.encode())).tobytes()

    def best(self, data: bytes) -> list[int]:
        """Ids of the best cut, by Viterbi from left to right; of equal cuts the one found first."""
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        n = len(data)
        best, back, size = [None] * (n + 1), [-1] * (n + 1), len(check)
        start = [0] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            if data[i] & 0xC0 == 0x80:
                continue
            have, node, j = best[i], 0, i
            wide = 1
            while i + wide < n and data[i + wide] & 0xC0 == 0x80:
                wide += 1
            single = False
            while j < n:
                child = base[node] + data[j] + 1
                if child >= size or check[child] != node:
                    break
                node, j = child, j + 1
                piece = value[node]
                if piece >= 0:
                    single = single or j == i + wide
                    score = have + scores[piece]
                    if best[j] is None or score > best[j]:
                        best[j], back[j], start[j] = score, piece, i
            if not single and (best[i + wide] is None or have + self.unknown > best[i + wide]):
                best[i + wide], back[i + wide], start[i + wide] = have + self.unknown, -1, i
        out = []
        while n:
            i = start[n]
            out += [back[n]] if back[n] >= 0 else [self.byte_ids[b] for b in reversed(data[i:n])]
            n = i
        return out[::-1]

    def cuts(self, words: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best cuts of all words, one after the other, and how many each word has; the same as ``best`` gives word by word.

        Words of at most ``SHORT`` bytes advance side by side. They are the columns of a table, the longest first, with a row for each
        distance from a word's start, so those that reach a distance are the first ones of its row. Row by row the trie is walked from
        there in all of them at once, and the ends of the pieces found are settled.
        """
        data, offsets = spans.text_bytes(words if isinstance(words, pa.Array) else pa.array(words, pa.large_string()))
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        long, cut = np.split(order, [int((sizes > SHORT).sum())])
        alone = [np.array(self.best(data[offsets[w] : offsets[w + 1]].tobytes()), np.uint32) for w in long]
        starts, sizes = offsets[cut], sizes[cut]
        n, height = len(cut), int(sizes.max(initial=0))
        reach = np.searchsorted(-sizes, -np.arange(height + 1), "left")  # how many words are longer than a distance
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.score_array
        byte = np.zeros((height + 2, n), np.int16)  # a byte and 1; 0 past the end, which no node has a child for
        for d in range(height):
            byte[d, : reach[d]] = data[starts[: reach[d]] + d]
            byte[d, : reach[d]] += 1
        goes_on = (byte - 1) & 0xC0 == 0x80
        wide = np.ones((height + 2, n), np.uint8)  # bytes to the next character, or to the end of the word
        for d in range(height - 1, -1, -1):
            np.add(wide[d], wide[d + 1], out=wide[d], where=goes_on[d + 1])
        best = np.full((height + 1, n), -np.inf)
        best[0] = 0.0
        back, begin = np.full((height + 1, n), -1, np.int32), np.zeros((height + 1, n), np.uint8)
        for d in range(height):
            at = np.flatnonzero(~goes_on[d, : reach[d]])
            have, width, covered = best[d], wide[d], np.zeros(n, bool)
            chars, node, to = at, np.zeros(len(at), np.int32), d
            while len(at):
                child = base[node] + byte[to, at]
                hit = np.flatnonzero(check[child] == node)
                at, node, to = at[hit], child[hit], to + 1
                piece = value[node]
                whole = np.flatnonzero(piece >= 0)
                if len(whole):
                    ends, piece = at[whole], piece[whole]
                    covered[ends[width[ends] == to - d]] = True
                    score = have[ends] + scores[piece]
                    better = np.flatnonzero(score > best[to, ends])
                    ends = ends[better]
                    best[to, ends], back[to, ends], begin[to, ends] = score[better], piece[better], d
            bare = chars[~covered[chars]]  # characters that no piece covers
            if len(bare):
                to, score = d + width[bare], have[bare] + self.unknown
                better = np.flatnonzero(score > best[to, bare])
                to, bare = to[better], bare[better]
                best[to, bare], back[to, bare], begin[to, bare] = score[better], -1, d
        taken, here, at = [], sizes, np.arange(n)
        many = np.zeros(len(offsets) - 1, np.int64)
        while len(at := at[here > 0]):
            here = here[here > 0]
            piece, start = back[here, at], begin[here, at].astype(np.int64)
            taken.append((at, piece, start, here))
            many[cut[at]] += np.where(piece >= 0, 1, here - start)
            here = start
        many[long] = [len(x) for x in alone]
        ends = np.cumsum(many)
        ids = np.empty(many.sum(), np.uint32)
        for w, x in zip(long, alone):
            ids[ends[w] - len(x) : ends[w]] = x
        free = ends[cut]
        for at, piece, start, end in taken:  # from the last piece of each word to its first
            one = piece >= 0
            free[at] -= np.where(one, 1, end - start)
            ids[free[at[one]]] = piece[one]
            for w, i, j in zip(at[~one], start[~one], end[~one]):
                ids[free[w] : free[w] + j - i] = self.byte_table[data[starts[w] + i : starts[w] + j]]
        return ids, many

    def cut(self, words: list[str] | pa.Array) -> Iterator[tuple[list[str] | pa.Array, np.ndarray, np.ndarray]]:
        """``cuts`` of all words, some at a time."""
        for i in range(0, len(words), TOGETHER):
            yield words[i : i + TOGETHER], *self.cuts(words[i : i + TOGETHER])

    def learned(self, words: pa.Array) -> np.ndarray:
        """Where each of the distinct words stands among the remembered ones; their best cuts are remembered from now on."""
        found = pc.index_in(words, self.known)
        if len(self.known) + found.null_count > REMEMBERED or self.known.nbytes > HELD:
            self._forget()
            found = pc.index_in(words, self.known)
        if found.null_count:
            new = words.filter(found.is_null())
            cuts = [(ids, many) for _, ids, many in self.cut(new)]
            ends = self.known_ends[-1] + np.cumsum(np.concatenate([many for _, many in cuts]))
            self.known, self.known_ids = pa.concat_arrays([self.known, new]), np.concatenate([self.known_ids, *(ids for ids, _ in cuts)])
            self.known_ends = np.append(self.known_ends, ends)
        at = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[at < 0] = np.arange(len(self.known) - found.null_count, len(self.known))
        return at

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offsets of each text's in them."""
        words, texts_at = words_of(texts)
        words = words.dictionary_encode()
        at = self.learned(words.dictionary)[words.indices.to_numpy()]
        first = self.known_ends[at]
        offsets = np.zeros(len(at) + 1, np.int64)
        np.cumsum(self.known_ends[at + 1] - first, out=offsets[1:])
        return self.known_ids[np.repeat(first - offsets[:-1], np.diff(offsets)) + np.arange(offsets[-1])], offsets[texts_at]

    @cached_property
    def writing(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all pieces as they are written, one after the other, and the offsets of each."""
        return np.frombuffer(b"".join(self.written), np.uint8), np.cumsum([0, *map(len, self.written)])

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """``decode`` of many texts' ids, which stand one after the other."""
        data, ends = self.writing
        data, places = spans.taken(data, ends[ids], ends[ids + 1])
        out = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(places[offsets]), pa.py_buffer(data))
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:  # byte pieces that are no characters
            return pa.array([self.decode(ids[i:j].tolist()) for i, j in zip(offsets, offsets[1:])], pa.large_string())
        return pc.if_else(pc.starts_with(out, " "), pc.utf8_slice_codeunits(out, 1), out)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: byte pieces as the bytes they are, markers as spaces, without the one in front."""
        text = b"".join(map(self.written.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, with their markers, and the offsets of each text's. A word is markers with what follows up to the next, or the markers that end a text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    mark, none = (pa.scalar(x, pa.large_string()) for x in (MARK, ""))
    front = pc.if_else(pc.equal(texts, none), none, mark)
    data, offsets = spans.text_bytes(pc.binary_join_element_wise(front, pc.replace_substring(texts, " ", MARK), none))
    width = len(MARK.encode())
    marks = np.flatnonzero(data[: 1 - width] == MARK.encode()[0]) if len(data) else np.zeros(0, np.int64)
    for k, b in enumerate(MARK.encode()):
        marks = marks[data[marks + k] == b]
    after = np.zeros(len(marks), bool)  # whether it follows another marker
    after[1:] = np.diff(marks) == width
    opens = offsets[:-1][np.diff(offsets) > 0]
    after[np.searchsorted(marks, opens)] = False
    starts = np.append(marks[~after], len(data))
    words = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data))
    return words, np.searchsorted(starts, offsets)


@cache
def codec(path: str) -> Unigram:
    """One for each worker process."""
    return Unigram(path)


class PieceCounter:
    """How often each piece is in the best cuts of all words of the texts added. Words wait with their counts, then equal ones are cut once."""

    def __init__(self, own: Unigram):
        self.own, self.words, self.times = own, [], []
        self.counts = np.zeros(len(own.pieces), np.int64)

    def add(self, texts: pa.Array) -> None:
        found = words_of(texts)[0].dictionary_encode()
        self.words.append(found.dictionary)
        self.times.append(np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary)))
        if sum(map(len, self.words)) > 2 * COUNTED or sum(w.nbytes for w in self.words) > HELD:
            self.add_up(COUNTED, HELD // 2)

    def add_up(self, most: int = 0, most_bytes: int = 0) -> None:
        """Makes one of equal words; if more words or bytes are left than may wait, all are cut and counted."""
        if not self.words:
            return
        found = pa.concat_arrays(self.words).dictionary_encode()
        words, times = found.dictionary, np.zeros(len(found.dictionary), np.int64)
        np.add.at(times, found.indices.to_numpy(), np.concatenate(self.times))
        self.words, self.times = [words], [times]
        if len(words) > most or words.nbytes > most_bytes:
            self.words, self.times = [], []
            for _, ids, many in self.own.cut(words):
                np.add.at(self.counts, ids, np.repeat(times[: len(many)], many))
                times = times[len(many) :]


def piece_counts(docs: DataFrame, path: str, scores: np.ndarray, *, text: str = "text") -> np.ndarray:
    """How often each piece is in the best cuts of all words of ``docs``. Each task cuts its distinct words; only counts of pieces leave it."""
    held = docs.sparkSession.sparkContext.broadcast(scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(codec(path).rescored(held.value))
        for batch in batches:
            _, offsets = spans.text_bytes(batch.column(0))
            for i, j in spans.blocks(offsets):
                counter.add(batch.column(0).slice(i, j - i))
        counter.add_up()
        pieces = np.flatnonzero(counter.counts)
        yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.int32()), pa.array(counter.counts[pieces], pa.int64())], names=["piece", "n"])

    found = docs.select(text).mapInArrow(run, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(scores), np.int64)
    counts[found.column("piece").to_numpy()] = found.column("n").to_numpy()
    return counts


def fitted_scores(docs: DataFrame, path: str, *, text: str = "text", rounds: int = ROUNDS) -> np.ndarray | None:
    """Log probabilities of a BPE file's pieces, by ``rounds`` of Viterbi training on all words of ``docs``; None for a file that has its own."""
    own = codec(path)
    if not own.bpe:
        return None
    scores = np.array(own.scores)
    for _ in range(rounds):
        scores = own.logs(piece_counts(docs, path, scores, text=text) + SMOOTH)
    return scores


def encode_documents(docs: DataFrame, path: str, *, id: str = "doc_id", text: str = "text", scores: np.ndarray | None = None) -> DataFrame:
    """``id``, ``ids`` (binary, little-endian unsigned 32-bit), ``n_tokens`` and ``n_bytes_fallen`` (byte pieces) of each row.

    A null or empty text has no ids; rows with equal ids stay apart; other columns are not carried. Spaces are kept as they are, and a
    marker in the text becomes a space. ``scores`` take the place of the file's.
    """
    held = None if scores is None else docs.sparkSession.sparkContext.broadcast(scores.tobytes())
    schema = docs.select(id).schema.add("ids", "binary").add("n_tokens", "long").add("n_bytes_fallen", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path).rescored(None if held is None else np.frombuffer(held.value))  # it remembers as long as the task
        for batch in batches:
            _, offsets = spans.text_bytes(batch.column(1))
            for i, j in spans.blocks(offsets):
                ids, places = own.encode_all(batch.column(1).slice(i, j - i))
                fallen = np.bincount(np.searchsorted(places, np.flatnonzero(own.is_byte[ids]), "right") - 1, minlength=j - i)
                held_ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(4 * places), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), held_ids, pa.array(np.diff(places)), pa.array(fallen, pa.int64())], names=schema.names)

    return docs.select(id, text).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, *, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in place of them; null ids give the empty text."""
    keep = [c for c in encoded.columns if c not in (ids, out)]
    schema = encoded.select(*keep).schema.add(out, "string")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            column = pc.fill_null(batch.column(len(names) - 1), b"")
            offsets = np.append(0, np.cumsum(pc.binary_length(column).to_numpy(), dtype=np.int64)) // 4
            for i, j in spans.blocks(offsets):
                found = np.frombuffer(b"".join(column.slice(i, j - i).to_pylist()), "<u4")
                texts = own.decode_all(found, offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns[:-1]), texts.cast(pa.string())], names=names)

    return encoded.select(*keep, ids).mapInArrow(run, schema)
