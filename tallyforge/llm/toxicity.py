"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with marks at both ends) and of itself, hashed into buckets; its vector
is the mean of their embeddings, so a misspelling shares most of its vector with the word. A window of a few words is the mean of
its words and goes through a linear softmax over (clean, toxic). A text is clean if all its windows are, so its score is
1 - prod(1 - p(window)): an insult counts the same in a short and in a very long text. Labels are of whole texts;
the gradient of the text's likelihood finds the windows they are about.

With two classes only the difference of the class weights matters, so a bucket acts through one number
(embedding times that difference). Training uses this: the gradient of all embeddings is a bucket's scalar times the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import spans

#: Rows of each label to fit on at most, and the bytes that the text of such a row may have; this bounds what the driver gets.
TRAIN_ROWS = 2500
TRAIN_BYTES = 16_384
BUCKETS = 1 << 17
DIM = 8
N_GRAMS = (3, 4, 5)
#: Words that are averaged: an insult is one or two words, and what stands around it is chance. Held out, at 0.7, windows of 8, 4, 2 words
#: catch 4, 9, 9 of 18 toxic texts of sf0.01 and 101, 102, 111 of 144 of sf0.1, and flag 20, 6, 3 of 1,200 clean ones there.
WINDOW = 2
#: Gradient steps that a fit takes about, whatever the rows: fewer rows are gone through more often.
STEPS = 400
BATCH = 64
#: Squared gradient that an embedding starts with: n-grams seen a few times move little, so chance company of an insult isn't learned.
FLOOR = 0.01
#: Score from which on a text is toxic.
THRESHOLD = 0.7
#: Words that a task remembers at most; then it starts anew.
REMEMBERED = 100_000

_STRIP = ".,;:!?\"'()[]{}*#$%&|<>-_"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def bags(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, one after the other, and where each word's begin (one more at the end)."""
    marked = ["<" + (w.strip(_STRIP) or w) + ">" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    at, owner = [starts], [np.arange(len(marked))]
    found = [spans.hash_spans(codes, starts, ends)]
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    left = np.repeat(lengths, lengths) - place
    word = np.repeat(np.arange(len(marked)), lengths)
    for n in N_GRAMS:
        begin = np.flatnonzero(left >= n)
        found.append(spans.hash_spans(codes, begin, begin + n))
        at.append(begin)
        owner.append(word[begin])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(buckets)).astype(np.int64), np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(marked)))])


@dataclass
class Model:
    """What a bucket adds to the logit of a word, and the bias of a window."""

    weights: np.ndarray
    bias: float
    window: int = WINDOW

    def words(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        grams, starts = bags(words, len(self.weights))
        return np.add.reduceat(self.weights[grams], starts[:-1]) / np.diff(starts)


def window_starts(sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows begin if texts of so many words follow each other, and the text of each."""
    counts = -(-sizes // window)
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = np.cumsum(counts) - counts
    within = np.arange(len(owner)) - first[owner]
    return (np.cumsum(sizes) - sizes)[owner] + within * window, owner


def fit(texts: list[str], labels: np.ndarray, *, buckets: int = BUCKETS, dim: int = DIM, window: int = WINDOW, epochs: int | None = None, rate: float = 0.4, seed: int = 7) -> Model:
    """Embeddings and softmax weights by Adagrad on the likelihood of the labels; the same input gives the same model."""
    rng = np.random.default_rng(seed)
    index: dict[str, int] = {}
    ids = [np.array([index.setdefault(w, len(index)) for w in words_of(t)], np.int64) for t in texts]
    bias = -4.0
    if not index:
        return Model(np.zeros(buckets), bias, window)
    words = list(index)
    found = [bags(words[i : i + 20_000], buckets) for i in range(0, len(words), 20_000)]  # some at a time, as this is the driver
    grams, sizes = np.concatenate([g.astype(np.int32) for g, _ in found]), np.concatenate([np.diff(at) for _, at in found])
    starts = np.append(0, np.cumsum(sizes))
    del found, words
    emb = rng.normal(0, 0.01, (buckets, dim))
    soft = rng.choice([-0.5, 0.5], (dim, 1)) * [1.0, -1.0]
    emb_sq, soft_sq, bias_sq = np.full(buckets, FLOOR), np.full((dim, 2), 1.0), 1.0
    labels = np.asarray(labels, float)
    steps = max(1, len(texts) // BATCH)
    epochs = epochs or -(-STEPS // steps)
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        step = rate * (1 - epoch / epochs)
        for part in np.array_split(order, steps):
            part = part[[len(ids[k]) > 0 for k in part]]
            if not len(part):
                continue
            words, inverse = np.unique(np.concatenate([ids[k] for k in part]), return_inverse=True)
            own = sizes[words]
            ends = np.cumsum(own)
            picked = grams[np.repeat(starts[words] - (ends - own), own) + np.arange(ends[-1])]
            diff = soft[:, 1] - soft[:, 0]
            value = np.add.reduceat((emb @ diff)[picked], ends - own) / own
            begin, owner = window_starts(np.array([len(ids[k]) for k in part]), window)
            count = np.diff(np.append(begin, len(inverse)))
            logit = np.add.reduceat(value[inverse], begin) / count + bias
            p = 1 / (1 + np.exp(-logit))
            none = np.exp(np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), len(part)))
            y = labels[part]
            scale = np.where(y == 1, -none / np.maximum(1 - none, 1e-6), 1.0)
            g_window = p * scale[owner]
            g_word = np.bincount(inverse, np.repeat(g_window / count, count), len(words)) / own
            g_gram = np.bincount(picked, np.repeat(g_word, own), buckets)
            g_diff = emb.T @ g_gram
            g_soft = np.stack([-g_diff, g_diff], 1)
            touched = np.flatnonzero(g_gram)
            emb_sq[touched] += g_gram[touched] ** 2
            emb[touched] -= step * (g_gram[touched] / np.sqrt(emb_sq[touched]))[:, None] * diff
            soft_sq += g_soft**2
            soft -= step * g_soft / np.sqrt(soft_sq)
            g_bias = g_window.sum()
            bias_sq += g_bias**2
            bias -= step * g_bias / np.sqrt(bias_sq)
    return Model(emb @ (soft[:, 1] - soft[:, 0]), float(bias), window)


def training_rows(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> DataFrame:
    """Text and label (0 or 1) of at most ``rows`` rows of each label with the least hashes of their ids, of texts up to ``most_bytes`` bytes.

    Ids whose crc32 (as text) has remainder 1 by 3 are held out. Null ids, labels and texts don't count; of several labels
    the greatest counts.
    """
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & (F.crc32(F.col(id).cast("string")) % 3 != 1)).groupBy(id).agg(F.max(label).alias("_label"))
    short = docs.where(F.octet_length(text) <= most_bytes).select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    ids = short.select("_id").join(known, F.col("_id") == F.col(id)).select("_id", "_label").distinct()
    few = lambda value: ids.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    chosen = few(0).unionByName(few(1))
    return short.join(chosen, "_id").dropDuplicates(["_id", "_text"]).select("_id", "_text", "_label")


def train(docs: DataFrame, labels: DataFrame, **options) -> Model:
    rows = sorted(tuple(r) for r in training_rows(docs, labels, **options).collect())  # bounded by TRAIN_ROWS and TRAIN_BYTES
    return fit([r[1] for r in rows], np.array([r[2] for r in rows]))


class WordLogits(dict):
    """What each word adds to the logit of its window; remembers words."""

    def __init__(self, model: Model):
        self.model = model

    def learn(self, words: list[str]) -> None:
        new = [w for w in set(words) if w not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(set(words))
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            self.update(zip(part, self.model.words(part).tolist()))


def score_texts(own: WordLogits, texts: list[str]) -> np.ndarray:
    parts = [words_of(t) for t in texts]
    words = [w for p in parts for w in p]
    if not words:
        return np.zeros(len(texts))
    own.learn(words)
    value = np.fromiter(map(own.__getitem__, words), float, len(words))
    begin, owner = window_starts(np.fromiter(map(len, parts), np.int64, len(parts)), own.model.window)
    logit = np.add.reduceat(value, begin) / np.diff(np.append(begin, len(value))) + own.model.bias
    return -np.expm1(np.bincount(owner, -np.logaddexp(0, logit), len(texts)))


def with_score(docs: DataFrame, model: Model, *, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that the text is toxic. Null texts and those without words have 0; an own column of that name gives way."""
    docs = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    names = docs.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = WordLogits(shared.value)  # as long as the task, so that the worker's next stage has its memory
        for batch in batches:
            _, offsets = spans.text_bytes(batch.column(place))
            for i, j in spans.blocks(offsets):
                part = batch.slice(i, j - i)
                score = score_texts(own, [x or "" for x in part.column(place).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))

