"""Benchmark decontamination: a positional inverted index of the corpus, and phrases found in it from their rarest term on.

The index is a table of segments. A segment has the postings of about a megabyte of documents: the hashes of its terms in
order, how often each occurs, and their places in the segment's stream of words, as gaps. A phrase is looked for only in the
segments that have its rarest term. There its lists, each moved back by the term's offset in the phrase, are intersected in the
order of how rare the terms are in the whole corpus, all phrases of a segment at once. Postings never leave their segment, so a
frequent word isn't one task's, and a long list isn't joined with another one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .staging import staged

#: Words of a window; a shorter text is one window.
WINDOW = 10
#: Words that each term of a near match may be away from its place.
SLOP = 2
#: Phrases that meet a segment at once, about; more go in further passes over the index.
PHRASES = 1 << 14
#: Slots of the set of sought terms that tasks get, whatever the number of terms; more terms than slots only let more through.
SLOTS = 1 << 20


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of letters and digits, A-Z in lower case, and each one's text."""
    data = spans.lowered(data)
    starts, ends, owner = spans.words(data, offsets, spans.NOT_LETTERS_OR_DIGITS)
    return spans.hash_spans(data, starts, ends), owner


def build_index(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: a row for each segment (segment, ids, n_words, terms, counts, gaps). Every row of ``docs`` is a document; null has no words."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = spans.text_bytes(batch.column(1))
            for i, j in spans.blocks(offsets):
                term, owner = _terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                order = np.argsort(term, kind="stable")
                term = term[order]
                first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
                gaps = np.diff(order, prepend=0)
                gaps[first] = order[first]
                whole = pa.array([0, j - i], pa.int32())
                listed = [pa.ListArray.from_arrays(whole, x) for x in (batch.column(0).slice(i, j - i), pa.array(np.bincount(owner, minlength=j - i)))]
                packed = [pa.array([x.tobytes()], pa.binary()) for x in (term[first], np.diff(np.r_[first, len(term)]).astype(np.uint32), gaps.astype(np.uint32))]
                yield pa.RecordBatch.from_arrays([pa.array([segment]), *listed, *packed], names=["segment", "ids", "n_words", "terms", "counts", "gaps"])
                segment += 1

    return staged(rows.mapInArrow(run, f"segment long, ids array<{kind}>, n_words array<long>, terms binary, counts binary, gaps binary"), "index")


def phrases_of(items: DataFrame, *, id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows (phrase, item, terms): each ``window`` consecutive words of an item; an item of fewer words, but not none, is one."""
    rows = items.select(F.col(id).alias("item"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = spans.text_bytes(batch.column(1))
            for i, j in spans.blocks(offsets):
                term, owner = _terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                cuts = np.searchsorted(owner, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(cuts), pa.array(term.view(np.int64)))], names=["item", "terms"])

    words = rows.mapInArrow(run, f"item {kind}, terms array<long>").where(F.size("terms") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("terms") - (window - 1), F.lit(1)))
    cut = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("terms", i, F.lit(window)))).alias("terms"))
    return staged(cut.withColumn("phrase", F.monotonically_increasing_id()), "phrases")


def _dictionary(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows (term, segment, n) of the index for ``terms`` and few others."""
    slots = np.zeros(SLOTS, bool)
    slots[[r[0] for r in terms.select((F.col("term").bitwiseAND(SLOTS - 1)).alias("slot")).distinct().collect()]] = True  # SLOTS at most
    sought = np.packbits(slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.unpackbits(sought).astype(bool)
        for batch in batches:
            for segment, terms, counts in zip(*(c.to_pylist() for c in batch.columns)):
                term = np.frombuffer(terms, np.int64)
                hit = there[term & (SLOTS - 1)]
                n = np.frombuffer(counts, np.uint32)[hit].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(term[hit]), pa.array(np.full(len(n), segment)), pa.array(n)], names=["term", "segment", "n"])

    return staged(index.select("segment", "terms", "counts").mapInArrow(run, "term long, segment long, n long"), "dictionary")


def intersect(terms: np.ndarray, counts: np.ndarray, gaps: np.ndarray, n_words: np.ndarray, sought: list[np.ndarray], offsets: list[np.ndarray], slop: int) -> tuple[np.ndarray, ...]:
    """Phrase, document, start and exactness of each match in a segment. ``sought`` and ``offsets`` have a phrase's terms, the rarest first, and their places in it."""
    size = np.array([len(x) for x in sought])
    flat, off = np.concatenate(sought), np.concatenate(offsets).astype(np.int64)
    first = np.cumsum(size) - size
    rank = np.searchsorted(terms, flat)
    known = terms[np.minimum(rank, len(terms) - 1)] == flat
    whole = np.flatnonzero(np.logical_and.reduceat(known, first))
    begin = np.cumsum(counts) - counts
    place = np.cumsum(gaps)
    before = np.r_[0, place][begin]
    place -= np.repeat(before, counts)
    key = (np.repeat(np.arange(len(terms)), counts) << 32) | place
    n = counts[rank[first[whole]]]
    phrase = np.repeat(whole, n)
    at = place[np.repeat(begin[rank[first[whole]]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    start = at - off[first[phrase]]
    base = np.cumsum(n_words) - n_words
    doc = np.searchsorted(base, at, "right") - 1
    # Of documents without words, which share a base, the search finds the last: the one that has words.
    low, high = base[doc], base[doc] + n_words[doc] - 1
    exact = (start >= low) & (start + size[phrase] - 1 <= high)
    if not slop:
        phrase, doc, start, low, high, exact = (x[exact] for x in (phrase, doc, start, low, high, exact))
    for k in range(1, int(size.max(initial=1))):
        more = k < size[phrase]
        entry = np.where(more, first[phrase] + k, 0)
        top, want = rank[entry] << 32, start + off[entry]
        near = np.searchsorted(key, top + np.maximum(want - slop, low))
        met = key[np.minimum(near, len(key) - 1)]
        ok = ~more | ((near < len(key)) & (met >> 32 == rank[entry]) & (met <= top + np.minimum(want + slop, high)))
        if slop:
            spot = np.searchsorted(key, top + want)
            exact &= ~more | (key[np.minimum(spot, len(key) - 1)] == top + want)
        phrase, doc, start, low, high, exact = (x[ok] for x in (phrase, doc, start, low, high, exact))
    return phrase, doc, start - low, exact


def search(index: DataFrame, phrases: DataFrame, *, slop: int = 0) -> DataFrame:
    """Rows (segment, row, item, phrase, start, length, exact): where ``phrases`` occur, in the ``row``-th document of a segment from word ``start`` on.

    With ``slop``, also near matches (``exact`` false): around an occurrence of the rarest term, every other term stands within
    ``slop`` words of its place in the phrase, in the same document.
    """
    words = phrases.select("phrase", F.posexplode("terms").alias("offset", "term"))
    rows = _dictionary(index, words)
    often = rows.groupBy("term").agg(F.sum("n").alias("n"))
    plan = words.join(often, "term", "left").groupBy("phrase").agg(F.count_if(F.col("n").isNull()).alias("unknown"), F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("plan"))
    sought = phrases.select("phrase", "item").join(plan.where("unknown = 0"), "phrase")
    passes = max(1, -(-phrases.count() // PHRASES))
    met = sought.withColumn("term", F.col("plan")[0]["term"]).join(rows.select("term", "segment"), "term")
    met = met.select("segment", F.pmod(F.xxhash64("phrase"), F.lit(passes)).alias("chunk"), "phrase", "item", F.col("plan.term").alias("terms"), F.col("plan.offset").alias("offsets"))
    parts = index.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(passes - 1).cast("long")))).select("segment", "chunk", "n_words", "terms", "counts", "gaps")
    kind = phrases.schema["item"].dataType.simpleString()

    def run(segment: pa.Table, wanted: pa.Table) -> pa.Table:
        wanted = wanted.combine_chunks()
        if not len(segment) or not len(wanted):
            none = np.zeros(0, np.int64)
            phrase, doc, start, exact, number = none, none, none, none.astype(bool), 0
        else:
            number = segment["segment"][0].as_py()
            packed = [np.frombuffer(segment[c][0].as_buffer(), kind) for c, kind in (("terms", np.int64), ("counts", np.uint32), ("gaps", np.uint32))]
            n_words = segment["n_words"][0].values.to_numpy(zero_copy_only=False)
            sought, offsets = (wanted[c].combine_chunks() for c in ("terms", "offsets"))
            cuts = sought.offsets.to_numpy()[1:-1] - sought.offsets[0].as_py()
            lists = [np.split(x.flatten().to_numpy(zero_copy_only=False), cuts) for x in (sought, offsets)]
            # Terms are stored in the order of unsigned hashes.
            phrase, doc, start, exact = intersect(packed[0].view(np.uint64), packed[1].astype(np.int64), packed[2].astype(np.int64), n_words, [x.view(np.uint64) for x in lists[0]], lists[1], slop)
        taken = pa.array(phrase)
        length = np.array(sought.value_lengths().to_numpy(zero_copy_only=False) if len(wanted) and len(segment) else [0])
        columns = [pa.array(np.full(len(phrase), number)), pa.array(doc), wanted["item"].take(taken), wanted["phrase"].take(taken), pa.array(start), pa.array(length[phrase].astype(np.int64)), pa.array(exact)]
        return pa.table(columns, names=["segment", "row", "item", "phrase", "start", "length", "exact"])

    groups = parts.groupBy("segment", "chunk").cogroup(met.groupBy("segment", "chunk"))
    return groups.applyInArrow(run, f"segment long, row long, item {kind}, phrase long, start long, length long, exact boolean")


def contamination(docs: DataFrame, items: DataFrame, *, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """A row for each row of ``docs``: ``id``, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items.

    n_hit counts the words inside any occurrence of a window of an item; n_items the items with such windows, items_sha256 their ids as
    text in order, joined by commas; n_near_items those with a window whose words stand within ``slop`` of their places, exact ones included. A
    null text has no words; so has an item of null text, which then has no windows. Rows that repeat are each found; items that share an
    id count once, a null item id as none. Empty tables give no rows, or rows without hits.
    """
    index, phrases = build_index(docs, id=id, text=text), phrases_of(items, id=item_id, text=item_text, window=window)
    found = search(index, phrases, slop=slop)
    names, near = F.collect_set(F.when(F.col("exact"), F.col("item").cast("string"))), F.count_distinct("item")
    spans_of = F.collect_set(F.when(F.col("exact"), F.struct("start", (F.col("start") + F.col("length")).alias("end"))))
    hits = found.groupBy("segment", "row").agg(F.sort_array(names).alias("items"), F.sort_array(spans_of).alias("spans"), near.alias("near"))
    ahead = lambda state, x: F.struct(F.greatest(state["end"], x["end"]).alias("end"), (state["n"] + F.greatest(x["end"] - F.greatest(state["end"], x["start"]), F.lit(0))).alias("n"))
    covered = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")), ahead)["n"]
    hits = hits.select("segment", "row", "items", covered.alias("hit"), "near")
    rows = index.select("segment", F.posexplode(F.arrays_zip("ids", "n_words")).alias("row", "doc")).select("segment", F.col("row").cast("long").alias("row"), F.col("doc.ids").alias("_id"), F.col("doc.n_words").alias("words"))
    out = rows.join(hits, ["segment", "row"], "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        F.col("_id").alias(id), F.col("words").alias("n_words"), F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated"), F.coalesce("near", F.lit(0)).alias("n_near_items"),
    )
