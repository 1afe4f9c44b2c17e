"""Source divergence audit: how far the words of each source stand from those of the other sources of its language.

Terms are counted in numpy per some megabytes of text and summed by Spark. The counts of a language are a matrix of kept
terms by sources. In blocks of its rows, every (source, count) that occurs is a column of zeros and ones; the product of the
block's transpose with itself holds, for each two sources, the joint table of their counts: how many terms have one count here
and the other there. Shares are priced once for each cell of these tables instead of once for each term. A cell is a sum of at
most ROWS ones, exact in single precision; prices are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import spans
from .staging import staged

#: Documents of its language that a term must be in to be kept.
MIN_DOCS = 3
#: Ranks of the terms part.
TOP = 200
#: Units that a share of one is split into, whole: shares are 1 and more of these.
UNITS = 1_000_000_000
#: Rows of the count matrix in a task's group, about, and in a block; columns of a block, besides two for each source.
SLICE_ROWS = 8192
ROWS = 2048
WIDTH = 512
#: Bytes of text that are counted together.
COUNTED_BYTES = 4 << 20


def term_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Rows (lang, source, term, n, n_docs): occurrences of a term and documents that have it. Null text, lang and source are ''.

    Terms are runs of letters a-z and characters outside ASCII, A-Z in lower case. Each row of ``docs`` is a document.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, names = [], []
            for k in (0, 1):
                coded = batch.column(k).dictionary_encode()
                places.append(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
                names.append(coded.dictionary)
            group = places[0] * len(names[1]) + places[1]
            data, offsets = spans.text_bytes(batch.column(2))
            for i, j in spans.blocks(offsets, COUNTED_BYTES):
                part = spans.lowered(data[offsets[i] : offsets[j]])
                starts, ends, owner = spans.words(part, offsets[i : j + 1] - offsets[i], spans.NOT_LETTERS)
                if not len(starts):
                    continue
                own = group[i:j][owner]
                key = spans.join_hashes(spans.mix(own.astype(np.uint64)), spans.hash_spans(part, starts, ends))
                order = np.argsort(key, kind="stable")
                key, owner = key[order], owner[order]
                first = np.r_[True, key[1:] != key[:-1]]
                at = np.flatnonzero(first)
                in_doc = np.cumsum(first | np.r_[True, owner[1:] != owner[:-1]])
                last = np.r_[at[1:], len(key)] - 1
                word = order[at]
                columns = [names[0].take(pa.array(own[word] // len(names[1]))), names[1].take(pa.array(own[word] % len(names[1]))), spans.strings(part, starts[word], ends[word])]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(last + 1 - at), pa.array(in_doc[last] - in_doc[at] + 1)], names=["lang", "source", "term", "n", "n_docs"])

    counted = rows.mapInArrow(run, "lang string, source string, term string, n long, n_docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def kept_terms(counts: DataFrame, *, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows (lang, term, total, counts): terms in at least ``min_docs`` documents of their language, and their (source, n) in each source that has them."""
    terms = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts"))  # a member for each source
    return terms.where(F.col("n_docs") >= min_docs).drop("n_docs")


def share(n: Column, of: Column, kinds: Column) -> Column:
    """1 + floor(UNITS * (n + 1) / (of + kinds)): the share of a term counted ``n`` times, in whole units."""
    return 1 + F.call_function("div", F.lit(UNITS).cast("decimal(10,0)") * (n + 1), of + kinds)


def price(p: Column, q: Column) -> Column:
    """floor((p - q) * (p - q) / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def shares(levels: np.ndarray, of: np.ndarray) -> np.ndarray:
    """``share`` in numpy, by long division, so that no product leaves 64 bits."""
    out, rest = np.zeros(len(levels), np.int64), levels + 1
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // of
        rest %= of
    return out + 1


def joint_blocks(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of rows of a matrix of terms by sources: source and count of each column of zeros and ones, and their product with themselves."""
    counts = counts[np.argsort(counts.sum(axis=1), kind="stable")]  # rare terms have few counts, so blocks are narrow
    n = counts.shape[1]
    i = 0
    while i < len(counts):
        j = min(i + ROWS, len(counts))
        while True:
            levels = [np.unique(counts[i:j, s], return_inverse=True) for s in range(n)]
            width = sum(len(x) for x, _ in levels)
            if width <= WIDTH + 2 * n or j == i + 1:
                break
            j = i + (j - i + 1) // 2
        first = np.cumsum([0, *(len(x) for x, _ in levels[:-1])])
        ones = np.zeros((j - i, width), np.float32)
        for k, (_, at) in zip(first, levels):
            ones[np.arange(j - i), k + at] = 1
        yield np.repeat(np.arange(n), [len(x) for x, _ in levels]), np.concatenate([x for x, _ in levels]), ones.T @ ones
        i = j


def _matrix(terms: pa.Table, sources: pa.Array) -> np.ndarray:
    lists = terms["counts"].combine_chunks()
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    out = np.zeros((len(lists), len(sources)), np.int64)
    out[row, pc.index_in(flat.field("source"), sources).to_numpy(zero_copy_only=False)] = flat.field("n").to_numpy(zero_copy_only=False)
    return out


def _sliced(terms: DataFrame, groups: DataFrame):
    """Groups of about SLICE_ROWS terms of a language, each with all its sources."""
    slices = groups.select("lang", F.greatest(F.col("kinds") / SLICE_ROWS, F.lit(1)).cast("int").alias("slices")).distinct()
    dealt = terms.join(slices, "lang").withColumn("slice", F.pmod(F.xxhash64("term"), F.col("slices")).cast("int"))
    each = groups.join(slices, "lang").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    each = each.select(*(F.col(c).alias(c) for c in ("lang", "slice", "source", "n", "kinds")))  # columns of their own, where both sides come from one table
    return dealt.select("lang", "slice", "counts").groupBy("lang", "slice").cogroup(each.groupBy("lang", "slice"))


def joint_tables(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (lang, source, other, n, other_n, n_terms): kept terms that occur ``n`` times in a source and ``other_n`` times in another, zero included."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        sources, out = right["source"].combine_chunks().cast(pa.string()), []
        for source, level, cells in joint_blocks(_matrix(left, sources)) if len(left) else ():
            i, j = np.nonzero(cells)
            i, j = i[source[i] != source[j]], j[source[i] != source[j]]
            out.append(pa.table({"lang": pa.array([right["lang"][0].as_py()] * len(i), pa.string()), "source": sources.take(pa.array(source[i])), "other": sources.take(pa.array(source[j])), "n": level[i], "other_n": level[j], "n_terms": cells[i, j].astype(np.int64)}))
        return pa.concat_tables(out) if out else schema.empty_table()

    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()), ("n", pa.int64()), ("other_n", pa.int64()), ("n_terms", pa.int64())])
    found = _sliced(terms, groups).applyInArrow(run, "lang string, source string, other string, n long, other_n long, n_terms long")
    return found.groupBy("lang", "source", "other", "n", "other_n").agg(F.sum("n_terms").alias("n_terms"))


def pair_values(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (lang, source, other, value): prices of all kept terms summed, of each source against each other one of its language that has kept terms."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        sources = right["source"].combine_chunks().cast(pa.string())
        of = right["n"].to_numpy() + right["kinds"].to_numpy()
        n = len(sources)
        values = np.zeros(n * n, np.int64)
        for source, level, cells in joint_blocks(_matrix(left, sources)) if len(left) else ():
            p = shares(level, of[source])
            i, j = np.nonzero(cells)
            apart = source[i] != source[j]
            i, j = i[apart], j[apart]
            np.add.at(values, source[i] * n + source[j], cells[i, j].astype(np.int64) * ((p[i] - p[j]) ** 2 // p[j]))
        i, j = np.divmod(np.arange(n * n), n)
        i, j = i[i != j], j[i != j]
        return pa.table({"lang": pa.array([right["lang"][0].as_py()] * len(i), pa.string()), "source": sources.take(pa.array(i)), "other": sources.take(pa.array(j)), "value": values[i * n + j]})

    found = _sliced(terms, groups).applyInArrow(run, "lang string, source string, other string, value long")
    return found.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for each (lang, source) that occurs, also if it has no terms.

    Part ``pair``: each other source of the language, by the sum of prices of all its kept terms. Part ``term``: kept terms whose share
    is greater here than in the language, by price, the first ``top``. Ranks start at 1, greatest values first, then the least item in bytes.
    Other columns of ``docs`` don't matter; rows that repeat count each; an empty table gives no rows.
    """
    counts = staged(term_counts(docs, text=text, lang=lang, source=source), "counts")
    terms = staged(kept_terms(counts, min_docs=min_docs), "terms")
    entries = terms.select("lang", "term", "total", F.inline("counts"))
    there = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source")))).distinct()
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("total").alias("of"))
    groups = there.join(entries.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = staged(groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "kinds", "of"))), "groups")
    other = there.select("lang", F.col("source").alias("item"))
    pairs = there.join(other, "lang").where(F.col("source") != F.col("item"))  # the rows of the result
    values = pair_values(terms, groups).withColumnRenamed("other", "item")
    pairs = pairs.join(values, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    p, q = share(F.col("n"), F.col("own"), F.col("kinds")), share(F.col("total"), F.col("of"), F.col("kinds"))
    found = entries.join(groups.select("lang", "source", F.col("n").alias("own"), "kinds", "of"), ["lang", "source"])
    found = found.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q").withColumn("value", price(F.col("p"), F.col("q")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ("lang", "source", "part", "item", "value", "rank")
    pairs = pairs.withColumn("part", F.lit("pair")).withColumn("rank", rank).select(*columns)
    return pairs.unionByName(found.withColumn("part", F.lit("term")).withColumn("rank", rank).where(F.col("rank") <= top).select(*columns))
