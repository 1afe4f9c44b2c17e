"""MinHash near-dedup on multisets: BagMinHash signatures, banding, exact check of the overlap, classes.

A text is the multiset of its five-word shingles. Every shingle owns a Poisson process over (time, weight): a point at
weight w counts for texts that hold the shingle w times or more. A register of the signature keeps the earliest point that
falls to it, so two texts agree in a register with the probability of their weighted Jaccard similarity. Weights are whole
numbers in dyadic levels, each with a process of its own, and the points of a level are drawn in order of time
only as long as they come before the latest register of the text; most shingles of a longer text need one or two.

Equal texts are one node. Nodes that share a band meet in a bucket. In each round every bucket names pivots, which are
compared with all members that aren't yet in their classes; then they leave the bucket, and buckets with a single class are done.
So no link between nodes that share a bucket is lost, and a bucket costs its size in each round, not its square.

Where many pairs stay open after the first round, as where edits of one text lie just beyond the threshold, the shingles of the
open nodes are counted, and a pivot's overlap with all members of its bucket is kept. Two bags overlap by what each shares with any
open node at most; and within and without the pivot's bag by what each has there at most. So most pairs are told apart
unread. When few pairs are left, in proportion to the rows, they are compared at once: nodes outside a bucket's largest class with
all that they may reach. Bounds and last rounds only save work; classes are the same with and without them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from . import spans
from .staging import staged

SHINGLE = 5
SIMILARITY = 0.8
#: Bands and rows: a pair at similarity 0.8 shares a bucket with probability 0.9999, one at 0.4 with 0.22.
BANDS, ROWS = 24, 5
#: Pairs left for each row of the buckets at which rounds end: so few that comparing them costs less than the bounds. Pairs grow with the
#: square of a group of near copies, so anything above goes through the bounds, whatever the size of the input.
FEW = 0.25
#: Pairs of nodes for each row of the buckets whose bounds are compared at most before the last round; else another pivot comes first.
REACH = 64
#: Ratio of the largest to the least size in a size class.
STEP = 1.01
#: Pivots of a bucket in a round, at most.
PIVOTS = 16
#: Rows of links or classes for each task of a small step, beyond the least number of tasks.
TASK_ROWS, TASKS = 100_000, 8


def shingle_bags(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, how often they occur, and their text. A text under SHINGLE words is one shingle."""
    data = spans.lowered(data)
    starts, ends, owner = spans.words(data, offsets)
    hashes = spans.hash_spans(data, starts, ends)
    n = len(hashes)
    out = hashes
    for k in range(1, SHINGLE):
        follow = np.zeros(n, np.uint64)
        if n > k:
            follow[: n - k] = np.where(owner[k:] == owner[: n - k], hashes[k:], np.uint64(0))
        out = spans.join_hashes(out, follow)
    sizes = np.bincount(owner, minlength=len(offsets) - 1)
    place = np.arange(n) - (np.cumsum(sizes) - sizes)[owner]
    whole = place < np.maximum(sizes - (SHINGLE - 1), 1)[owner]
    out, owner = out[whole], owner[whole]
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    first = np.flatnonzero(np.r_[True, (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])]) if len(out) else np.zeros(0, np.int64)
    return out[first], np.diff(np.append(first, len(out))), owner[first]


def signatures(bag: np.ndarray, weight: np.ndarray, owner: np.ndarray, n: int, m: int = BANDS * ROWS) -> np.ndarray:
    """``m`` registers for each of ``n`` texts: the times of their earliest points; infinite for a text without shingles."""
    registers = np.full(n * m, np.inf)
    top = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    item = np.repeat(np.arange(len(bag)), top + 1)
    level = np.arange(len(item)) - np.repeat(np.cumsum(top + 1) - (top + 1), top + 1)
    width = np.where(level > 0, 1 << np.maximum(level - 1, 0), 1)
    seed = spans.join_hashes(bag[item], level.astype(np.uint64))
    text, limit, time = owner[item], weight[item], np.zeros(len(item))
    step = np.uint64(0)
    while len(seed):
        step += np.uint64(1)
        draw = spans.join_hashes(seed, np.full(len(seed), step, np.uint64))
        time = time - np.log(((draw >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / width
        draw = spans.mix(draw + np.uint64(1))
        register = (draw >> np.uint64(33)).astype(np.int64) % m
        at = np.where(width > 1, width + 1 + (draw & np.uint64(0xFFFFFFFF)).astype(np.int64) % width, np.where(level == 1, 2, 1))
        counts = at <= limit
        np.minimum.at(registers, text[counts] * m + register[counts], time[counts])
        more = time < registers.reshape(n, m).max(axis=1)[text]
        seed, text, limit, time, width, level = (x[more] for x in (seed, text, limit, time, width, level))
    return registers.reshape(n, m)


def band_hashes(registers: np.ndarray) -> np.ndarray:
    """A hash for each band of each text."""
    bits = registers.view(np.uint64).reshape(len(registers), BANDS, ROWS)
    parts = [np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bits.shape[:2]), *(bits[:, :, r] for r in range(ROWS))]
    return spans.join_hashes(*parts).view(np.int64)


def with_bands(docs: DataFrame, *, text: str = "text", out: str = "bands") -> DataFrame:
    """All columns but ``text``, and the band hashes of each row: null for a text without words."""
    keep = [c for c in docs.columns if c != text]
    schema = StructType([*docs.select(*keep).schema.fields, StructField(out, ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = spans.text_bytes(batch.column(len(keep)))
            for i, j in spans.blocks(offsets):
                registers = signatures(*shingle_bags(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), j - i)
                empty = np.isinf(registers[:, 0])
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(band_hashes(registers).ravel()), mask=pa.array(empty))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(len(keep))), bands], names=[*keep, out])

    return docs.select(*keep, text).mapInArrow(run, schema)


def units(bag: np.ndarray, weight: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bags as sets, and the text of each member: the k-th time that a text has a shingle is a member of its own, so sets overlap as bags do."""
    item = np.repeat(np.arange(len(bag)), weight)
    nth = np.arange(len(item)) - np.repeat(np.cumsum(weight) - weight, weight)
    return np.where(nth > 0, spans.join_hashes(bag[item], nth.astype(np.uint64)), bag[item]), owner[item]


def with_units(texts: DataFrame) -> DataFrame:
    """``node`` and ``units``, the members of the text's set as 64-bit words, so that no comparison reads words again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = spans.text_bytes(batch.column(1))
            for i, j in spans.blocks(offsets):
                members, owner = units(*shingle_bags(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                ends = np.r_[0, np.cumsum(np.bincount(owner, minlength=j - i))].astype(np.int32)
                held = pa.ListArray.from_arrays(pa.array(ends), pa.array(members.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), held], names=["node", "units"])

    return texts.select("node", "text").mapInArrow(run, "node long, units array<long>")


def held_units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The members of all sets of a column that ``with_units`` made, and where each set begins and the last ends."""
    offsets = column.offsets.to_numpy()
    members = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
    return members.view(np.uint64), (offsets - offsets[0]).astype(np.int64)


def overlaps(x: np.ndarray, of_x: np.ndarray, y: np.ndarray, of_y: np.ndarray) -> np.ndarray:
    """For each pair of sets, how many members they share. A member is known by its pair and the bits that this leaves of its hash."""
    n = len(of_x) - 1
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    keys = [np.repeat(np.arange(n, dtype=np.uint64), np.diff(of)) << (np.uint64(64) - bits) | m >> bits for m, of in ((x, of_x), (y, of_y))]
    keys = np.sort(np.concatenate(keys))
    return np.bincount((keys[1:][keys[1:] == keys[:-1]] >> (np.uint64(64) - bits)).astype(np.int64), minlength=n)


def _overlaps(pairs: DataFrame) -> DataFrame:
    """``a``, ``b``, how many members the sets ``units_a`` and ``units_b`` have in ``common``, and in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, of_x), (y, of_y) = (held_units(batch.column(c)) for c in (2, 3))
            for i, j in spans.blocks((of_x + of_y) * 8):
                common = overlaps(x[of_x[i] : of_x[j]], of_x[i : j + 1], y[of_y[i] : of_y[j]], of_y[i : j + 1])
                total = np.diff(of_x[i : j + 1]) + np.diff(of_y[i : j + 1]) - common
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(common), pa.array(total)], names=["a", "b", "common", "total"])

    return pairs.select("a", "b", "units_a", "units_b").mapInArrow(run, "a long, b long, common long, total long")


def shared_sizes(texts: DataFrame) -> DataFrame:
    """``node``, ``size`` of its bag, and ``shared``: how many of its members another of ``texts`` (node, units) has too."""
    members = texts.select("node", F.explode("units").alias("unit")).groupBy("unit")
    alone = members.agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    sizes = texts.select("node", F.size("units").alias("size")).join(alone, "node", "left")
    return sizes.select("node", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("shared"))


def within_reach(rows: DataFrame, sizes: DataFrame, similarity: float) -> DataFrame:
    """``rows`` (bucket, node) with the columns of ``sizes``, without nodes that can't reach any size in their bucket.

    A bag can be linked with those from ``similarity`` times its size on, and to none so large that the overlap it takes
    exceeds what the bag shares. Sizes are told by classes, of which a bucket has some hundreds at most.
    """
    rows = rows.join(sizes, "node").where(F.col("shared") >= similarity * F.col("size") - 1e-6)
    largest = F.col("shared") * (1 + similarity) / similarity - F.col("size")
    rows = rows.withColumn("_from", _log(F.col("size") * similarity, -1e-6)).withColumn("_to", _log(largest, 1e-6)).withColumn("_kind", _log(F.col("size")))
    kinds = rows.groupBy("bucket").agg(F.collect_set("_kind").alias("_kinds"))
    met = F.exists("_kinds", lambda k: k.between(F.col("_from"), F.col("_to")))
    return rows.join(kinds, "bucket").where(met).select("bucket", "node", "size", "shared")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``class``, the least node reachable by ``edges`` (a, b).

    Every node takes the least class among itself and its neighbours until nothing changes; from the third round on it
    also takes its class's class, so long chains shrink by half. Rows are written after each round.
    """
    ab = edges.select("a", "b")
    tasks = TASKS + ab.count() // TASK_ROWS
    both = ab.unionByName(ab.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(ab.select("a", F.col("a").alias("b"))).unionByName(ab.select(F.col("b").alias("a"), "b")).distinct()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("class"))
    labels, turn = staged(labels.coalesce(tasks), "labels"), 0
    both = staged(both.coalesce(tasks), "both")
    while True:
        met = both.join(labels, both.b == labels.node)
        found = met.groupBy("a").agg(F.max(F.when(F.col("a") == F.col("b"), F.col("class"))).alias("_was"), F.min("class").alias("class")).withColumnRenamed("a", "node")
        if turn >= 2:
            up = labels.select(F.col("node").alias("_up"), F.col("class").alias("_of_up"))
            found = found.join(up, F.col("class") == F.col("_up"), "left").select("node", "_was", F.least("class", F.coalesce("_of_up", "class")).alias("class"))
        found, turn = staged(found.coalesce(tasks), "labels"), turn + 1
        labels = found.select("node", "class")
        if found.where(F.col("class") != F.col("_was")).isEmpty():
            return labels


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (node, class) after new links (a, b): only the classes that these touch are looked at."""
    if labels is None:
        return components(links)
    of_a, of_b = (labels.select(F.col("node").alias(x), F.col("class").alias(f"_{x}")) for x in "ab")
    between = links.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    joined = components(between.where("a <> b").distinct())
    to = joined.select(F.col("node").alias("class"), F.col("class").alias("_to"))
    known = labels.join(to, "class", "left").select("node", F.coalesce("_to", "class").alias("class"))
    tasks = TASKS + (labels.count() + joined.count()) // TASK_ROWS
    return staged(known.unionByName(joined.join(labels, "node", "left_anti")).coalesce(tasks), "labels")


def _classes(marks: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """For each ``mark`` of ``marks`` (id, mark, bands) ``class``: the least ``id`` of the class, and the least ``mark`` that this id has there."""
    nodes = marks.where("id IS NOT NULL").groupBy("mark").agg(F.min("id").alias("id"), F.any_value("bands").alias("bands"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    own = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = own.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("pivot")).where("n > 1").select("bucket", "pivot")
    buckets = staged(own.join(shared, "bucket"), "buckets")
    total, labels = buckets.count(), None
    nodes = nodes.drop("bands")
    if total:
        met = nodes.join(buckets.select("node").distinct(), "node").select("id", "mark", "node")
        texts = rows.join(met, ["id", "mark"]).dropDuplicates(["node"])
        labels = _linked(buckets, staged(with_units(texts), "units"), total, similarity)
    named = F.struct("id", "mark")
    if labels is None:
        return nodes.select("mark", named.alias("class"))
    linked = nodes.join(labels, "node")
    of_class = linked.groupBy("class").agg(F.min(named).alias("_named"))
    named = F.coalesce("_named", named)
    return nodes.join(linked.join(of_class, "class").select("node", "_named"), "node", "left").select("mark", named.alias("class"))


def _marks(rows: DataFrame) -> DataFrame:
    return staged(with_bands(rows), "marks")


def _marked(docs: DataFrame, id: str, text: str) -> DataFrame:
    text = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id).cast("long").alias("id"), text.alias("text"), F.sha1(text).alias("mark"))


def near_duplicate_classes(docs: DataFrame, *, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``id`` and ``class_id`` of each row: the least id among texts linked by similarities of at least ``similarity``.

    Equal texts (null counts as empty) are one class whatever their length; texts without words have no other link.
    Ids are whole numbers; rows that share an id but not a text each have the class of their text; rows without an id have
    no class. Other columns are not carried. An empty table gives no rows.
    """
    rows = _marked(docs, id, text)
    marks = _marks(rows)
    found = marks.select("id", "mark").where("id IS NOT NULL").join(_classes(marks, rows, similarity), "mark")
    alone = marks.where("id IS NULL").select("id", F.col("id").alias("class_id"))
    return found.select("id", F.col("class.id").alias("class_id")).unionByName(alone).withColumnRenamed("id", id)


def _linked(buckets: DataFrame, texts: DataFrame, total: int, similarity: float) -> DataFrame | None:
    """Classes (node, class) of the linked nodes in ``buckets`` (bucket, node, band, pivot).

    The first round takes half of the bands: what it links leaves the other half's buckets done.
    """
    first = buckets.where(F.col("band") < BANDS // 2).select("node", "pivot")
    labels, tested = _linked_more(None, _compared(first.where("node <> pivot"), None, texts), similarity)
    left = buckets.where((F.col("band") >= BANDS // 2) | (F.col("node") != F.col("pivot"))).select("bucket", "node")
    turn, sizes = 1, None
    while True:
        turn += 1
        classed = staged(_classed(left, labels), "classed")
        open_ = staged(_open_buckets(classed, turn), "open")
        pairs_left = open_.agg(F.sum("pairs")).first()[0]
        if not pairs_left:
            return labels
        classed = classed.join(open_.drop("pairs"), "bucket")
        if pairs_left <= FEW * total:
            pairs = _outside_largest(classed).where(F.col("class") != F.col("pivot_class"))
            return _linked_more(labels, _compared(pairs, tested, texts), similarity)[0]
        if sizes is None:
            sizes = staged(shared_sizes(texts.join(classed.select("node").distinct(), "node", "left_semi")), "sizes")
            left = staged(within_reach(classed.select("bucket", "node"), sizes, similarity), "reach")
            continue
        met = classed.select("bucket", "node", "class", F.posexplode("pivots").alias("nth", "pivot"))
        met = met.where((F.col("node") != F.col("pivot.node")) & ((F.col("nth") == 0) | (F.col("class") != F.col("pivot.class"))))
        found = _compared(met.select("node", F.col("pivot.node").alias("pivot")), None, texts)
        labels, tested = _linked_more(labels, found, similarity, tested)
        left = staged(_with_common(classed, found), "left")
        reached = staged(_reached(_classed(left, labels), similarity), "reached")
        if (reached.agg(F.sum("n")).first()[0] or 0) <= REACH * total:
            pairs = _reached_pairs(reached, _classed(left, labels), similarity)
            return _linked_more(labels, _compared(pairs, tested, texts), similarity)[0]


def _classed(left: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``left`` with the ``class`` of each node so far."""
    if labels is None:
        return left.withColumn("class", F.col("node"))
    return left.join(labels, "node", "left").withColumn("class", F.coalesce("class", "node"))


def _with_common(classed: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets without their pivots; ``common`` is their overlap with the first pivot, ``own`` what they share beside it with others."""
    first = F.get("pivots", F.lit(0)).getField("node")
    rows = classed.where(~F.array_contains("pivots.node", F.col("node"))).select("bucket", "node", "size", "shared", F.least(first, "node").alias("a"), F.greatest(first, "node").alias("b"))
    rows = rows.join(found.select("a", "b", "common"), ["a", "b"])
    return rows.select("bucket", "node", "size", "shared", "common", F.greatest(F.col("shared") - F.col("common"), F.lit(0)).alias("own"))


def _log(size: Column, slack: float = 0.0) -> Column:
    return F.floor(F.log(F.greatest(size.cast("double"), F.lit(1.0))) / np.log(STEP) + slack)


def _reached(classed: DataFrame, similarity: float) -> DataFrame:
    """Nodes outside their bucket's largest class (``x``) with each ``cell`` of the bucket that may hold a node to link them to, and its rows ``n``.

    A cell is the nodes of a bucket with about the same ``common``; a bucket has some hundreds at most.
    """
    classed = classed.withColumn("cell", _log(F.col("common")))
    largest = classed.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "class")).alias("largest"), F.count(F.lit(1)).alias("classes"))
    x = classed.join(largest.where("classes > 1"), "bucket").where(F.col("class") != F.col("largest.class"))
    x = x.select("bucket", F.struct("node", "class", "size", "common", "own").alias("x"))
    cells = classed.groupBy("bucket", "cell").agg(F.struct(F.min("size").alias("size"), F.max("common").alias("common"), F.max("own").alias("own")).alias("y"), F.count(F.lit(1)).alias("n"))
    x, cells = x.alias("x"), cells.alias("c")
    near = (F.col("x.bucket") == F.col("c.bucket")) & _may_link(F.col("x.x"), F.col("c.y"), similarity)
    return x.join(cells, near).select("x.bucket", "x.x", "c.cell", "c.n")


def _may_link(x: Column, y: Column, similarity: float) -> Column:
    """Whether the overlap that bags x and y need is no more than they may have: within the pivot, and beside it."""
    need = similarity / (1 + similarity) * (x.getField("size") + y.getField("size"))
    most = F.least(x.getField("common"), y.getField("common")) + F.least(x.getField("own"), y.getField("own"))
    return need <= most + 1e-6


def _reached_pairs(reached: DataFrame, classed: DataFrame, similarity: float) -> DataFrame:
    """``node`` and ``pivot``: nodes of ``reached`` with all of another class that they may be linked to, in the first bucket that both are in."""
    of = classed.groupBy("node").agg(F.collect_list("bucket").alias("buckets"))  # BANDS at most
    x = reached.select("bucket", "cell", "x").join(of.select(F.col("node").alias("_node"), "buckets"), F.col("x.node") == F.col("_node"))
    y = classed.join(of, "node").select("bucket", _log(F.col("common")).alias("cell"), F.struct("node", "class", "size", "common", "own").alias("y"), "buckets")
    x, y = x.alias("x"), y.alias("y")
    meet = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.cell") == F.col("y.cell")) & (F.col("x.x.class") != F.col("y.y.class"))
    once = F.array_min(F.array_intersect("x.buckets", "y.buckets")) == F.col("x.bucket")
    return x.join(y, meet & _may_link(F.col("x.x"), F.col("y.y"), similarity) & once).select(F.col("x.x.node").alias("node"), F.col("y.y.node").alias("pivot"))


def _open_buckets(classed: DataFrame, turn: int) -> DataFrame:
    """``bucket``, how many ``pairs`` of nodes of different classes it has if any, and its ``pivots``.

    A pivot is a member of the largest class, drawn at random, so that those just beyond one pivot meet others, or where
    it is known what bags share, the one with least of its own, so that bounds are close; and one of more and more other classes.
    """
    by = F.col("size") - F.col("shared") if "shared" in classed.columns and turn == 3 else F.xxhash64("node", "bucket", F.lit(turn))
    sizes = classed.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(by, "node")).alias("drawn")).select("bucket", "class", "n", "drawn.node")
    others = range(1, min(PIVOTS, 2 ** max(turn - 2, 0)))
    named = [F.max(F.struct("n", "node", "class")), *(F.min(F.struct(F.xxhash64("class", F.lit(turn), F.lit(i)), "node", "class")) for i in others)]
    pivots = F.array_distinct(F.array(*(F.struct(x.getField("node").alias("node"), x.getField("class").alias("class")) for x in named)))
    found = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), pivots.alias("pivots"))
    return found.where(F.col("n") * F.col("n") > F.col("nn")).select("bucket", ((F.col("n") * F.col("n") - F.col("nn")) / 2).alias("pairs"), "pivots")


def _compared(pairs: DataFrame, tested: DataFrame | None, texts: DataFrame) -> DataFrame:
    """``a``, ``b``, ``common`` and ``total`` of ``pairs`` (node, pivot) that weren't ``tested`` before."""
    pairs = pairs.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    pairs = staged(pairs, "pairs")
    a, b = (texts.select(F.col("node").alias(x), F.col("units").alias(f"units_{x}")) for x in "ab")
    return staged(_overlaps(pairs.join(b, "b").join(a, "a")), "overlaps")


def _linked_more(labels: DataFrame | None, found: DataFrame, similarity: float, tested: DataFrame | None = None) -> tuple[DataFrame | None, DataFrame]:
    """``labels`` after the links among the pairs ``found``, and all pairs tested so far."""
    links = found.where(F.col("common") >= similarity * F.col("total")).where("total > 0").select("a", "b")
    if not links.isEmpty():
        labels = merged(labels, links)
    pairs = found.select("a", "b")
    return labels, pairs if tested is None else tested.unionByName(pairs)


def _outside_largest(classed: DataFrame) -> DataFrame:
    """``node``, ``class``, ``pivot`` and ``pivot_class``: all nodes of each bucket with those outside its largest class, which ``pivots`` names first.

    Of two nodes of different classes one is outside the largest, so no pair is missed; rows are at most twice the pairs of different classes.
    """
    other = classed.where(F.col("class") != F.get("pivots", F.lit(0)).getField("class"))
    other = other.select("bucket", F.col("node").alias("pivot"), F.col("class").alias("pivot_class"))
    return classed.select("bucket", "node", "class").join(other, "bucket").drop("bucket")


def keep_one(docs: DataFrame, *, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class, that of the least id. Rows without an id stay; of rows that agree in a kept id and text one stays."""
    rows = _marked(docs, id, text)
    marks = _marks(rows)
    kept = _classes(marks, rows, similarity).select(F.col("class.id").alias("_kept"), F.col("class.mark").alias("_mark")).distinct()
    own = docs.where(F.col(id).isNotNull()).select(F.struct("*").alias("row"), F.col(id).alias("id"), F.sha1(F.coalesce(F.col(text), F.lit(""))).alias("own"))
    one = own.join(kept, (F.col("id") == F.col("_kept")) & (F.col("own") == F.col("_mark")), "left_semi").dropDuplicates(["id", "own"]).select("row.*")
    return one.unionByName(docs.where(F.col(id).isNull()))
