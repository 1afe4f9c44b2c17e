"""The numbered operators as queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bagminhash, bpe_count, divergence, fingerprint, knlm, line_dedup, packing, positional, repetition, runs, toxicity, unigram, warc
from .staging import fresh_path, staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize_pieces(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    pieces = pieces.select("doc_id", "piece", "start", F.col("length").cast("long"), F.crc32("ids").alias("ids_crc32"))
    return packing.best_fit_pack(pieces)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.with_score(docs, model).drop("text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    encoded = unigram.encode_documents(docs, path, scores=unigram.fitted_scores(docs, path)).withColumn("ids_crc32", F.crc32("ids"))
    return unigram.decode_documents(encoded, path).select("doc_id", "n_tokens", "n_bytes_fallen", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("source")


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.crc32(F.col("doc_id").cast("string")) % 5
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", (rest != 1).alias("train"))
    scored = knlm.score_documents(docs, "train")
    return scored.select("doc_id", (rest == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archives(warc.resolve_revisits(_table(spark, sf_dir, "pages")), path, date="2024-01-01T00:00:00Z")
    records = staged(warc.read_archives(spark, path), "records")
    return warc.follow_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.with_repetition(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return repetition.judge(found).drop("text")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = fingerprint.with_next(docs)
    docs = docs.withColumn("edited", fingerprint.edited(F.col("text"), F.col("next_text")))
    docs = docs.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "text", "next_text", "edited")
    for text, sketch in (("text", "sketch"), ("next_text", "next_sketch"), ("edited", "edited_sketch")):
        docs = fingerprint.with_sketch(docs, text, sketch).drop(text)
    return docs.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint.as_text("sketch").alias("fingerprint"),
        fingerprint.as_text("edited_sketch").alias("edited_fingerprint"),
        fingerprint.likeness("sketch", "edited_sketch").alias("near_edited"),
        fingerprint.likeness("sketch", "next_sketch").alias("near_next"),
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicate_classes(_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional.contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark").select("item_id", "text"))


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents whose hashed id is divisible by ten repeat, from some word on, that word and those after it with some period."""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    docs = docs.withColumn("_g", F.floor(hashed / 10)).withColumn("_words", F.when(hashed % 10 == 0, F.array_remove(F.split("text", "[ \\t-\\r]+"), "")))
    n = F.size("_words")
    docs = docs.withColumn("_a", F.when(n > 0, (F.col("_g") % n).cast("int")))
    docs = docs.withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8)).cast("int"))
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    again = F.array_join(F.transform("_words", lambda w, i: F.get("_words", place(i))), " ")
    return docs.withColumn("text", F.when(F.col("_a").isNotNull(), again).otherwise(F.col("text"))).drop("_g", "_words", "_a", "_p")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.with_runs(with_periods(_table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("text")


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_toxicity, op3_sentencepiece, op4_token_counts, op5_line_dedup, op6_lm_scores, op7_warc_revisits, op8_quality_rules, op9_fingerprints,
    op10_near_duplicates, op11_source_divergence, op12_decontamination, op13_periodic_runs,
)}

OP5_SQL = """
WITH lines AS (
  SELECT doc_id, coalesce(source, '') AS site, pos, trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS line, line AS raw
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
), spread AS (
  SELECT line, min(doc_id) AS first FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 5
), marked AS (
  SELECT l.doc_id, l.pos, l.raw, s.line IS NOT NULL AND l.doc_id <> s.first AS gone FROM lines l LEFT JOIN spread s ON l.line = s.line
), again AS (
  SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text, count(*)::INT AS n_lines, count(*) FILTER (WHERE gone)::INT AS n_removed
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, a.text, coalesce(a.n_lines, 0) AS n_lines, coalesce(a.n_removed, 0) AS n_removed FROM documents d LEFT JOIN again a ON d.doc_id = a.doc_id
"""

OP7_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), o AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS original FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN original > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original > page_id THEN original END AS refers_to FROM o
"""

OP11_SQL = r"""
WITH words AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), tokens AS (SELECT lang, source, doc, unnest(terms) AS term FROM words),
kept AS (SELECT lang, term, count(*) AS total FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
sizes AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM words),
counts AS (SELECT t.lang, source, t.term, count(*) AS n FROM tokens t JOIN kept USING (lang, term) GROUP BY ALL),
own AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total, s.v, s.n AS all_n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (coalesce(o.n, 0) + s.v))::HUGEINT AS p
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(p.value, 0)::BIGINT AS value FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
), term AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM (SELECT *, (1 + 1000000000::HUGEINT * (total + 1) // (all_n + v))::HUGEINT AS q FROM shares WHERE n > 0) WHERE p > q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + 9], ' ') AS said FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT row, i, size, array_to_string(w[i : i + size - 1], ' ') AS said FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), found AS (SELECT row, i, size, item_id FROM places JOIN windows USING (size, said)),
hit AS (SELECT row, count(DISTINCT pos) AS n FROM (SELECT row, unnest(range(i, i + size)) AS pos FROM (SELECT DISTINCT row, i, size FROM found)) GROUP BY row),
listed AS (SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM found) GROUP BY row),
tokens AS (SELECT row, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM d),
often AS (SELECT term, count(*) AS n FROM tokens GROUP BY term),
parts AS (SELECT item_id, said, size, unnest(string_split(said, ' ')) AS term, generate_subscripts(string_split(said, ' '), 1) AS k FROM windows),
anchors AS (SELECT item_id, said, size, arg_min(term, (o.n, k)) AS term, arg_min(k, (o.n, k)) AS k FROM parts JOIN often o USING (term) GROUP BY ALL HAVING count(*) = size),
started AS (SELECT a.item_id, a.said, a.size, t.row, t.pos - a.k AS pos FROM anchors a JOIN tokens t ON t.term = a.term),
near AS (
  SELECT s.row, s.item_id, s.said, s.pos FROM started s JOIN parts p ON p.item_id = s.item_id AND p.said = s.said JOIN tokens t ON t.row = s.row AND t.term = p.term AND t.pos BETWEEN s.pos + p.k - 2 AND s.pos + p.k + 2
  GROUP BY s.row, s.item_id, s.said, s.pos, s.size HAVING count(DISTINCT p.k) = s.size
), close AS (SELECT row, count(DISTINCT item_id) AS n FROM near GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(l.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated, coalesce(c.n, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN hit h ON h.row = d.row LEFT JOIN listed l ON l.row = d.row LEFT JOIN close c ON c.row = d.row
"""

ORACLE_SQL: dict[str, str] = {"op11_source_divergence": OP11_SQL, "op12_decontamination": OP12_SQL, "op5_line_dedup": OP5_SQL, "op7_warc_revisits": OP7_SQL}
