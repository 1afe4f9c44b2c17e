"""Source divergence, positional search and periodic runs against plain Python, on odd rows, and as queries over a given folder."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm import bagminhash, bpe_count, divergence, fingerprint, line_dedup, positional, queries, repetition, runs

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# Source divergence


def brute_audit(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", LETTERS.findall(lower(text))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in seen.items() if n >= min_docs)
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if seen[t] >= min_docs)
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in counts.items()}
        whole = sum(counts.values(), Counter())
        q = {t: 1 + 10**9 * (whole[t] + 1) // (sum(whole.values()) + len(kept)) for t in kept}
        f = lambda a, b: (a - b) * (a - b) // b
        for s in counts:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found)]
    return sorted(out)


def odd_corpus():
    rnd = random.Random(1)
    words = ["alpha", "Beta", "γάμμα", "d1e", "x-y", "Ünï", "the", "of", *(f"w{chr(97 + k)}" for k in range(20))]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    rows = [(rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "c", "é", None]), say(rnd.randrange(40))) for _ in range(60)]
    return [*rows, ("en", "lonely", None), ("en", "bare", "123 456"), ("xx", "only", "one two"), ("xx", "other", ""), rows[0], rows[0], ("en", "a", "the " * 30000)]


def test_divergence_against_brute_force(spark):
    rows = odd_corpus()
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    found = sorted(map(tuple, divergence.audit(df.withColumns({"term": F.lit(1), "n": F.lit("x"), "value": F.lit(0)})).collect()))
    assert found == brute_audit(rows)
    assert divergence.audit(df.where("false")).count() == 0


def test_divergence_without_kept_terms(spark):
    df = spark.createDataFrame([("en", "b", "one"), ("en", "a", None), ("en", None, "two")], "lang string, source string, text string")
    found = sorted(map(tuple, divergence.audit(df).collect()))
    assert found == brute_audit([tuple(r) for r in df.collect()]) and [r[4] for r in found] == [0] * 6


def test_joint_tables_and_narrow_blocks(spark, monkeypatch):
    """Every joint table, and the same values however narrow the blocks and slices are."""
    rows = odd_corpus()
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    wanted = sorted(map(tuple, divergence.audit(df).collect()))
    for name, value in (("WIDTH", 1), ("ROWS", 3), ("SLICE_ROWS", 4), ("COUNTED_BYTES", 50)):
        monkeypatch.setattr(divergence, name, value)
    assert sorted(map(tuple, divergence.audit(df).collect())) == wanted
    terms = divergence.kept_terms(divergence.term_counts(df))
    entries = terms.select("lang", "term", F.inline("counts"))
    groups = entries.groupBy("lang", "source").agg(F.sum("n").alias("n")).join(terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds")), "lang")
    found = {tuple(r)[:5]: r.n_terms for r in divergence.joint_tables(terms, groups).collect()}
    count = defaultdict(dict)
    for r in entries.collect():
        count[r.lang, r.term][r.source] = r.n
    sources = defaultdict(set)
    for (lang, _), own in count.items():
        sources[lang] |= set(own)
    brute = Counter((lang, a, b, own.get(a, 0), own.get(b, 0)) for (lang, _), own in count.items() for a in sources[lang] for b in sources[lang] if a != b)
    assert found == brute


def test_shares_are_exact_for_large_counts():
    rnd = random.Random(2)
    n = [0, 1, *(rnd.randrange(10**14) for _ in range(200))]
    of = [x + rnd.randrange(1, 10**14) for x in n]
    assert divergence.shares(np.array(n), np.array(of)).tolist() == [1 + 10**9 * (a + 1) // b for a, b in zip(n, of)]


# Positional search


def brute_contamination(docs, items, window=10, slop=2):
    items = [(i, TERM.findall(lower(t))) for i, t in items]
    docs = [(i, TERM.findall(lower(t))) for i, t in docs]
    often = Counter(w for _, words in docs for w in words)
    windows = {(i, tuple(w[k : k + window])) for i, w in items for k in range(max(len(w) - window + 1, 1)) if w}
    out = []
    for i, words in docs:
        hit, found, near = set(), set(), set()
        places = defaultdict(list)
        for k, w in enumerate(words):
            places[w].append(k)
        for item, said in windows:
            for k in range(len(words) - len(said) + 1):
                if tuple(words[k : k + len(said)]) == said:
                    hit.update(range(k, k + len(said)))
                    found.add(item)
            if all(w in places for w in said):
                first = min(range(len(said)), key=lambda k: (often[said[k]], k))
                for at in places[said[first]]:
                    if all(any(abs(x - (at - first + k)) <= slop for x in places[w]) for k, w in enumerate(said)):
                        near.add(item)
        listed = sorted(str(x) for x in found if x is not None)
        out.append((i, len(words), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit), len(near - {None})))
    return sorted(out, key=str)


def passages():
    rnd = random.Random(3)
    say = lambda n, many=30: [f"{rnd.choice('abcéF')}{rnd.randrange(many)}" for _ in range(n)]
    items = [(k, " ".join(say(rnd.randrange(1, 30)))) for k in range(40)] + [(40, None), (41, "..."), (42, "a1"), (7, "b2 c3"), (43, "same " * 12), (44, "same same"), (45, "never-heard-of word")]
    docs = []
    for k in range(120):
        words = say(rnd.randrange(80))
        if k % 2:
            said = (rnd.choice(items)[1] or "").split()
            if k % 4 == 1 and said:
                for _ in range(rnd.randrange(3)):
                    said.insert(rnd.randrange(len(said) + 1), "extra")
            cut = rnd.randrange(len(words) + 1)
            words = words[:cut] + said + words[cut:]
        docs.append((k, rnd.choice([" ", "-", "\n", "　 "]).join(words)))
    return [*docs, (200, None), (201, ""), (202, "same " * 500), (None, docs[1][1]), (203, docs[3][1]), docs[3], docs[3]], items


@pytest.mark.parametrize("phrases", [positional.PHRASES, 50])
def test_contamination_against_brute_force(spark, monkeypatch, phrases):
    monkeypatch.setattr(positional, "PHRASES", phrases)
    docs, items = passages()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"segment": F.lit(1), "row": F.lit("x"), "terms": F.lit(None).cast("string")}).repartition(3)
    found = positional.contamination(df, spark.createDataFrame(items, "item_id long, text string").withColumn("phrase", F.lit(3)))
    assert sorted(map(tuple, found.collect()), key=str) == brute_contamination(docs, items)


def test_contamination_of_empty_tables_and_other_ids(spark):
    docs, items = spark.createDataFrame([("a", "one two three")], "name string, said string"), spark.createDataFrame([("x", "two three")], "what string, said string")
    names = {"id": "name", "text": "said", "item_id": "what", "item_text": "said"}
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in positional.contamination(docs, items, **names).collect()] == [("a", 3, 2, 1, hashlib.sha256(b"x").hexdigest(), True, 1)]
    assert [tuple(r) for r in positional.contamination(docs, items.where("false"), **names).collect()] == [("a", 3, 0, 0, empty, False, 0)]
    assert positional.contamination(docs.where("false"), items, **names).count() == 0


def test_search_in_a_text_over_one_block(spark):
    rnd = random.Random(4)
    long = [f"u{rnd.randrange(10**6)}" for _ in range(200_000)]
    at = [5, 77_777, 199_988]
    docs = spark.createDataFrame([(1, "short one"), (2, " ".join(long)), (3, "short one")], "doc_id long, text string")
    items = spark.createDataFrame([(k, " ".join(long[a : a + 12])) for k, a in enumerate(at)], "item_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in positional.contamination(docs, items).collect()}
    assert found == {1: (2, 0, 0), 2: (200_000, 36, 3), 3: (2, 0, 0)}


# Periodic runs


def brute_runs(w, least=4, words=6):
    found = []
    for p in range(1, len(w) // least + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            n = j - i + p
            if j > i and n >= max(words, least * p) and not any(all(w[k] == w[k + q] for k in range(i, i + n - q)) for q in range(1, p)):
                found.append((i, n, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(text):
    w = WORD.findall(text or "")
    found = brute_runs(w)
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {k for a, n, p in found for k in range(a + p, a + n)}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest("".join(f"{a},{n},{p}\n" for a, n, p in found)), digest(kept)), kept


def test_runs_against_brute_force(spark):
    rnd = random.Random(5)
    texts = [None, "", " \t\n", "a", "a " * 6, "a " * 5, "x y " * 4, "　 é " * 9, "A a " * 3, "ab\x0bc " * 7 + "ab"]
    for _ in range(400):
        words = []
        while len(words) < rnd.randrange(60):
            unit = [rnd.choice("abc") for _ in range(rnd.randrange(1, 6))]
            words += (unit * rnd.randrange(1, 8))[: rnd.randrange(1, 40)]
        texts.append(rnd.choice([" ", "\n", "  "]).join(words))
    texts += texts[20:24]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"period": F.lit("x"), "Start": F.lit(1)}).repartition(3)
    found = runs.with_runs(df, collapsed="once")
    assert found.columns == ["doc_id", "text", *runs.COLUMNS, "once"]
    for r in found.collect():
        assert ((*tuple(r)[2:9],), r.once) == brute_row(texts[r.doc_id]), texts[r.doc_id]
    assert runs.with_runs(df.where("false")).count() == 0


def test_runs_of_small_exponents_and_long_texts():
    rnd = random.Random(6)
    for least, words in ((2, 2), (3, 5), (2, 7), (4, 2)):
        for _ in range(150):
            w = [rnd.choice("ab" if rnd.random() < 0.9 else "cd") for _ in range(rnd.randrange(1, 50))]
            symbols = np.array([ord(x) for x in w], np.uint64)
            assert [tuple(r) for r in runs.find_runs(symbols, np.zeros(len(w), int), least, words).tolist()] == brute_runs(w, least, words)
    unit = rnd.sample(range(10**6), 700)
    symbols = np.array([1] * 50_000 + unit * 40 + [7], np.uint64)
    assert runs.find_runs(symbols, np.zeros(len(symbols), int)).tolist() == [[0, 50_000, 1], [50_000, 28_000, 700]]


# Own columns, odd rows and merging of the earlier operators

INSIDE = ["_gone", "_own", "_first", "_bucket", "_order", "_words", "row", "order", "bucket", "first", "follows", "own", "lines", "id", "words", "kept"]


def test_own_columns_of_any_name(spark):
    """Columns named as those used inside come back as they were."""
    shared = "a line that stands on very many different sites"
    rows = [(i, f"own {i} " + " ".join(f"w{i}x{k}" for k in range(20)) + f"\n{shared}", f"s{i % 6}") for i in range(12)] + [(20, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in INSIDE})
    for out in (line_dedup.dedup_lines(df), fingerprint.with_next(fingerprint.with_sketch(df, "text", "sketch"), carry="sketch"), bagminhash.keep_one(df)):
        assert set(df.columns) <= set(out.columns) and out.count() == len(rows)
        assert all(r[c] == f"{c}{r.doc_id}" for r in out.collect() for c in INSIDE)
    assert line_dedup.dedup_lines(df).where("n_removed = 1").count() == 11


def test_sketches_merge_and_hold_a_fraction(spark):
    """The sketch of two texts together comes from their sketches; long ones hold about one hash in SCALE, short ones all; estimates are near the truth."""
    rnd = random.Random(8)
    say = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    rows = []
    for n in (0, 3, 5, 30, 67, 68, 100, 400, 3000, 20_000):
        a, b = say(n), say(n // 3)
        rows.append((" ".join(a), " ".join([*a[n // 2 :], *b])))
    df = spark.createDataFrame(rows, "a string, b string")
    for c in "ab":
        df = fingerprint.with_sketch(df, c, f"{c}_sketch")
    df = df.select("*", fingerprint.merged("a_sketch", "b_sketch").alias("both"), fingerprint.likeness("a_sketch", "b_sketch").alias("near"))
    hashes = {}
    many = spark.createDataFrame([(" ".join(w[k : k + 5]),) for r in rows for w in (r[0].split(), r[1].split()) for k in range(max(len(w) - 4, min(len(w), 1)))], "s string").distinct()
    for r in fingerprint.with_sketch(many, "s", "h").collect():
        hashes[r.s] = r.h[0]
    shingles = lambda t: {hashes[" ".join(w[k : k + 5])] for w in [t.split()] for k in range(max(len(w) - 4, min(len(w), 1)))}
    held = lambda s: [h for k, h in enumerate(sorted(s)) if k < fingerprint.LEAST or h < fingerprint.LIMIT]
    for r in df.collect():
        a, b = shingles(r.a), shingles(r.b)
        assert r.a_sketch == held(a) and r.both == held(a | b)
        truth = len(a & b) / min(len(a), len(b)) if a and b else float(a == b)
        assert abs(r.near - truth) <= (1e-9 if len(a) < fingerprint.LEAST else 0.25)
        if len(a) > 2000:
            assert 0.5 < len(r.a_sketch) * fingerprint.SCALE / len(a) < 1.5


def test_next_wants_whole_numbers(spark):
    with pytest.raises(TypeError):
        fingerprint.with_next(spark.createDataFrame([("a", "x")], "doc_id string, text string"))


def test_toxicity_stage_on_odd_rows(spark):
    """Nulls, repeated rows, an empty table, no labels among the documents: nothing clean goes."""
    stage = dict(corpus_pipeline.STAGES)["toxicity"]
    rows = [(10**9, None), (10**9 + 1, ""), (10**9 + 2, "plain words only"), (10**9 + 2, "plain words only"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("own"))
    kept = stage(spark, docs, SF)
    assert kept.columns == docs.columns and sorted((tuple(r)[:2] for r in kept.collect()), key=str) == sorted(rows, key=str)
    assert stage(spark, docs.where("false"), SF).count() == 0


def test_quality_limits_act(spark):
    """Some documents pass the base and repeat five words or more over more than the limit; those go."""
    found = queries.op8_quality_rules(spark, "/root/testdata/sf0.01").where("NOT base_failed")
    gone = found.where("NOT kept")
    assert 0 < gone.count() < 0.05 * found.count()
    assert gone.where(f"covered_chars <= {repetition.MAX_COVERED} * word_chars AND longest_repeat <= {repetition.MAX_REPEAT_WORDS}").count() == 0


def test_texts_over_one_block(spark):
    """A text longer than the blocks that texts are worked on in is measured whole."""
    rnd = random.Random(9)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(180_000)]
    long = " ".join(words)
    assert len(long) > 1 << 20
    docs = spark.createDataFrame([(1, "short text"), (2, long), (3, " ".join(words[:90_000] * 2))], "doc_id long, text string")
    found = {r.doc_id: r for r in repetition.judge(repetition.with_repetition(docs)).collect()}
    assert found[2].n_words == found[3].n_words == 180_000 and found[2].kept and not found[3].kept and found[3].longest_repeat == 90_000
    counted = {r.doc_id: r.n_bytes for r in bpe_count.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).collect()}
    assert counted[2] == len(long)
    assert {r.doc_id: r.n_lines for r in line_dedup.dedup_lines(docs.withColumn("source", F.lit("s"))).collect()} == {1: 1, 2: 1, 3: 1}


# As queries


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_decontamination", "op13_periodic_runs"])
def test_queries_against_brute_force(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = queries.QUERIES[name](spark, SF).collect()
    if name == "op11_source_divergence":
        assert sorted(map(tuple, found)) == brute_audit([(r.lang, r.source, r.text) for r in docs])
    elif name == "op12_decontamination":
        items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
        assert sorted(map(tuple, found), key=str) == brute_contamination([(r.doc_id, r.text) for r in docs], [(r.item_id, r.text) for r in items])
    else:
        wanted = {}
        for r in docs:
            h = zlib.crc32(str(r.doc_id).encode())
            w, text = WORD.findall(r.text or ""), r.text
            if h % 10 == 0 and w:
                a = h // 10 % len(w)
                p = 1 + (len(w) - a) // (3 + h // 10 % 8)
                text = " ".join(w[k] if k < a else w[a + (k - a) % p] for k in range(len(w)))
            wanted[r.doc_id] = brute_row(text)[0]
        assert {r.doc_id: tuple(r)[1:] for r in found} == wanted and any(r[0] for r in wanted.values())
