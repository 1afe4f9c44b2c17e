import gzip
import io
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyforge.llm import bagminhash, bpe_count, fingerprint, knlm, line_dedup, packing, repetition, spans, toxicity, unigram, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [(1, None, "s1"), (2, "", "s1"), (3, " \n\t ", None), (4, "one two", "s2"), (5, "one two", "s2"), (6, "é 😀 <|endoftext|> x", "s3"), (7, "w " * 5000, "s4"), (8, " ".join(f"w{i}" for i in range(300)), "s5")]


@pytest.fixture(scope="module")
def docs(spark):
    extra = [(*r, 1.0, "x") for r in EDGE]
    return spark.createDataFrame(extra, "doc_id long, text string, source string, score double, n_words string")


@pytest.fixture(scope="module")
def none(spark, docs):
    return docs.where("false")


def test_tokens_and_packing(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    rows = packing.best_fit_pack(packing.tokenize_pieces(docs, path)).collect()
    for i, text, _ in EDGE:
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in mine), "<u4").tolist()
        assert ids == [*own.encode(text or "", add_special_tokens=False).ids, 0]
    for s in {r.sequence_id for r in rows}:
        mine = sorted((r.offset, r.length) for r in rows if r.sequence_id == s)
        assert [o for o, _ in mine] == np.cumsum([0, *(n for _, n in mine)])[:-1].tolist() and sum(n for _, n in mine) <= 2048
    assert packing.best_fit_pack(packing.tokenize_pieces(none, path)).count() == 0


def test_packing_is_best_fit_and_keeps_columns(spark):
    rnd = random.Random(11)
    lengths = [rnd.choice([rnd.randrange(1, 60), rnd.randrange(1, 2049)]) for _ in range(700)]
    df = spark.createDataFrame([(i, n, "x", 1, 2) for i, n in enumerate(lengths)], "id int, length int, rank_from string, offset int, row int").repartition(3)
    found = packing.best_fit_pack(df)
    assert found.columns == ["id", "length", "rank_from", "row", "sequence_id", "offset"]
    rows, rooms = found.collect(), []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 2048) - n)
    assert len({r.sequence_id for r in rows}) == len(rooms) and sorted(r.id for r in rows) == list(range(700))
    for s in {r.sequence_id for r in rows}:
        mine = sorted((r.offset, r.length) for r in rows if r.sequence_id == s)
        assert [o for o, _ in mine] == np.cumsum([0, *(n for _, n in mine)])[:-1].tolist() and sum(n for _, n in mine) <= 2048


def test_token_counts_equal_the_library(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    found = {r.doc_id: (r.n_bytes, r.n_tokens) for r in bpe_count.count_tokens(docs, path).collect()}
    assert found == {i: (len((t or "").encode()), len(own.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in EDGE}
    rnd, counter = random.Random(1), bpe_count.counter(path)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "the", "İ", "Σ", "'s", " ", "\x1c", "\n", "９", "é", "́", "<|endoftext|>", "!!"]) for _ in range(rnd.randrange(15)))
        assert counter.count(text) == len(own.encode(text, add_special_tokens=False).ids), repr(text)
    assert bpe_count.count_tokens(none, path).count() == 0


def test_pieces_round_trip(docs, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = unigram.encode_documents(docs, path)
    assert {r.doc_id: r.text for r in unigram.decode_documents(encoded, path).collect()} == {i: t or "" for i, t, _ in EDGE}
    codec = unigram.codec(path)
    cut = lambda w: max(([*a, w[i:]] for i in range(len(w)) if w[i:] in known for a in ([[]] if i == 0 else [cut(w[:i])]) if a is not None), key=score, default=None)
    known = {p: i for i, p in enumerate(codec.pieces) if i not in codec.bytes_of}
    score = lambda pieces: sum(codec.scores[known[p]] for p in pieces)
    for word in ("▁there", "▁xylo", "▁tion", "▁aab"):
        assert score([codec.pieces[i] for i in np.frombuffer(codec[word], "<u4")]) == score(cut(word))
    assert unigram.encode_documents(none, path).count() == 0


def test_words_cut_side_by_side_as_one_by_one():
    own = unigram.codec(public_tokenizers.path("piece_bpe_32k.model"))
    rnd = random.Random(10)
    words = ["▁" * rnd.randrange(3) + "".join(rnd.choice(["th", "e", "ing", "é", "😀", "日本", "x", "1", "\x01", "the", "ation"]) for _ in range(rnd.randrange(12))) for _ in range(3000)] + ["", "▁" + "ab" * 400]
    found = {w: c for part, ids, many in own.cut(words) for w, c in zip(part, np.split(ids, np.cumsum(many)[:-1]))}
    assert len(found) == len(set(words)) and all(c.tolist() == own.best(w.encode()) for w, c in found.items())
    ids, many = own.cuts([])
    assert len(ids) == 0 and len(many) == 0


def test_scores_of_a_bpe_file_are_log_probabilities(spark, docs, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    codec = unigram.codec(path)
    pieces = lambda own, word: [own.pieces[i] for i in np.frombuffer(own[word], "<u4")]
    texts = ["the information of the people", "the other time", "the information", None] * 20
    scores = unigram.fitted_scores(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path)
    for own in (codec, codec.rescored(scores)):
        assert np.isclose(np.exp(np.array(own.scores)[own.normal]).sum(), 1)
        assert all(pieces(own, w) == [w] for w in ("▁the", "▁information", "▁people"))
    assert np.isclose(scores[codec.pieces.index("▁the")] - scores[codec.pieces.index("▁people")], np.log(80.5 / 20.5))
    encoded = unigram.encode_documents(docs, path, scores=scores)
    assert {r.doc_id: r.text for r in unigram.decode_documents(encoded, path).collect()} == {i: t or "" for i, t, _ in EDGE}
    assert len(unigram.fitted_scores(none, path)) == len(codec.pieces)


def test_repetition_against_brute_force(docs, none):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("abc") * rnd.randint(1, 2) for _ in range(rnd.randrange(60))) for _ in range(200)]
    data, offsets = spans.text_bytes(pa.array(texts))
    found = repetition.measure(data, offsets, 4)
    for k, text in enumerate(texts):
        w = WORD.findall(text)

        def covered(n):
            seen = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
            return {j for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}

        assert found["n_repeat_words"][k] == len(covered(3)) and found["covered_chars"][k] == sum(len(w[i]) for i in covered(4))
        assert found["longest_repeat"][k] == max([n for n in range(1, len(w) + 1) if covered(n)], default=0)
    judged = {r.doc_id: r.kept for r in repetition.judge(repetition.with_repetition(docs)).collect()}
    assert judged == {i: i == 8 for i, _, _ in EDGE}
    assert repetition.judge(repetition.with_repetition(none)).count() == 0


def test_quality_columns_and_both_verdicts(spark):
    """Base columns as by brute force on odd texts; texts that pass the base and fail each rule of the method, and ones near them that stay."""
    w = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    texts = {
        1: w(0, 400), 2: f"{w(0, 20)} {w(100, 160)} {w(0, 20)}", 3: f"{w(0, 9)} {w(100, 200)} {w(0, 9)}", 4: f"{w(0, 4900)} {w(10000, 25100)} {w(0, 4900)}", 5: f"{w(0, 300)} {w(1000, 9000)} {w(0, 300)}",
        6: "a # b\n\na # b\n $% \n $% \nA", 7: "", 8: None, 9: "é" * 7 + " \u2003x\x0by", 10: "one\none\n" * 30,
    }
    found = {r.doc_id: r for r in repetition.judge(repetition.with_repetition(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))).collect()}
    for i, text in texts.items():
        words = WORD.findall(text or "")
        assert found[i].n_words == len(words) and found[i].word_chars == sum(map(len, words))
        assert found[i].n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        assert found[i].n_dup_lines == len(lines) - len(set(lines))
        seen = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        again = {j for k in range(len(words) - 2) if seen[tuple(words[k : k + 3])] > 1 for j in range(k, k + 3)}
        assert found[i].n_repeat_words == len(again)
        assert found[i].base_failed == (len(words) < 50 or 100 * len(again) > 50 * len(words))
    assert {i: r.kept for i, r in found.items() if not r.base_failed} == {1: True, 2: False, 3: True, 4: False, 5: True}


def test_toxicity_learns_misspellings(spark, docs, none):
    rnd = random.Random(3)
    clean = lambda n: " ".join("".join(rnd.choice(["an", "th", "or", "es", "un"]) for _ in range(rnd.randint(1, 4))) for _ in range(n))
    texts = [clean(40) + (" worthless " if i % 3 == 0 else " ") + clean(40) for i in range(400)]
    model = toxicity.fit(texts, np.array([i % 3 == 0 for i in range(400)]), buckets=1 << 14)
    score = toxicity.score_texts(toxicity.WordLogits(model), [clean(100), clean(300) + " worthles " + clean(300), ""])
    assert score[0] < 0.7 < score[1] and score[2] == 0
    found = toxicity.with_score(docs, model).collect()
    assert len(found) == len(EDGE) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.with_score(none, model).count() == 0
    labels = spark.createDataFrame([(1, 1), (8, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    assert {r._id for r in toxicity.training_rows(docs, labels).collect()} <= {8}


def test_lines(spark, docs, none):
    shared = "this very line stands on every single site"
    rows = [(i, f"own {i}\n{shared}\nend", f"s{i % 6}") for i in range(12)]
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_chars=30).collect()}
    assert found[0] == (rows[0][1], 3, 0) and found[7] == ("own 7\nend", 3, 1)
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert found[0] == (rows[0][1], 3, 0) and found[7] == ("own 7", 3, 2)
    few = spark.createDataFrame([r for r in rows if r[2] < "s4"], "doc_id long, text string, source string")
    assert line_dedup.dedup_lines(few).where("n_removed > 0").count() == 0
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()} == {i: t for i, t, _ in EDGE}
    assert line_dedup.dedup_lines(none).count() == 0


def test_pipeline_removes_short_lines_too(spark):
    rows = [(i, f"own {i}\n{'All rights reserved.' if i < 10 else 'Once more.'}\n \nend", f"s{i % 5 if i < 10 else i % 4}") for i in range(18)]
    found = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "").collect()}
    assert found == {0: rows[0][1]} | {i: f"own {i}\n " for i in range(1, 10)} | {i: f"own {i}\nOnce more.\n " for i in range(10, 18)}


def brute_ngram(texts, train, n):
    tokens = [[*WORD.findall((t or "").lower()), None] for t in texts]
    grams = Counter()
    for t, learn in zip(tokens, train):
        padded = [*["<"] * (n - 1), *t]
        grams.update(tuple(padded[k - n + 1 : k + 1]) for k in range(n - 1, len(padded)) if learn)
    counts = {n: grams}
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d, s = {}, {}
    for k in counts:
        of = Counter(counts[k].values())
        d[k] = (0, *knlm.discounts(of[1], of[2], of[3], of[4]))
        s[k] = {}
        for g, c in counts[k].items():
            e = s[k].setdefault(g[:-1], [0, 0, 0, 0])
            e[0] += c
            e[min(c, 3)] += 1

    def p(g):
        below = p(g[1:]) if len(g) > 1 else 1 / (len(counts[1]) + 1)
        e, own, c = s[len(g)].get(g[:-1]), d[len(g)], counts[len(g)][g]
        return below if e is None else max(c - own[min(c, 3)], 0) / e[0] + sum(own[i] * e[i] for i in (1, 2, 3)) / e[0] * below

    return [sum(np.log10(p(tuple([*["<"] * (n - 1), *t][k - n + 1 : k + 1]))) for k in range(n - 1, len(t) + n - 1)) for t in tokens]


def test_language_model(spark, none):
    rnd = random.Random(4)
    texts = [None, "", *(" ".join(rnd.choice("abcdeFG") for _ in range(rnd.randrange(30))) for _ in range(40)), "never seen"]
    train = [i % 4 != 1 and i < 42 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(zip(texts, train))], "doc_id long, text string, train boolean")
    found = {r.doc_id: r.score for r in knlm.score_documents(df, "train").collect()}
    assert np.allclose([found[i] for i in range(len(texts))], brute_ngram(texts, train, 3))
    assert knlm.score_documents(none.withColumn("train", F.lit(True)), "train").count() == 0


def test_language_model_columns_and_stored_model(spark, docs, none):
    """Base columns as by brute force; a stored model scores texts as the run that learned it; odd and repeated rows."""
    rows = [(i, t, i % 5 != 1) for i, t, _ in EDGE] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    found = sorted(knlm.score_documents(df, "train").collect(), key=lambda r: r.doc_id)
    tokens = {i: [*WORD.findall((t or "").lower()), None] for i, t, _ in EDGE}
    counts = Counter(w for i, _, y in rows if y for w in tokens[i])
    n = sum(counts.values())
    for r in found:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert np.isclose(r.base_score, sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (len(counts) + 1))) for w in own))
        assert np.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens))
    assert len(found) == 2 * len(EDGE)
    model = knlm.train_model(df.where("train"))
    again = {r.doc_id: tuple(r) for r in knlm.score_with(docs, model).collect()}
    assert all(np.allclose(again[r.doc_id], tuple(r)) for r in found) and len(again) == len(EDGE)
    assert knlm.score_with(none, model).count() == 0


def test_tiers_change_nothing(spark):
    """Chunks of a few texts and shards of a few n-grams, three senders a task: several tiers give what one gives."""
    rnd = random.Random(9)
    texts = [None, "", *(" ".join(rnd.choice(["a", "a", "b", "c", "d", f"w{rnd.randrange(40)}"]) for _ in range(rnd.randrange(1, 25))) for _ in range(60))]
    df = spark.createDataFrame([(i, t, i % 5 != 1) for i, t in enumerate(texts)], "doc_id long, text string, train boolean")
    sizes = knlm.Sizes(chunk_bytes=40, shard_tokens=50, fan=3)
    route = knlm.Route.between(n := knlm.as_chunks(df, "doc_id", "text", "train", sizes.chunk_bytes).count(), 20, sizes.fan)
    assert n > 27 and route.tiers > 3
    rows = lambda found: {r.doc_id: tuple(r) for r in found.collect()}
    whole, tiered = (rows(knlm.score_documents(df, "train", sizes=s)) for s in (knlm.Sizes(), sizes))
    assert whole.keys() == tiered.keys() and all(np.allclose(whole[i], tiered[i]) for i in whole)
    model = knlm.train_model(df.where("train"), sizes=sizes)
    assert model.shards > 3
    again = rows(knlm.score_with(df.select("doc_id", "text"), model, sizes=sizes))
    assert whole.keys() == again.keys() and all(np.allclose(whole[i], again[i]) for i in whole)


def test_ranges_of_tiers_nest():
    for shards, fan in ((1, 3), (4, 4096), (20, 3), (27, 3), (100, 7)):
        route = knlm.Route.between(40, shards, fan)
        found = [(0, [])]  # ranges of a tier: number, and where it begins
        for tier in range(1, route.tiers + 1):
            cut = []
            for above, begin in found:
                first, edges = route.ranges(tier, above)
                cut += [(first, begin), *((first + i, e) for i, e in enumerate(edges.tolist(), 1))]
            found = cut
        assert [n for n, _ in found] == list(range(shards))
        assert [b or 0 for _, b in found] == [(s << 64) // shards for s in range(shards)]
        assert {route.part(c) for c in (0, (1 << 62) - 1)} == {0, fan ** (route.tiers - 1) - 1}


def test_distinct_and_pack():
    rng = np.random.default_rng(1)
    for values in (rng.integers(0, 1 << 63, 1000).astype(np.uint64), np.array([5, 4, 5, 7, 4, 6] * 50, np.uint64), np.array([3], np.uint64)):
        keys, place = knlm.distinct(values)
        assert (keys == np.unique(values)).all() and (keys[place] == values).all()
        back = knlm.unpack(knlm.pack(values, place, np.zeros(len(values), int)))
        assert (back[0] == values).all() and (back[1] == place).all() and not back[2].any()


def test_archives(spark, tmp_path):
    big = "x" * 1500 + "\r\n\r\nWARC/1.1\r\né"
    rows = [(1, "http://a", big), (2, None, big), (3, "http://c d", "small"), (4, "http://e", "small"), (5, "http://f", None), (6, "http://g", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = f"file://{tmp_path}/archives"
    warc.write_archives(warc.resolve_revisits(pages), path, date="2024-01-01T00:00:00Z", file_records=2)
    read = warc.read_archives(spark, path, payload=True)
    assert {r.page_id: bytes(r.payload).decode() for r in read.where("payload IS NOT NULL").collect()} == {3: "small", 4: "small", 5: "", 6: big}
    found = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.follow_revisits(warc.read_archives(spark, path)).collect()}
    n = len(big.encode())
    assert found == {1: ("revisit", 6, n), 2: ("revisit", 6, n), 3: ("response", None, 5), 4: ("response", None, 5), 5: ("response", None, 0), 6: ("response", None, n)}


def test_archives_of_many_members_and_broken_ones():
    """Archives of one gzip member and of one for each record read alike; a cut or misplaced record is an error."""
    record = lambda body: b"WARC/1.1\r\nWARC-Type: response\r\nX: a: b\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    bodies = [b"", b"a\r\n\r\nWARC/1.1\r\n", b"x" * 300_000]
    for packed in (gzip.compress(b"".join(map(record, bodies))), b"".join(gzip.compress(record(b)) for b in bodies)):
        found = list(warc.parse(gzip.GzipFile(fileobj=io.BytesIO(packed))))
        assert [b for _, b in found] == bodies and found[0][0] == {"warc-type": "response", "x": "a: b", "content-length": "0"}
    assert list(warc.parse(io.BytesIO(b""))) == []
    for broken in (record(b"abc")[:-5], b"\r\n" + record(b"abc"), record(b"abc")[:-2] + record(b"d")):
        with pytest.raises(ValueError):
            list(warc.parse(io.BytesIO(broken)))


def test_fingerprints(docs, none):
    text = F.coalesce("text", F.lit(""))
    found = fingerprint.with_next(fingerprint.with_sketch(docs.select("doc_id", text.alias("text")), "text", "sketch"), carry="sketch")
    rows = {r.doc_id: r for r in found.withColumn("edited", fingerprint.edited(F.col("text"), F.col("next_text"))).withColumn("near", fingerprint.likeness("sketch", "next_sketch")).collect()}
    order = [i for i, _, _ in EDGE]
    for i, follow in zip(order, [*order[1:], order[0]]):
        own, after = rows[i].text, rows[follow].text
        k = len(own) // 4
        assert rows[i].next_text == after and rows[i].edited == own[: len(own) - k] + after[:k]
    assert rows[4].near == 1 and rows[4].sketch == rows[5].sketch and rows[1].near == 1 and rows[7].near == 0
    assert fingerprint.with_next(none.select("doc_id", "text")).count() == 0


def test_fingerprints_of_short_texts(spark):
    rnd = random.Random(7)
    texts = [" ".join(f"w{rnd.randrange(500)}" for _ in range(n)) for n in range(5, 51)]
    found = fingerprint.with_next(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    found = found.withColumn("edited", fingerprint.edited(F.col("text"), F.col("next_text")))
    for c in ("text", "edited"):
        found = fingerprint.with_sketch(found, c, f"{c}_sketch")
    for r in found.withColumn("near", fingerprint.likeness("text_sketch", "edited_sketch")).collect():
        a, b = ({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} for w in (r.text.split(), r.edited.split()))
        assert np.isclose(r.near, len(a & b) / min(len(a), len(b)))


def test_near_duplicates(spark, docs, none):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(60):  # each differs from the one before by a word: a chain
        base = [*base]
        base[rnd.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(base)))
    rows += [(100 + i, " ".join(f"v{rnd.randrange(10**6)}" for _ in range(60))) for i in range(20)] + [(200, rows[3][1]), (201, None), (202, "")]
    found = {r.doc_id: r.class_id for r in bagminhash.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {found[i] for i in range(60)} == {0} and found[200] == 0 and found[202] == found[201] == 201
    assert all(found[100 + i] == 100 + i for i in range(20))
    assert {r.doc_id for r in bagminhash.keep_one(docs).collect()} == {1, 3, 4, 6, 7, 8}
    assert bagminhash.near_duplicate_classes(none).count() == 0


def test_last_round_looks_at_few_pairs(spark):
    """A large class and an outlier in one bucket, three classes in another: all pairs of different classes, and no more than twice as many looked at."""
    rows = [("a", i, 0) for i in range(1999)] + [("a", 5000, 5000)] + [("b", i, i // 2) for i in range(6)]
    classed = spark.createDataFrame(rows, "bucket string, node long, class long")
    classed = classed.withColumn("pivots", F.expr("IF(bucket = 'a', array(named_struct('node', 7L, 'class', 0L)), array(named_struct('node', 2L, 'class', 1L), named_struct('node', 5L, 'class', 2L)))"))
    met = bagminhash._outside_largest(classed).collect()
    wanted = {(i, 5000) for i in range(1999)} | {(i, j) for i in range(6) for j in range(i) if i // 2 != j // 2}
    assert {frozenset((r.node, r.pivot)) for r in met if r["class"] != r.pivot_class} == set(map(frozenset, wanted))
    assert len(met) <= 2 * len(wanted)


def test_near_duplicates_of_edits_near_the_threshold(spark, monkeypatch):
    """Edits of one text on both sides of the threshold, and never few enough pairs to compare at once: classes as by brute force."""
    monkeypatch.setattr(bagminhash, "FEW", 0)
    rnd = random.Random(8)
    base = [f"w{rnd.randrange(50)}" if i % 9 else "same" for i in range(120)]
    texts = []
    for _ in range(70):
        words = list(base)
        for _ in range(rnd.randrange(7)):
            at = rnd.randrange(len(words))
            words[at : at + rnd.randrange(2)] = [f"x{rnd.randrange(10**6)}"] * rnd.randrange(2)
        texts.append(" ".join(words))
    bags = [Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (t.split() for t in texts)]
    near = [{j for j, b in enumerate(bags) if sum((a & b).values()) >= 0.8 * sum((a | b).values())} for a in bags]
    wanted = {}
    for i in range(len(texts)):
        todo = [i]
        while todo:
            if (k := todo.pop()) not in wanted:
                wanted[k] = i
                todo += near[k]
    found = bagminhash.near_duplicate_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in found} == wanted


def test_near_duplicates_of_odd_rows(spark):
    """Rows that share an id but not a text, rows that repeat, null ids, extra columns with names used inside; one row of each class stays."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, 1), (1, "another text altogether", 2), (1, long, 1), (2, long + " end", 3), (None, long, 4), (None, None, 5), (3, None, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node int").withColumn("mark", F.lit("x")).withColumn("class", F.lit(1))
    found = sorted(((r.doc_id, r.class_id) for r in bagminhash.near_duplicate_classes(df).collect()), key=str)
    assert found == sorted([(1, 1), (1, 1), (1, 1), (2, 1), (3, 3), (None, None), (None, None)], key=str)
    kept = bagminhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.node for r in kept.collect())) == [1, 2, 4, 5, 6]


def test_bounds_lose_no_link(spark):
    """Whatever may be linked passes the bounds from a pivot's overlap and from shared members."""
    rnd = random.Random(9)
    base = list(range(100))
    sets = [{*rnd.sample(base, rnd.randrange(70, 101)), *(1000 * rnd.randrange(1, 60) + k for k in range(rnd.randrange(25)))} for _ in range(80)]
    texts = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "node long, units array<long>")
    sizes = {r.node: r for r in bagminhash.shared_sizes(texts).collect()}
    for i, s in enumerate(sets):
        assert sizes[i].size == len(s) and sizes[i].shared == len({x for x in s if any(x in t for j, t in enumerate(sets) if j != i)})
    rows = spark.createDataFrame([("b", i, i, sizes[i].size, sizes[i].shared, len(s & sets[0])) for i, s in enumerate(sets) if i], "bucket string, node long, class long, size int, shared long, common long")
    rows = rows.withColumn("own", F.greatest(F.col("shared") - F.col("common"), F.lit(0)))
    pairs = {frozenset((r.node, r.pivot)) for r in bagminhash._reached_pairs(bagminhash._reached(rows, 0.8), rows, 0.8).collect()}
    links = {frozenset((i, j)) for i in range(1, len(sets)) for j in range(1, i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert links and links <= pairs and len(pairs) < 79 * 78 / 2
    held = {r.node for r in bagminhash.within_reach(rows.select("bucket", "node"), bagminhash.shared_sizes(texts), 0.8).collect()}
    assert {i for p in links for i in p} <= held


def test_signatures_are_unbiased():
    rnd = random.Random(6)
    errors = []
    for _ in range(60):
        a = [str(rnd.randrange(rnd.choice([3, 500]))) for _ in range(rnd.randint(6, 200))] * rnd.randint(1, 3)
        b = ["x" if rnd.random() < 0.05 else w for w in a]
        bags = [Counter(tuple(t[i : i + 5]) for i in range(len(t) - 4)) for t in (a, b)]
        data, offsets = spans.text_bytes(pa.array([" ".join(a), " ".join(b)]))
        s = bagminhash.signatures(*bagminhash.shingle_bags(data, offsets), 2, 1024)
        errors.append((s[0] == s[1]).mean() - sum((bags[0] & bags[1]).values()) / sum((bags[0] | bags[1]).values()))
    assert abs(np.mean(errors)) < 0.006 and np.std(errors) < 0.03


def brute_classes(texts):
    """Class of each text: the first one that links of 0.8 or more lead to."""
    bags = [Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))) for w in (WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t)) for t in texts)]
    near = lambda a, b: texts[a] == texts[b] or sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()) > 0
    found = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if near(i, j) and found[i] != found[j]:
                low, high = sorted((found[i], found[j]))
                found = [low if x == high else x for x in found]
    return found


def test_pipeline_stages(spark):
    """Each stage on nulls, empty texts, repeated rows, ties and an empty table, against brute force where the stage decides by itself."""
    rnd = random.Random(12)
    say = lambda n: " ".join(rnd.choice("abcdefghij") + str(rnd.randrange(300)) for _ in range(n))
    base = say(120)
    footer = "all rights reserved by the owner"
    rows = [(i, f"{say(80)}\n{footer}", "en", f"s{i % 7}") for i in range(30)]
    rows += [(40 + i, base + f" more{i}", "en", "s1") for i in range(4)] + [(50, base, None, None), (50, base, None, None), (60, None, "en", "s1"), (61, "", "en", "s2"), (62, "few words", None, None), (63, " ".join(["again and again"] * 40), "en", "s3")]
    docs = spark.createDataFrame([(i, t, lang, src, len(t or "")) for i, t, lang, src in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, _, _ in rows if i < 60)
    cleaned = {r.doc_id: r.text for r in stages["line_dedup"](spark, docs, "").collect()}
    assert cleaned[0] == rows[0][1] and all(cleaned[i] == rows[i][1].split("\n")[0] for i in range(1, 30)) and cleaned[60] is None and cleaned[61] == ""
    one = stages["near_dedup"](spark, docs, "").collect()
    texts = [t or "" for _, t, _, _ in rows]
    wanted = {rows[c][0] for c in set(brute_classes(texts))}
    assert sorted(r.doc_id for r in one) == sorted(wanted)
    packed = stages["packing"](spark, docs, "")
    assert {r.doc_id for r in packed.collect()} == {i for i, _, _, _ in rows} and packed.where("length > 2048").count() == 0
    for name, stage in corpus_pipeline.STAGES:
        if name != "toxicity":
            assert stage(spark, docs.where("false"), "").count() == 0


def test_whole_pipeline_and_toxicity_query(spark):
    """The pipeline's rows on a given folder: whole documents in gapless sequences; the toxicity query's columns."""
    sf = "/root/testdata/sf0.001"
    pieces = corpus_pipeline.run(spark, sf).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    assert {r.doc_id for r in pieces} <= set(docs) and len(pieces) > 100
    for s in {r.sequence_id for r in pieces}:
        mine = sorted((r.offset, r.length) for r in pieces if r.sequence_id == s)
        assert [o for o, _ in mine] == np.cumsum([0, *(n for _, n in mine)])[:-1].tolist() and sum(n for _, n in mine) <= 2048
    from tallyforge.llm import queries

    scored = queries.op2_toxicity(spark, sf).collect()
    assert sorted(r.doc_id for r in scored) == sorted(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored)
