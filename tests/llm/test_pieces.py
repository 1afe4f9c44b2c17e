"""The SentencePiece operator on columns of texts against plain Python, and what it costs."""

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import spans, unigram

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile("▁*[^▁]+|▁+")


def plain_words(text):
    return WORD.findall(("▁" + text).replace(" ", "▁")) if text else []


def odd_texts(n, seed=5):
    rnd = random.Random(seed)
    parts = ["the", "information", " ", " ", " ", "  ", "▁", "\n", "\x00", "é", "日本", "😀", "▂", "âx", "x" * 70, "é" * 40, "1", "<s>", "<0x41>"]
    return [None, "", " ", "▁", "  a  ", "▁▁", "a▁", *("".join(rnd.choice(parts) for _ in range(rnd.randrange(20))) for _ in range(n))]


def ids_of(found):
    ids, offsets = found
    return [x.tolist() for x in np.split(ids, offsets[1:-1])]


def test_words_of_columns():
    texts = odd_texts(400)
    for column in (pa.array(texts), pa.array(["x y", *texts, " z"]).slice(1, len(texts)), pa.array(texts, pa.large_string())):
        words, offsets = unigram.words_of(column)
        words = words.to_pylist()
        assert [words[i:j] for i, j in zip(offsets, offsets[1:])] == [plain_words(t) for t in texts]
    for none in ([], [None], ["", None]):
        words, offsets = unigram.words_of(pa.array(none, pa.string()))
        assert len(words) == 0 and offsets.tolist() == [0] * (len(none) + 1)


@pytest.mark.parametrize("remembered, together, held", [(150_000, 20_000, 1 << 24), (40, 7, 1 << 24), (1, 1, 1 << 24), (150_000, 20_000, 500)])
def test_texts_encoded_and_decoded_together(monkeypatch, remembered, together, held):
    monkeypatch.setattr(unigram, "REMEMBERED", remembered)
    monkeypatch.setattr(unigram, "HELD", held)
    monkeypatch.setattr(unigram, "TOGETHER", together)
    own, texts = unigram.codec(PATH).rescored(None), odd_texts(200)
    for i in range(0, len(texts), 50):
        part = texts[i : i + 50]
        found = own.encode_all(pa.array(part))
        assert ids_of(found) == [[p for w in plain_words(t) for p in own.best(w.encode())] for t in part]
        assert own.decode_all(*found).to_pylist() == [(t or "").replace("▁", " ") for t in part]


def test_ids_that_are_no_text_are_decoded_as_alone():
    own, rnd = unigram.codec(PATH), random.Random(6)
    odd = [own.byte_ids[b] for b in (0xE2, 0x96, 0x81, 0xFF, 0x20, 0x41)]
    lists = [[rnd.choice(odd + [0, 1, 2, 500, 900]) for _ in range(rnd.randrange(8))] for _ in range(300)] + [[]]
    offsets = np.cumsum([0, *map(len, lists)])
    assert own.decode_all(np.array(sum(lists, []), np.uint32), offsets).to_pylist() == [own.decode(x) for x in lists]


def test_counts_and_rows_of_documents(spark):
    texts = odd_texts(150)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    own = unigram.codec(PATH)
    counts = Counter(p for t in texts for w in plain_words(t) for p in own.best(w.encode()))
    assert {i: n for i, n in enumerate(unigram.piece_counts(docs, PATH, np.array(own.scores)).tolist()) if n} == counts
    encoded = unigram.encode_documents(docs, PATH)
    rows = {r.doc_id: (r.n_tokens, r.n_bytes_fallen, r.crc) for r in encoded.withColumn("crc", F.crc32("ids")).collect()}
    for i, t in enumerate(texts):
        ids = [p for w in plain_words(t) for p in own.best(w.encode())]
        assert rows[i] == (len(ids), sum(p in own.bytes_of for p in ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    lost = encoded.withColumn("ids", F.expr("if(doc_id % 2 = 0, null, ids)"))
    assert {r.doc_id: r.text for r in unigram.decode_documents(lost, PATH).collect()} == {i: (t or "").replace("▁", " ") if i % 2 else "" for i, t in enumerate(texts)}


@pytest.mark.parametrize("counted, held", [(150_000, 1 << 24), (3, 1 << 24), (150_000, 400)])
def test_counts_do_not_depend_on_bounds(monkeypatch, counted, held):
    monkeypatch.setattr(unigram, "COUNTED", counted)
    monkeypatch.setattr(unigram, "HELD", held)
    monkeypatch.setattr(unigram, "TOGETHER", 50)
    texts, counter = odd_texts(300), unigram.PieceCounter(unigram.codec(PATH))
    for i in range(0, len(texts), 20):
        counter.add(pa.array(texts[i : i + 20]))
    counter.add_up()
    want = Counter(p for t in texts for w in plain_words(t) for p in counter.own.best(w.encode()))
    assert {i: n for i, n in enumerate(counter.counts.tolist()) if n} == want


def test_encoding_costs_little_more_than_finding_words():
    """Encoding and decoding a corpus, against the CPU seconds of a regular expression that finds its words; word by word in Python it was 7 times that or more."""
    column = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").combine_chunks()
    texts = [x or "" for x in column.to_pylist()]
    own, offsets = unigram.codec(PATH), spans.text_bytes(column)[1]
    own.trie  # noqa: B018

    def seconds(run):
        began = time.process_time()
        run()
        return time.process_time() - began

    def encode():
        fresh = own.rescored(None)
        for i, j in spans.blocks(offsets):
            fresh.decode_all(*fresh.encode_all(column.slice(i, j - i)))

    encode()
    assert min(seconds(encode) for _ in range(3)) < 5 * min(seconds(lambda: [plain_words(t) for t in texts]) for _ in range(3))
