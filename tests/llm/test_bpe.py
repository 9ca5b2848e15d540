import random

import numpy as np
import pytest
from helpers import documents, table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from obsledger.llm.bpe import Bpe, decode, default_vocabulary, encode, text_groups

ODD = [
    "", " ", None, "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "aaa" * 50, "abc" * 3000, " " * 2000,
    "\n\n\t \r\n x", "日本語テキスト", "é" * 700, "\x00\x01", "𝒳😀👩‍👩‍👧", "it's I'LL we've 's", "=" * 5000, "ſ K ١٢٣ ²½ⅷ",
    "\u0085\x1c x​", "à",
]


def mixed(seed):
    r = random.Random(seed)
    ranges = [(32, 127), (0xA0, 0x3000), (0x10000, 0x1F000)]
    return "".join(chr(r.randrange(*r.choice(ranges))) for _ in range(300)).encode("utf-8", "ignore").decode()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def test_ids_and_texts_like_the_library(spark, library):
    letters = "".join(random.Random(3).choice("abcdefghij") for _ in range(20_000))
    texts = ODD + [letters] + [mixed(i) for i in range(60)] + table("documents").text.tolist()
    docs = documents(spark, list(enumerate(texts))).withColumn("n_tokens", F.lit("old"))
    got = decode(encode(docs)).orderBy("doc_id").collect()
    assert len(got) == len(texts)
    for row, text in zip(got, texts, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(row.token_ids), "<u4").tolist() == ids and row.n_tokens == len(ids)
        assert row.decoded == library.decode(ids, skip_special_tokens=False) == (text or "")


def test_heap_and_rounds_agree():
    bpe = Bpe(default_vocabulary())
    words = [mixed(i).replace(" ", "")[:80].encode() for i in range(80)] + [b"a" * n for n in range(1, 40)]
    assert bpe.merge(words) == [bpe.merge_long(w) for w in words]


def test_words_around_the_bound_of_the_heap(library, monkeypatch):
    r = random.Random(8)
    words = ["".join(r.choice("abcdefghij") for _ in range(n)) for n in (510, 511, 512, 513, 514)] + ["a" * 511, "a" * 512]
    expected = [library.encode(w, add_special_tokens=False).ids for w in words]
    found = Bpe(default_vocabulary())
    data = [w.encode() for w in words]
    assert [np.frombuffer(x, "<u4").tolist() for x in found.merge(data)] == expected
    assert [np.frombuffer(found.merge_long(w), "<u4").tolist() for w in data] == expected
    monkeypatch.setattr("obsledger.llm.bpe.LONG_WORD", 1 << 20)
    assert [np.frombuffer(x, "<u4").tolist() for x in found.merge(data)] == expected


def test_broken_bytes_and_empty_tables(spark, library):
    rows = [(1, bytearray(np.array([162, 50256, 39000], "<u4").tobytes())), (2, None)]
    out = {r.i: r.decoded for r in decode(spark.createDataFrame(rows, "i int, token_ids binary")).collect()}
    assert out == {1: library.decode([162, 50256, 39000], skip_special_tokens=False), 2: ""}
    assert decode(encode(documents(spark, []))).count() == 0


def test_kept_words_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr("obsledger.llm.bpe.CACHED_BYTES", 500)
    bpe, r = Bpe(default_vocabulary()), random.Random(2)
    word = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    for _ in range(30):
        texts = [word(n) for n in (5, 40, 64, 65, 5000)]
        bpe.encode_batch(texts)
        assert max(map(len, bpe.known)) <= 64 and bpe.known_bytes == sum(map(len, bpe.known)) <= 500 + 200
    assert bpe.encode_batch(["same same " + "z" * 100] * 2)[0] == Bpe(default_vocabulary()).encode_batch(["same same " + "z" * 100])[0]


def test_groups_keep_the_order(monkeypatch):
    monkeypatch.setattr("obsledger.llm.bpe.GROUP_CHARS", 10)
    texts = ["", "abc", "x" * 30, "", "12345678", "90", "z"]
    groups = list(text_groups(texts))
    assert sum(groups, []) == texts and len(groups) == 4 and list(text_groups([])) == []
