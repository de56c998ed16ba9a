"""Token counts against the library itself: fuzzed texts, compiled maps, whole tables."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeflow.llm import token_count
from gaugeflow.llm.queries import QUERIES

PATH = token_count.default_tokenizer()
PARTS = ["a", "the", " ", "  ", "\n", "\t", "'", "'s", "'re", "'v", "'ll", "l", "r", "<|endoftext|>", "<|endo", "<", "|>", "é", "ç"]
PARTS += ["1", "23", "²", "!", "?!", "\u0085", " ", "　", "日本", "🙂", "́", "ing", "tion", "A", " Z", "==", "-----", "\r\n"]
PARTS += ["᠎", "aaaa", "xyzzy", "\x00", "�"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def machine():
    return token_count.transducer(PATH)


def made_text(rng, most):
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, most)))


def test_counts_are_the_library_s(library, machine):
    rng = random.Random(3)
    for _ in range(3000):
        text = made_text(rng, 25)
        assert machine.count(text) == library(text), repr(text)
    signs = "abcdefABCDEF0123456789+/"
    long = ["a" * 1000, "ab" * 999, "aaab" * 300, " " * 500, "\n" * 333 + "x", "=" * 401, "".join(rng.choice(signs) for _ in range(5000))]
    for text in long:
        assert machine.count(text) == library(text), text[:30]


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_any_unicode(library, machine, text):
    text = text.encode("utf-8", "ignore").decode()
    assert machine.count(text) == library(text)


def test_maps_compose_in_any_grouping(library, machine):
    rng = random.Random(4)
    for _ in range(400):
        text, size = made_text(rng, 40), rng.randint(1, 9)
        chunks = [text[k : k + size] for k in range(0, len(text), size)]
        maps = [machine.chunk_map(c) for c in chunks]
        before, total = machine.scan(maps)
        assert machine.tokens_of(total) == library(text)
        assert [machine.tokens_of(b) for b in before] == [library(text[: k * size]) for k in range(len(chunks))]
        if len(maps) > 2:
            left = machine.compose(machine.compose(maps[0], maps[1]), maps[2])
            right = machine.compose(maps[0], machine.compose(maps[1], maps[2]))
            assert machine.tokens_of(left) == machine.tokens_of(right)


def test_emptied_tables_give_the_same(library, monkeypatch):
    monkeypatch.setattr(token_count, "TRANSITIONS", 20)
    monkeypatch.setattr(token_count, "CHUNK", 16)
    small, rng = token_count.Transducer(PATH), random.Random(5)
    for _ in range(60):
        text = made_text(rng, 60)
        assert small.count(text) == library(text)


SCHEMA = "doc_id bigint, text string, n_bytes string, key string, copies string, block string, seq string"


def made_rows():
    rng = random.Random(6)
    texts = [None, "", " ", "no", "x" * 700, "word " * 500, "a b" + " " * 300 + "c <|endoftext|>" * 40] + [made_text(rng, 400) for _ in range(20)]
    texts.append("long text of many words, isn't it? " * 30_000)
    rows = list(enumerate(texts)) + [(5, texts[5]), (5, texts[6]), (None, texts[5]), (None, None)]
    return [(i, t, "x", "x", None, "y", "z") for i, t in rows]


@pytest.mark.parametrize("chunk, fan", [(50, 4), (token_count.CHUNK, token_count.FAN)])
def test_whole_table(spark, library, chunk, fan):
    rows = [r for r in made_rows() if chunk > 50 or len(r[1] or "") < 20_000]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = token_count.count_tokens(docs, PATH, limit=100, chunk=chunk, fan=fan)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [(r[0], len((r[1] or "").encode()), library(r[1] or "")) for r in rows]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, found.collect()), key=order) == sorted([(*e, e[2] > 100) for e in expected], key=order)


def test_offsets_of_chunks(spark, library):
    rows = [r for r in made_rows() if r[1] and len(r[1]) < 20_000]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = token_count.chunk_offsets(docs, PATH, chunk=40, fan=3).select("doc_id", "n_bytes", "seq", "tokens_before").collect()
    expected = [(r[0], len(r[1].encode()), k, library(r[1][: 40 * k])) for r in rows for k in range(-(-len(r[1]) // 40))]
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, found), key=order) == sorted(expected, key=order)


def test_empty_table_and_text_ids(spark):
    assert token_count.count_tokens(spark.createDataFrame([], SCHEMA), PATH).collect() == []
    docs = spark.createDataFrame([("k1", "two words")], "doc_id string, text string")
    assert [tuple(r) for r in token_count.count_tokens(docs, PATH).collect()] == [("k1", 9, 2, False)]


def test_registered_query(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op11_token_counts"](spark, sf_dir).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert found == {i: (len(t.encode()), library(t), library(t) > 1024) for i, t in texts.items()}
