"""Ranked search against a plain scoring of every document, with windows and shards forced small."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gaugeflow.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, top):
    docs = [(i, Counter(split(t))) for i, t in rows if split(t)]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in sorted({x for x in items if x[1] is not None}, key=repr):
        scored = []
        for doc_id, counts in docs:
            n = sum(counts.values())
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = 0
            for term in set(split(text)) & counts.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * ((1_000_000_000 * counts[term]) // (1000 * counts[term] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id, score))
        out += [(item, rank, s[3], s[4]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:top], 1)]
    return out


def made_rows(rng, n=400):
    vocabulary = [f"W{k}é" if k % 3 else f"w{k}" for k in range(300)]
    pick = lambda: vocabulary[min(rng.randrange(300), rng.randrange(300), rng.randrange(300))]
    rows = [(i, rng.choice([" ", ", ", "\n", "-"]).join(pick() for _ in range(rng.randint(1, 60)))) for i in range(n)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]  # equal scores
    rows += [(2000, None), (2001, ""), (2002, " .,; "), (2003, "w0 " * 4000), (None, rows[3][1]), rows[5], rows[5]]
    items = [(i, " ".join(pick() for _ in range(rng.randint(1, 12)))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "unknown words"), (53, rows[2][1]), (53, rows[2][1]), (53, "w1 W1É w1"), (None, "w3 w6")]
    return rows, items


SCHEMA = "doc_id bigint, text string, n string, terms string, score string, query string, item_id string"


@pytest.mark.parametrize("postings, window, block", [(300, 16, 7), (search.POSTINGS, search.WINDOW, search.QUERIES)])
def test_all_results_of_the_plain_scoring(spark, monkeypatch, postings, window, block):
    monkeypatch.setattr(search, "POSTINGS", postings)
    monkeypatch.setattr(search, "WINDOW", window)
    rows, items = made_rows(random.Random(8))
    docs = spark.createDataFrame([(*r, "x", "y", "z", None, "0") for r in rows], SCHEMA).repartition(3)
    asked = spark.createDataFrame([(*i, 1, "q") for i in items], "item_id bigint, text string, rank int, query string")
    found = search.search(docs, asked, top=10, block=block)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    expected = brute(rows, items, 10)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_skipping_loses_nothing():
    """Many shards and windows of random lists; ``Best`` must hold the highest sums."""
    rng = np.random.default_rng(3)
    for trial in range(150):
        n_rows, n_terms = int(rng.integers(1, 400)), int(rng.integers(1, 12))
        search_window, search.WINDOW = search.WINDOW, int(rng.integers(1, 64))
        try:
            dense = rng.integers(1, 50, (n_terms, n_rows)) * (rng.random((n_terms, n_rows)) < rng.random((n_terms, 1)))
            term, row = np.nonzero(dense)
            shuffled = np.lexsort((term, row))
            index = search.Lists(term[shuffled], row[shuffled], dense[term, row][shuffled], n_terms, n_rows)
            best, order = search.Best(10), np.arange(n_rows)
            search.search_shard(index, list(range(n_terms)), best, order, 0)
        finally:
            search.WINDOW = search_window
        sums = dense.sum(axis=0)
        expected = [(-s, i) for i, s in enumerate(sums.tolist()) if s > 0]
        assert [(-s, r) for s, r in zip(best.scores.tolist(), best.rows.tolist(), strict=True)] == sorted(expected)[:10], trial


def test_empty_tables_and_text_ids(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert search.search(spark.createDataFrame([], SCHEMA), items).collect() == []
    docs = spark.createDataFrame([("k2", "A b"), ("k1", "a B"), ("k3", "c")], "doc_id string, text string")
    assert search.search(docs, items.limit(0)).collect() == []
    assert [(r.rank, r.doc_id) for r in search.search(docs, items).collect()] == [(1, "k1"), (2, "k2")]
