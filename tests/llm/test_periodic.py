"""Periodic runs against a plain search over all lags, and the digest against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from gaugeflow.llm import periodic
from gaugeflow.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    n, found, seen = len(words), [], set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and (i, length) not in seen:
                seen.add((i, length))  # met at a smaller lag: that is the smallest period
                smaller = any(all(words[x] == words[x + r] for x in range(i, i + length - r)) for r in range(1, q))
                assert not smaller
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_words(rng, most):
    size, n, words = rng.choice([1, 2, 3, 5, 30]), rng.randint(0, most), []
    while len(words) < n:
        if rng.random() < 0.5:
            words.append(f"w{rng.randrange(size)}é")
        else:
            block = [f"w{rng.randrange(size)}é" for _ in range(rng.randint(1, 7))]
            words += (block * rng.randint(1, 9))[: rng.randint(1, 50)]
    return words


def test_runs_are_those_of_the_plain_search():
    rng = random.Random(2)
    for _ in range(3000):
        words = made_words(rng, 60)
        assert periodic.find_runs(words) == brute(words), words
    words = made_words(rng, 2500)
    assert periodic.find_runs(words) == brute(words)


@pytest.mark.parametrize(
    "words, expected",
    [
        (["a"] * 20_000, [(0, 20_000, 1)]),
        (["a", "b"] * 50_000, [(0, 100_000, 2)]),
        ([str(i) for i in range(5_000)] * 8, [(0, 40_000, 5_000)]),
        (["a"] * 5, []),
        (["a", "b"] * 4, [(0, 8, 2)]),
        (["a", "b"] * 3 + ["a"], []),
    ],
)
def test_long_and_least_runs(words, expected):
    assert periodic.find_runs(words) == expected


def test_segments_keep_every_run_and_are_stable():
    rng = random.Random(9)
    for _ in range(300):
        words = made_words(rng, 200)
        parts = periodic.segments(words)
        for lo, hi in parts:
            assert all(words[lo:hi].count(w) >= periodic.REPEATS for w in set(words[lo:hi]))
        for start, length, _ in brute(words):
            assert any(lo <= start and start + length <= hi for lo, hi in parts)


def expected_row(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4), *digests, len(words))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words"]


def test_table_with_nulls_repeats_and_clashing_names(spark):
    rng = random.Random(4)
    rows = [(i, " \n".join(made_words(rng, 150))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \t "), (203, "go " * 3000), (None, "to and fro " * 9), (None, None), rows[3], rows[3]]
    schema = "doc_id bigint, text string, runs string, start string, best string, collapsed string, n_words string"
    docs = spark.createDataFrame([(*r, "x", "y", None, "z", "0") for r in rows], schema).repartition(3)
    found = periodic.digest(periodic.scan(docs, periodic.planted))
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([expected_row(*r) for r in rows], key=repr)
    assert periodic.digest(periodic.scan(docs.limit(0), periodic.planted)).collect() == []


def test_scan_gives_spans_and_text(spark):
    docs = spark.createDataFrame([("k", "see " + "a b " * 5 + "end")], "doc_id string, text string")
    (row,) = periodic.scan(docs).collect()
    assert (row.doc_id, row.n_words, [tuple(r) for r in row.runs], row.collapsed) == ("k", 12, [(1, 10, 2)], "see a b end")


def test_registered_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = QUERIES["op12_periodic_runs"](spark, sf_dir)
    assert found.columns == COLUMNS
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, found.collect())) == sorted(expected_row(*r) for r in rows)
