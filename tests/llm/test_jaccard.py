"""Near-copy components where postings are long: copies of a hub, chains without one, groups just below the bound."""

from __future__ import annotations

import random

import numpy as np
import pytest

from gaugeflow.llm import jaccard
from gaugeflow.session import tune

SCHEMA = "doc_id bigint, text string, node string, n string, room string, token string"


def made_rows():
    rng, rows = random.Random(12), []
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    fresh = lambda n: [word() for _ in range(n)]

    def edited(words, places):
        words = list(words)
        for at in rng.sample(range(len(words)), places):
            words[at] = word()
        return words

    hub = fresh(220)
    rows += [hub] + [edited(hub, 4) for _ in range(40)]  # near the hub, hardly near each other
    below = fresh(200)
    rows += [below] + [edited(below, 12) for _ in range(30)]  # most too far from everything
    chain = fresh(160)
    for _ in range(40):  # each near the one before; the ends share nothing
        chain = chain[6:] + fresh(6)
        rows.append(chain)
    passage = fresh(60)
    rows += [fresh(rng.randint(2, 14)) + passage for _ in range(30)]  # nearly all of the text is common
    rows += [fresh(rng.randint(200, 300)) + passage for _ in range(30)]
    rows += [passage[:k] for k in range(30, 60)]  # sizes that just reach each other
    rows += [fresh(rng.randint(1, 40)) for _ in range(20)]
    rows += [rows[0]] * 30
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


ROWS = made_rows()


def shingle_set(text):
    words = text.split()
    return set(zip(*(words[k:] for k in range(5)), strict=False)) if len(words) >= 5 else {tuple(words)}


def brute():
    sets, root = [shingle_set(t) for _, t in ROWS], list(range(len(ROWS)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ROWS)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [(i, len(sets[i]), find(i)) for i in range(len(ROWS))]


@pytest.fixture(scope="module")
def docs(spark):
    return tune(spark).createDataFrame([(*r, "x", "y", None, "z") for r in ROWS], SCHEMA).repartition(3)


@pytest.mark.parametrize("small, cell_pairs, filter_bits", [(8, 512, 1 << 25), (2, 3, 64)])
def test_all_components(docs, monkeypatch, small, cell_pairs, filter_bits):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "CELL_PAIRS", cell_pairs)
    monkeypatch.setattr(jaccard, "FILTER_BITS", filter_bits)
    assert sorted(map(tuple, jaccard.components(docs).collect())) == brute()


def test_left_over_sets_find_links_the_hubs_miss(docs, monkeypatch):
    """With postings of more than two sets all long, the chain is joined only by the last round."""
    monkeypatch.setattr(jaccard, "SMALL", 2)
    asked = []
    links = jaccard._Verifier.links

    def counted(self, pairs):
        out = links(self, pairs)
        asked.append((pairs.distinct().count(), out.count()))
        return out

    monkeypatch.setattr(jaccard._Verifier, "links", counted)
    found = jaccard.classes(docs.select("doc_id", "text"))
    jaccard.links(docs.select("doc_id", "text"), found)
    assert len(asked) == 2 and asked[1][1] > 0
    sets = len({frozenset(shingle_set(t)) for _, t in ROWS})
    assert sum(n for n, _ in asked) < sets * 40  # far from all pairs


def test_common_counts_shared_members():
    rng = np.random.default_rng(5)
    for _ in range(50):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(1, 40), dtype=np.uint64)) for _ in range(2))
        assert jaccard._common(x, y) == len(np.intersect1d(x, y))


def test_exploded_entries_are_not_broadcast(spark, tmp_path):
    """Entries of long postings become a row per band and salt, far more than the files Spark sizes them by."""
    nodes = [(7, node, 1000, 1000 - node % 200, (1, 1000, 1000)) for node in range(1, 41)]
    kind = "token int, node bigint, n int, room int, hub struct<node:bigint,n:int,room:int>"
    spark.createDataFrame(nodes, kind).drop("hub").write.parquet(f"{tmp_path}/long")
    long = spark.read.parquet(f"{tmp_path}/long")
    done = spark.createDataFrame([(1, node) for node in range(2, 21)], "a bigint, b bigint")
    pairs = jaccard._left_over(long, done)
    joins = [line for line in pairs._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [token" in line]
    assert len(joins) == 2 and all("SortMergeJoin" in line for line in joins)
    room = {node: 1000 - node % 200 for node in range(1, 41)}
    root = {node: 1 if node <= 20 else node for node in range(1, 41)}
    want = {(a, b) for a in room for b in room if a < b and root[a] != root[b] and min(room[a], room[b]) * 180 >= 80 * 2000}
    assert {tuple(r) for r in pairs.collect()} == want and want
