"""The robust estimates against a plain numpy computation by the same definitions, and against all starts."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import quality

SCHEMA = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, lang string, source string"


def made_rows():
    rng, rows = random.Random(7), []
    for group, size in (("a", 180), ("b", 41), ("c", 7), ("d", 1), (None, 30)):
        for _ in range(size):
            n = int(math.exp(rng.gauss(5.5, 0.6))) + 20
            odd = rng.random() < 0.06
            rows.append((n, n * 5 + rng.randint(-n // 3, n // 3), rng.randint(0, 3) + 900 * odd, 60 * odd, 0, "en" if size > 20 else None, group))
    rows += [(150, 800, 0, 0, 0, "en", "same")] * 20 + [(90, 900, 4, 1, 0, "en", "same")]
    return [(i, *r) for i, r in enumerate(rows)]


ROWS = made_rows()
FLOOR = np.diag((np.array(quality.FLOORS) * quality.SCALE) ** 2)


def vector(row):
    _, n, chars, symbols, lines, repeats, *_ = row
    raw = (math.log1p(n), math.log1p(chars / n), math.log1p(symbols * 100 / n), math.log1p(lines), math.log1p(repeats * 100 / n))
    return [math.floor(v * quality.SCALE + 0.5) for v in raw]


def squared(x, mean, cov):
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)


def upto_half(d2):
    """Documents in the bins up to the one that completes half, and that bin."""
    bins = np.floor(np.log2(d2 + 1e-6) * quality.BINS_PER_UNIT)
    last = np.sort(bins)[(len(bins) + 1) // 2 - 1]
    return bins <= last, last


def moments(x):
    return x.mean(axis=0), np.cov(x.T, bias=True).reshape(5, 5) + FLOOR if len(x) > 1 else FLOOR


def quartile(column, q):
    cells = np.sort(np.floor(column / 20))
    return cells[math.ceil(len(cells) * q) - 1] * 20 + 10


def scale_of(d2):
    return max(1.0, 2 ** ((upto_half(d2)[1] + 1) / quality.BINS_PER_UNIT) / quality.CHI2_MEDIAN)


def brute(x):
    """Distances of a group by reweighted minimum covariance determinant, and the determinants of all starts."""
    mid = np.array([quartile(x[:, i], 0.5) for i in range(5)])
    spread = np.array([(quartile(x[:, i], 0.75) - quartile(x[:, i], 0.25)) / 1.349 for i in range(5)])
    tried = []
    for mean, cov in ((mid, np.diag(spread**2) + FLOOR), (mid, FLOOR), moments(x)):
        for _ in range(quality.STEPS):
            mean, cov = moments(x[upto_half(squared(x, mean, cov))[0]])
        tried.append((np.linalg.slogdet(cov)[1], mean, cov))
    log_det, mean, cov = min(tried, key=lambda t: t[0])
    d2 = squared(x, mean, cov)
    mean, cov = moments(x[d2 <= quality.CHI2_NEAR * scale_of(d2)])
    d2 = squared(x, mean, cov)
    return np.sqrt(d2 / scale_of(d2)), [t[0] for t in tried], cov


def groups():
    found = {}
    for row in ROWS:
        found.setdefault((row[6], row[7]), []).append(row)
    return found


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4)


def test_distances_are_those_of_the_plain_computation(rows):
    found = {r.doc_id: r for r in quality.outliers(rows).collect()}
    for members in groups().values():
        distance, _, _ = brute(np.array([vector(r) for r in members], dtype=float))
        for row, d in zip(members, distance.tolist(), strict=True):
            assert found[row[0]].distance == pytest.approx(d, rel=1e-6, abs=1e-6), row
            assert found[row[0]].kept == (d * d <= quality.CUTOFF)
    odd = [r[0] for r in ROWS if r[4] == 60 and r[7] in ("a", "b")]
    assert odd and not any(found[i].kept for i in odd)


def test_the_least_determinant_is_kept(rows):
    judged = quality._judged(quality.with_base(rows).withColumn("_salt_by", F.col("doc_id")))
    by = [*quality.GROUP, "start"]
    starts = quality._factor(quality._starts(judged), by).collect()
    assert len(starts) == quality.STARTS * len(groups())
    for members in groups().values():
        _, tried, cov = brute(np.array([vector(r) for r in members], dtype=float))
        assert min(tried) <= min(tried[0], tried[1], tried[2]) and np.linalg.slogdet(cov)[0] > 0


def test_columns_and_reports(spark, rows):
    out = quality.outliers(rows)
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance", "lang", "source"]
    assert quality.outliers(rows.limit(0)).collect() == []
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(30 + i)), "en", "s", 1, 2) for i in range(30)], "doc_id int, text string, lang string, source string, scale int, start int")
    (row,) = quality.scatter(docs).collect()
    assert row.floor_symbols == 1.0 and 0 < row.floor_length < 1 and row.scale >= 1
