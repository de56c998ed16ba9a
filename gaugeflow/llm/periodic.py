"""Runs of periodically repeated words, found by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at least
max(``SHORTEST``, ``REPEATS`` * q) words that no neighbouring word extends keeping period q.

Splitting. Each word of a run occurs at least ``REPEATS`` times in it. So words that occur less often within the
present segment are in no run of it; they split the segment, and the parts are counted and split again until
nothing is rare. The counts of a part with more than half of the words are those of its parent less the rest, so
each word is counted anew at most log2(n) times. Ordinary prose falls apart in a few rounds.

Lag scan. A run of period q that long holds ``REPEATS`` consecutive multiples of q, counted from the segment's
first word, with equal words. For each lag q only the words at those anchors are compared (m / q of m words, about
m ln m in all); where enough neighbours agree, the stretch around them is extended to both sides. Lags rise, so a
stretch already found has a smaller period, and anchors inside a run whose period divides the lag are passed over.

Defined results: null text has no words; a null id counts as empty text where an id is hashed; equal rows are
reported each; an empty table gives an empty result; other columns are ignored. A text is handled whole in the
task that reads it, nothing is shuffled.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORTEST = 6
REPEATS = 4
KEPT = re.compile(rb"\x01{%d,}" % SHORTEST)
NEAR = 8  # words behind an anchor that are compared before a stretch is extended

Run = tuple[int, int, int]  # start, length, period


def _cut_everywhere(words: list, lo: int, hi: int, rare: set) -> list[tuple[int, int]]:
    flags = bytes([w not in rare for w in words[lo:hi]])
    return [(lo + m.start(), lo + m.end()) for m in KEPT.finditer(flags)]


def _cut_at(places: list[int], lo: int, hi: int) -> list[tuple[int, int]]:
    borders = [lo - 1, *places, hi]
    return [(a + 1, b) for a, b in zip(borders, borders[1:], strict=False) if b - a - 1 >= SHORTEST]


def segments(words: list) -> list[tuple[int, int]]:
    """Stretches [from, to) in which every word occurs at least ``REPEATS`` times, in order; no run leaves them."""
    stable, where = [], None
    work = [(0, len(words), Counter(words), None)] if len(words) >= SHORTEST else []
    while work:
        lo, hi, counts, lowered = work.pop()
        rare = {w for w in (counts if lowered is None else lowered) if 0 < counts[w] < REPEATS}
        if not rare:
            stable.append((lo, hi))
            continue
        if lowered is None:
            parts = _cut_everywhere(words, lo, hi, rare)
        else:
            if where is None:
                where = defaultdict(list)
                for place, word in enumerate(words):
                    where[word].append(place)
            parts = _cut_at(sorted(p for w in rare for p in where[w][bisect_left(where[w], lo) : bisect_left(where[w], hi)]), lo, hi)
        largest = max(parts, key=lambda p: p[1] - p[0], default=None)
        for a, b in parts:
            if (a, b) == largest and 2 * (b - a) > hi - lo:
                rest = words[lo:a] + words[b:hi]
                counts.subtract(rest)
                work.append((a, b, counts, set(rest)))
            else:
                work.append((a, b, Counter(words[a:b]), None))
    return sorted(stable)


def _same(ids: np.ndarray, i: int, lag: int, step: int) -> int:
    """How many words from ``i`` on, going by ``step`` (1 or -1), equal the word ``lag`` later."""
    total, block = 0, 32
    while True:
        if step > 0:
            a, b = ids[i : i + block], ids[i + lag : i + lag + block]
            a = a[: len(b)]
        else:
            lo = max(0, i - block + 1)
            a, b = ids[lo : i + 1][::-1], ids[lo + lag : i + lag + 1][::-1]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return total + int(differ[0])
        total += len(a)
        if len(a) < block:
            return total
        i += step * block
        block *= 2


def lag_scan(ids: np.ndarray) -> list[Run]:
    """All runs of a segment of word numbers."""
    n, found, seen = len(ids), [], set()
    owner = np.full(n, -1)  # a run over each word, if any
    for lag in range(1, n // REPEATS + 1):
        anchors = ids[::lag]
        equal = anchors[1:] == anchors[:-1]
        firsts = equal[: 1 - (REPEATS - 1) or None].copy()
        for k in range(1, REPEATS - 1):
            firsts &= equal[k : len(firsts) + k]
        places = np.flatnonzero(firsts) * lag
        for near in range(1, min(NEAR, lag)):
            if not len(places):
                break
            places = places[ids[places + near] == ids[places + near + lag]]
        passed = -1  # no stretch of this lag that is still to be found begins before
        for place in places.tolist():
            if place + (REPEATS - 1) * lag < passed:
                continue
            if owner[place] >= 0:
                start, length, period = found[owner[place]]
                if lag % period == 0 and place + (REPEATS - 1) * lag < start + length:
                    passed = start + length
                    continue
            forward = _same(ids, place, lag, 1)
            if forward <= (REPEATS - 2) * lag:
                continue
            start = place - (_same(ids, place - 1, lag, -1) if place else 0)
            length = place + forward + lag - start
            passed = start + length
            if length >= max(SHORTEST, REPEATS * lag) and (start, length) not in seen:
                seen.add((start, length))
                part = owner[start : start + length]
                part[part < 0] = len(found)
                found.append((start, length, lag))
    return found


def find_runs(words: list) -> list[Run]:
    """All runs, by start, then period."""
    found = []
    for lo, hi in segments(words):
        numbers: dict = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words[lo:hi]], dtype=np.int64)
        found += [(lo + start, length, period) for start, length, period in lag_scan(ids)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[Run]) -> list:
    """The words without those of any run after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def planted(doc_id, words: list) -> list:
    """Every tenth document with the end of its text replaced by a repetition, by a hash of its id."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block, length = words[a : a + p], n - a
    return words[:a] + (block * (length // p + 1))[:length]


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def scan(docs: DataFrame, alter: Callable | None = None) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed (kept words joined by one space) of every row.

    ``alter`` may change the words of a document, given its id, before they are looked at.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    fields = [pa.field(f, pa.int64()) for f in ("start", "length", "period")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, offsets, flat, texts = [], [0], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = text.as_py().split()  # of bytes: white space is that of ASCII
                if alter:
                    words = alter(doc_id, words)
                runs = find_runs(words)
                flat += runs
                counts.append(len(words))
                offsets.append(len(flat))
                texts.append(b" ".join(collapse(words, runs)))
            columns = [pa.array(list(c), pa.int64()) for c in zip(*flat, strict=True)] or [pa.array([], pa.int64())] * 3
            runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=fields))
            arrays = [batch.column(0), pa.array(counts, pa.int64()), runs, pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def digest(found: DataFrame) -> DataFrame:
    """Per row of ``scan``: number of runs, the longest one (ties: first, then shortest period) and checksums."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    one = found.withColumn("best", best)
    return one.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
