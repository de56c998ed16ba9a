"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, all other text is unlabelled. Each member of a small ensemble is a
numpy logistic model trained in a task of its own on a bounded sample (``positives`` and ``unlabelled`` rows per
member, picked by a hash of the id, from all rows outside the held-out fold). It minimises

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

where R+ and R- are mean losses of calling a row toxic or clean; when the second term turns negative its
gradient is reversed. ``prior`` is the share of toxic rows among all labelled rows outside the held-out fold.
Features are the words of a text in lower case, and their first four and five letters with the number of different
words that begin so (one, two, three or more), each present or not; a member keeps those found in enough of its
positives and clearly more often than in unlabelled text. The averaged weights, at most ``VOCABULARY`` per member, go
to all tasks, which score every whole text.

Defined results: null and empty texts get the score of a text without features; without any positive the score
is 0 for all; labels of unknown documents, null labels and repeated labels are harmless; every row is scored on
its own text, null or repeated ids included; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import held_out

POSITIVES = 3000
UNLABELLED = 4000
MEMBERS = 3
VOCABULARY = 20_000
LEAST_SHARE, LIFT = 0.015, 4.0  # a feature is in that share of positives, so many times as often as in other text
MAX_FEATURE = 40  # code points of a word that can become a feature
STEPS = 120
RATE = 0.1
DECAY = 2e-4
THRESHOLD = 0.3
TOKEN = re.compile(r"\w+")


def features(text: str | None) -> set[str]:
    """Words, and beginnings of four and five letters that one, two or three different words have."""
    found = {w for w in TOKEN.findall((text or "").lower()) if len(w) <= MAX_FEATURE}
    begun = Counter(w[:4] for w in found if len(w) > 4)
    begun.update(w[:5] for w in found if len(w) > 5)
    for p, n in begun.items():
        found.update(f"{p}+{k}" for k in range(1, min(n, 3) + 1))
    return found


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def nnpu(rows: list[np.ndarray], positive: np.ndarray, size: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of one member; ``rows`` hold the feature numbers of each text."""
    index = np.concatenate([np.append(r, size) for r in rows]).astype(np.int64)  # the last feature is the bias
    lengths = np.array([len(r) + 1 for r in rows])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    p, u = positive, ~positive
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[size] = math.log(prior / (1 - prior))
    for step in range(1, STEPS + 1):
        s = np.add.reduceat(w[index], starts)
        up, down = sigmoid(s) - 1, sigmoid(s)  # slopes of the losses of calling a row toxic, clean
        clean = np.logaddexp(0, s)
        risk = clean[u].mean() - prior * clean[p].mean()
        slope = np.where(u, down / u.sum(), -prior * down / p.sum())
        slope = slope + np.where(p, prior * up / p.sum(), 0) if risk >= 0 else -slope
        g = np.bincount(index, weights=np.repeat(slope, lengths), minlength=size + 1)
        g[:size] += DECAY * w[:size]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:size], float(w[size])


def _member(table: pa.Table, prior: float) -> pa.Table:
    number = table.column("member")[0].as_py()
    positive = np.array(table.column("positive").to_pylist(), dtype=bool)
    sets = [features(t) for t in table.column("text").to_pylist()]
    out = {"member": [], "feature": [], "weight": []}
    if positive.any() and not positive.all():
        seen = Counter(f for s, y in zip(sets, positive, strict=True) if y for f in s)
        usual = Counter(f for s, y in zip(sets, positive, strict=True) if not y for f in s if f in seen)
        n, m = int(positive.sum()), int((~positive).sum())
        telling = [f for f, k in seen.items() if k >= max(3, LEAST_SHARE * n) and k * m >= LIFT * n * usual[f]]
        vocabulary = sorted(telling, key=lambda f: (-seen[f], f))[:VOCABULARY]
        at = {f: i for i, f in enumerate(vocabulary)}
        rows = [np.array(sorted(at[f] for f in s if f in at), dtype=np.int64) for s in sets]
        w, bias = nnpu(rows, positive, len(vocabulary), prior)
        kept = [(f, float(x)) for f, x in zip(vocabulary, w, strict=True) if abs(x) > 1e-3]
        out = {"member": [number] * (len(kept) + 1), "feature": [f for f, _ in kept] + [""], "weight": [x for _, x in kept] + [bias]}
    return pa.table(out, schema=pa.schema([("member", pa.int32()), ("feature", pa.string()), ("weight", pa.float64())]))


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> dict[str, float]:
    """Averaged weights by feature; the bias under the empty string. Empty without positives."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    toxic = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    row = toxic.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("p")).first()
    if not row["p"]:
        return {}
    share = min(0.9, max(1e-4, row["p"] / row["n"])) if prior is None else prior
    pool = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text")
    rows = pool.select("doc_id").count()
    draw = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 24)) / float(1 << 24)
    picked = toxic.filter((F.col("toxic") == 1) & (draw(1) < POSITIVES / row["p"])).select(F.col("doc_id").alias("_p"))
    everyone = F.explode(F.sequence(F.lit(0), F.lit(MEMBERS - 1)))
    # picked holds about POSITIVES ids whatever the size of the input
    confirmed = pool.join(F.broadcast(picked), F.col("doc_id") == F.col("_p")).select("text", F.lit(True).alias("positive"), everyone.alias("member"))
    dealt = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(MEMBERS)).cast("int")
    other = pool.filter(draw(2) < MEMBERS * UNLABELLED / max(1, rows)).select("text", F.lit(False).alias("positive"), dealt.alias("member"))
    sample = confirmed.unionByName(other)
    found = sample.groupBy("member").applyInArrow(
        lambda table: _member(table, share), "member int, feature string, weight double"
    )
    weights: Counter = Counter()
    members = set()
    for r in found.collect():  # at most MEMBERS * (VOCABULARY + 1) rows
        weights[r["feature"]] += r["weight"]
        members.add(r["member"])
    return {f: x / len(members) for f, x in weights.items()} if members else {}


def score(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        bias, names = w.get("", -60.0), w.keys()
        for batch in batches:
            sums = [bias + sum(w[f] for f in sorted(names & (features(t) - {""}))) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(sigmoid(np.array(sums, dtype=float)))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    weights = train(docs, labels, prior)
    scored = score(docs, weights)
    if not weights:
        scored = scored.withColumn("score", F.lit(0.0))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
