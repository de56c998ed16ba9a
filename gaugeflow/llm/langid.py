"""Language by multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything else counts as a blank; every run of one to ``LONGEST`` characters falls in
one of ``BUCKETS`` buckets. Counts per language come from a bounded sample (about ``per_language`` documents of
each, picked by a hash of the id, outside the held-out fold) and are summed by Spark. The matrix of
log-probabilities, BUCKETS x languages, is broadcast; tasks score batches of whole texts by gathering its entries
for all n-grams of a batch and summing them per text.

Defined results: null text, and text without a letter, is ``und`` with score 0; rows without a language teach
nothing but are scored; without any labelled row all is ``und``; null or repeated ids are rows like others; an
empty table gives an empty result; other columns are ignored. Ties go to the language first in code point order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from gaugeflow.llm.common import held_out, packed, unpacked

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
LONGEST = 3
PER_LANGUAGE = 1500
SMOOTHING = 0.5
MAX_LANGUAGES = 1000  # the matrix that is broadcast has at most so many rows
BATCH_CHARS = 1 << 20
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def codes(text: str | None) -> np.ndarray:
    """Code points between two blanks; what is no letter is a blank."""
    raw = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(letters()[raw], raw, np.uint32(32))


def buckets(code: np.ndarray) -> list[np.ndarray]:
    """For each length the bucket of the n-gram that starts at each position."""
    c, out, total = code.astype(np.uint64), [], np.uint64(0)
    for n in range(LONGEST):
        part = c[n:] * FACTORS[n]
        total = part if n == 0 else total[: len(part)] + part
        mixed = total ^ (total >> np.uint64(31))
        out.append(((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            for b in buckets(codes(text)):
                own += np.bincount(b, minlength=BUCKETS)
    for lang, own in sums.items():
        at = np.flatnonzero(own)
        yield pa.record_batch([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(own[at])], ["lang", "bucket", "n"])


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages in order and their matrix of log-probabilities."""
    pool = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = pool.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return [], np.zeros((0, BUCKETS), dtype=np.float32)
    # One rate per language: the sample is drawn where the texts are read, none of them is shuffled.
    rates = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], per_language / r["n"])])
    share = F.pmod(F.xxhash64(F.lit(4), "doc_id", F.length("text")), F.lit(1 << 24)) / float(1 << 24)
    sample = pool.filter(share < F.element_at(rates, F.col("lang")))
    counts = sample.select("lang", "text").mapInArrow(_counts, "lang string, bucket int, n bigint")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
    rows = sorted(packed.collect(), key=lambda r: r["lang"])  # one row a language, at most BUCKETS pairs each
    logs = np.zeros((len(rows), BUCKETS))
    for i, r in enumerate(rows):
        logs[i, r["b"]] = r["n"]
    logs = np.log(logs + SMOOTHING) - np.log(logs.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return [r["lang"] for r in rows], logs.astype(np.float32)


def score_batch(texts: list[str | None], logs: np.ndarray) -> np.ndarray:
    """Log-likelihood of each text under each language; a row of NaN where there is no letter."""
    out = np.full((len(texts), len(logs)), np.nan)
    first = 0
    while first < len(texts):
        parts, ids, size = [], [], 0
        while first < len(texts) and (size < BATCH_CHARS or not parts):
            code = codes(texts[first])
            if (code != 32).any():
                parts.append(np.concatenate(buckets(code)))
                ids.append(first)
                size += len(code)
            first += 1
        if parts:
            flat, starts = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
            for k in range(len(logs)):
                out[ids, k] = np.add.reduceat(logs[k][flat], starts, dtype=np.float64)
    return out


def predict(docs: DataFrame, languages: list[str], logs: np.ndarray) -> DataFrame:
    """``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast((languages, logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            like = score_batch(texts, table)
            best, top = ["und"] * len(texts), np.zeros(len(texts))
            if len(names):
                some = ~np.isnan(like[:, 0])
                part = like[some] - like[some].max(axis=1, keepdims=True)
                chance = np.exp(part)
                chance /= chance.sum(axis=1, keepdims=True)
                for row, k, p in zip(np.flatnonzero(some), chance.argmax(axis=1), chance.max(axis=1), strict=True):
                    best[row], top[row] = names[k], p
            columns = [*batch.columns, pa.array(best), pa.array(top)]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    n = len(docs.columns)
    own = [StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)]
    out = docs.mapInArrow(run, StructType([*own, StructField(f"c{n}", StringType()), StructField(f"c{n + 1}", DoubleType())]))
    return out.toDF(*docs.columns, "lang_pred", "score")


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    model = train(docs.select("doc_id", "text", "lang"), per_language)
    return predict(docs.select("doc_id", "text"), *model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is told with at least that probability, in their own columns."""
    model = train(docs.select("doc_id", "text", "lang"))
    judged = predict(packed(docs), *model)
    told = judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return told.select(*unpacked(told, docs))
