"""Document fingerprints from prefix polynomial hashes.

``Prefixes`` holds, for one text, the running sums of c[i] * B**i modulo a prime, for two bases. The hash of any
span follows from two entries, so spans are compared in constant time and the longest common extension of two
positions is found by binary search over lengths.

A fingerprint is ``length:hash:sketch``: the hash of the whole text, and for each of ``SLOTS`` slots the smallest
mixed hash among the windows of ``WINDOW`` code points (the whole text where it is shorter) that fall in the slot.
The likeness of two fingerprints is the share of slots with equal entries among those used by either: an estimate
of how many windows the texts have in common. Two empty texts have likeness 1, an empty and another text 0.

Defined results: null text is empty; documents are ordered by id, null ids first, then by text; rows may repeat;
the last document's successor is the first, a single document is its own; an empty table gives an empty result;
other columns are ignored.

Texts are shuffled once, by ranges of ids. The first document of each range also goes to the range before it, as
the successor of its last; the driver sees one id per range.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1
BASES = (911_382_323 % PRIME, 972_663_749 % PRIME)
WINDOW = 12
SLOTS = 64
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo PRIME for i < n; kept per process and doubled when a longer text comes."""
    have = _POWERS.get(base, np.ones(1, dtype=np.int64))
    while len(have) < n:
        have = np.concatenate([have, have * (int(have[-1]) * base % PRIME) % PRIME])
    _POWERS[base] = have
    return have


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)


class Prefixes:
    """Span hashes of one text."""

    def __init__(self, code: np.ndarray, bases: tuple[int, ...] = BASES):
        self.size, self.bases = len(code), bases
        self.sums = []
        for base in bases:
            terms = (code + 1) * powers(base, len(code) + 1)[: len(code)] % PRIME
            self.sums.append(np.concatenate([[0], np.cumsum(terms)]))  # below 2^62 up to 2^31 code points

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """Hash of [start, end): equal spans have equal hashes wherever they stand."""
        return tuple(
            int(s[end] - s[start]) % PRIME * pow(base, -start, PRIME) % PRIME for s, base in zip(self.sums, self.bases, strict=True)
        )

    def windows(self, width: int) -> np.ndarray:
        """Hash of every window of ``width`` code points under the first base, shifted to one scale."""
        s, n = self.sums[0], self.size - width + 1
        return (s[width:] - s[: self.size + 1 - width]) % PRIME * powers(self.bases[0], self.size + 1)[self.size - np.arange(n)] % PRIME


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Length of the longest common extension of position i of one text and j of another."""
    low, high = 0, min(a.size - i, b.size - j)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a.span(i, i + mid) == b.span(j, j + mid) else (low, mid - 1)
    return low


def sketch(prefixes: Prefixes) -> np.ndarray:
    """Smallest mixed window hash per slot, 16 bits of it; -1 where no window falls."""
    out = np.full(SLOTS, -1, dtype=np.int64)
    if prefixes.size:
        width = min(WINDOW, prefixes.size)
        h = prefixes.windows(width)
        # windows() scales by base**(size - start): undo the size so that texts of any length agree
        h = h * pow(prefixes.bases[0], -prefixes.size, PRIME) % PRIME
        mixed = h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        slot, rest = (mixed >> np.uint64(58)).astype(np.int64), ((mixed >> np.uint64(16)) & np.uint64(0x3FFFFFFFFFF)).astype(np.int64)
        least = np.full(SLOTS, np.iinfo(np.int64).max)
        np.minimum.at(least, slot, rest)
        out = np.where(least == np.iinfo(np.int64).max, -1, least & 0xFFFE)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    used = (a >= 0) | (b >= 0)
    return float(((a == b) & used).sum() / used.sum()) if used.any() else 1.0


def fingerprint(code: np.ndarray) -> tuple[str, np.ndarray, Prefixes]:
    p = Prefixes(code)
    s = sketch(p)
    whole = "".join(f"{h:08x}" for h in p.span(0, p.size))
    return f"{p.size}:{whole}:" + np.where(s < 0, 0xFFFF, s).astype(">u2").tobytes().hex(), s, p


def _bounds(docs: DataFrame) -> list[int]:
    """Ids that cut the documents into about as many ranges as there are shuffle partitions."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / n for i in range(1, n)]
    return sorted({int(b) for b in docs.approxQuantile("doc_id", steps, 1 / (4 * n))}) if steps else []


def _placed(docs: DataFrame, cuts: list[int], names: list[str]) -> DataFrame:
    """``docs`` with the number of cuts at or below the id; null ids are in the first range."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect.bisect_right(cuts, i) if i is not None else 0 for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], [*names, "bucket"])

    kinds = {"doc_id": "bigint", "text": "string"}
    return docs.select(*names).mapInArrow(place, ", ".join([*(f"{c} {kinds[c]}" for c in names), "bucket int"]))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and its edited text: the last half replaced by the start of the next document."""
    text = F.coalesce("text", F.lit("")).alias("text")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text)
    lows = _placed(docs, _bounds(docs.filter("doc_id IS NOT NULL")), ["doc_id"]).groupBy("bucket").agg(
        F.min("doc_id").alias("low"), F.max(F.col("doc_id").isNull()).alias("some_null")
    )
    ranges = lows.collect()  # one row per shuffle partition at most
    lowest = sorted(r["low"] for r in ranges if r["low"] is not None)
    starts = lowest[1:]  # each an id that occurs: the first of its range
    placed = _placed(docs, starts, ["doc_id", "text"])
    some_null = any(r["some_null"] for r in ranges)
    first_id = F.lit(None if some_null or not lowest else lowest[0]).cast("bigint")
    is_start = F.col("doc_id").isin(starts)
    targets = F.array_compact(
        F.array(
            F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest")),
            F.when(is_start, F.struct((F.col("bucket") - 1).alias("bucket"), F.lit(1).alias("guest"))),
            F.when(F.col("doc_id").eqNullSafe(first_id), F.struct(F.lit(len(starts)).alias("bucket"), F.lit(1).alias("guest"))),
        )
    )
    sent = placed.select("doc_id", "text", F.explode(targets).alias("t")).select("doc_id", "text", "t.bucket", "t.guest")
    dealt = sent.repartition(F.col("bucket")).sortWithinPartitions("bucket", "guest", F.col("doc_id").asc_nulls_first(), "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "same_start"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]

    def row(own: tuple, following: tuple) -> tuple:
        (doc_id, code, mark, s, p), (_, other, _, next_s, _) = own, following
        n = len(code)
        edited = np.concatenate([code[: n - n // 2], other[: n // 2]])
        edited_mark, edited_s, edited_p = fingerprint(edited)
        digest = hashlib.sha256(edited.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"))
        return (
            doc_id, n, digest.hexdigest(), mark, edited_mark, likeness(s, edited_s), likeness(s, next_s),
            common_extension(p, 0, edited_p, 0),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, last, closed = None, None, True
        for batch in batches:
            rows = []
            columns = [batch.column(i) for i in range(4)]
            for k in range(batch.num_rows):
                doc_id, at, guest = columns[0][k].as_py(), columns[2][k].as_py(), columns[3][k].as_py()
                if at != bucket:
                    bucket, last, closed = at, None, False
                if guest and closed:
                    continue
                code = code_points(columns[1][k].as_py())
                here = (doc_id, code, *fingerprint(code))
                if last is not None:
                    rows.append(row(last, here))
                last, closed = here, bool(guest)
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return dealt.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, same_start bigint")
