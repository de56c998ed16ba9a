"""Ranked lexical search of a set of queries over all documents, term-at-a-time and document-at-a-time combined.

Terms are the maximal runs of ASCII letters and digits and all characters beyond ASCII, with only A-Z lower-cased.
A document's score for a query is the sum over the query's distinct terms of

    w * ((1000000000 * tf) div (1000 * tf + 20 * m)),   w = floor(1000 * ln((2 N + 2) / (2 df + 1))),
    m = 100 - 50 + (50 * n * N) div L

with N the documents that have a term, L all their terms, n one document's terms.

One pass over the texts counts terms and keeps, per document, n and the frequencies of the terms any query uses;
that table is written once and gives N, L and df by partial aggregation. Then every task turns its documents into
shards of at most ``POSTINGS`` postings: inverted lists ordered by document, with scores as contributions. For each
query

* the short lists, up to ``SHORT`` of the postings of the query, are summed term at a time into accumulators, which
  from then on are one more list: its entries are partial sums and its bound is the largest of them;
* all lists, this one included, are walked together in windows of ``WINDOW`` documents. Lists whose bounds together
  stay below the lowest score that still counts can't make a result on their own: they are only looked up, by binary
  search, for the documents the other lists name, and only while a document can still get there. Windows whose own
  bounds (the largest contribution of each list in the window) stay below that score are skipped.

The lowest score that counts rises over the shards of a task, ``TOP`` results per query and task leave it, and
the final ranking is a ``row_number() <= TOP`` window per query, which Spark prunes before the shuffle.

Queries are taken in blocks of at most ``QUERIES`` items and ``QUERY_BYTES`` of text (or one item), each block with
its own two passes; what a block's tasks get is the terms of its queries and nothing that grows with the documents.

Defined results: null text has no term and is no result; a null or termless query gives no rows; equal rows are
ranked each; equal scores by ascending id, null ids last; every distinct (item id, text) is a query of its own, so
an id with two texts has two rankings; empty tables give an empty result; other columns are ignored. Whole texts are
counted, of any length.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.session import stage

TOP = 50
QUERIES = 2000
QUERY_BYTES = 4 << 20
POSTINGS = 2_000_000
SHORT = 0.1
WINDOW = 4096
LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text."""
    return text.translate(LOWER).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def contributions(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Best:
    """The best entries so far of one query: scores and ids, at most ``size``."""

    def __init__(self, size: int):
        self.size, self.scores, self.rows = size, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """Lowest score that may still count; equal scores may, by their ids."""
        return int(self.scores[-1]) if len(self.scores) == self.size else 1

    def add(self, scores: np.ndarray, rows: np.ndarray, order: np.ndarray) -> None:
        """``order`` ranks rows by id."""
        scores, rows = np.concatenate([self.scores, scores]), np.concatenate([self.rows, rows])
        first = np.lexsort((order[rows], -scores))[: self.size]
        self.scores, self.rows = scores[first], rows[first]


class Postings:
    """Rows, ascending, with their values; where each window begins, and the largest value in it."""

    def __init__(self, rows: np.ndarray, values: np.ndarray, windows: int):
        self.rows, self.values = rows, values
        self.edges = np.searchsorted(rows, np.arange(windows + 1) * WINDOW)
        self.bounds = np.zeros(windows, np.int64)
        filled = np.flatnonzero(np.diff(self.edges))
        if len(filled):
            self.bounds[filled] = np.maximum.reduceat(values, self.edges[filled])
        self.bound = int(self.bounds.max(initial=0))

    def within(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.edges[window], self.edges[window + 1])
        return self.rows[part], self.values[part]


class Lists:
    """Inverted lists of a shard: for each term its rows, ascending, and their contributions."""

    def __init__(self, term: np.ndarray, row: np.ndarray, value: np.ndarray, n_terms: int, n_rows: int):
        by_term = np.argsort(term, kind="stable")
        self.row, self.value = row[by_term], value[by_term]
        self.ends = np.searchsorted(term[by_term], np.arange(n_terms + 1))
        self.windows = -(-n_rows // WINDOW)
        self.known: dict[int, Postings] = {}

    def of(self, term: int) -> Postings:
        """The list of a term, made once per shard."""
        if term not in self.known:
            part = slice(self.ends[term], self.ends[term + 1])
            self.known[term] = Postings(self.row[part], self.value[part], self.windows)
        return self.known[term]


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum short lists term at a time into one list."""
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, place = np.unique(np.concatenate([r for r, _ in lists]), return_inverse=True)
    sums = np.zeros(len(rows), np.int64)
    np.add.at(sums, place, np.concatenate([v for _, v in lists]))
    return rows, sums


def search_shard(index: Lists, query: list[int], best: Best, order: np.ndarray, base: int) -> None:
    """Put the shard's results for one query into ``best``; rows of the shard are numbered from ``base`` there."""
    lists = sorted((x for x in map(index.of, query) if x.bound), key=lambda x: len(x.rows))
    if not lists:
        return
    total, short, taken = sum(len(x.rows) for x in lists), 0, 0
    while short < len(lists) and (short == 0 or taken + len(lists[short].rows) <= SHORT * total):
        taken += len(lists[short].rows)
        short += 1
    sums = accumulate([(x.rows, x.values) for x in lists[:short]])
    lists = sorted([Postings(*sums, index.windows), *lists[short:]], key=lambda x: x.bound)
    below = np.cumsum([x.bounds for x in lists], axis=0)  # per window: what the lists up to each can add at most
    richest = int(np.argmax(below[-1]))  # taken first, for an early bound
    for window in [richest, *(w for w in range(index.windows) if w != richest)]:
        if below[-1, window] < best.least:
            continue
        parts = [x.within(window) for x in lists]
        needed = int(np.searchsorted(below[:, window], best.least))  # lists before this one can't do it alone
        rows, scores = accumulate(parts[needed:])
        for k in range(needed - 1, -1, -1):
            open_ = scores + below[k, window] >= best.least
            rows, scores = rows[open_], scores[open_]
            own, values = parts[k]
            if not len(rows) or not len(own):
                continue
            place = np.minimum(np.searchsorted(own, rows), len(own) - 1)
            scores = scores + np.where(own[place] == rows, values[place], 0)
        good = scores >= best.least
        if good.any():
            best.add(scores[good], rows[good] + base, order)


def frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, terms, tfs: the terms of the vocabulary in each document that has any term."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).filter("text is not null")
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known.value
        for batch in batches:
            sizes, offsets, ids, tfs = [], [0], [], []
            for text in batch.column(1):
                found = terms(text.as_py())
                sizes.append(len(found))
                for term, tf in Counter(found).items():
                    number = words.get(term)
                    if number is not None:
                        ids.append(number)
                        tfs.append(tf)
                offsets.append(len(ids))
            at = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, t)) for x, t in ((ids, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, terms array<int>, tfs array<bigint>").filter("n > 0")


def _block(docs: DataFrame, queries: list[tuple], top: int) -> DataFrame:
    """Results of one block of queries: query number, doc_id, score."""
    spark = docs.sparkSession
    words = [sorted(set(terms(text.encode()))) for _, text in queries]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*words)))}
    asked = [[vocabulary[w] for w in q] for q in words]
    counted = stage(frequencies(docs, vocabulary), "search-frequencies")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for term, count in df.collect():  # at most one row per term of the queries
        weights[term] = weight(n_docs, count)
    shared = spark.sparkContext.broadcast((asked, weights))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = shared.value
        best = [Best(top) for _ in asked]
        kept = None  # ids of the rows that ``best`` refers to

        def shard(parts: list[pa.RecordBatch]) -> None:
            nonlocal kept
            table = pa.Table.from_batches(parts).combine_chunks()
            new = table.column("doc_id").combine_chunks()
            base = 0 if kept is None else len(kept)
            ids = new if kept is None else pa.concat_arrays([kept, new])
            order = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
            lists = table.column("terms").combine_chunks()
            row = np.repeat(np.arange(len(new)), np.diff(lists.offsets.to_numpy()))
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = table.column("tfs").combine_chunks().flatten().to_numpy()
            m = 50 + (50 * table.column("n").to_numpy() * n_docs) // n_terms
            index = Lists(term, row, contributions(weights[term], tf, m[row]), len(weights), len(new))
            for query, own in zip(asked, best, strict=True):
                search_shard(index, query, own, order, base)
            used = np.unique(np.concatenate([b.rows for b in best])) if best else np.zeros(0, np.int64)
            for b in best:
                b.rows = np.searchsorted(used, b.rows)
            kept = ids.take(pa.array(used))

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column("terms").flatten())
            if size >= POSTINGS:
                shard(held)
                held, size = [], 0
        if held:
            shard(held)
        if kept is not None:
            numbers = np.repeat(np.arange(len(best)), [len(b.rows) for b in best])
            rows = np.concatenate([b.rows for b in best]).astype(np.int64)
            scores = np.concatenate([b.scores for b in best]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), kept.take(pa.array(rows)), pa.array(scores)], ["query", "doc_id", "score"])

    return counted.mapInArrow(run, f"query int, doc_id {kind}, score bigint")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block: int = QUERIES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` highest-scoring documents of each item."""
    spark = docs.sparkSession
    asked = items.select("item_id", "text").filter("text is not null").distinct()
    kind = items.schema["item_id"].dataType.simpleString()
    out, held, size = None, [], 0

    def answer(queries: list[tuple]) -> DataFrame:
        # the items of a block, at most ``block`` rows
        names = spark.createDataFrame([(i, q[0]) for i, q in enumerate(queries)], f"query int, item_id {kind}")
        first = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = _block(docs, queries, top).withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top)
        return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")

    for row in asked.toLocalIterator():
        if held and (len(held) == block or size + len(row.text) > QUERY_BYTES):
            out, held, size = answer(held) if out is None else out.unionAll(answer(held)), [], 0
        held.append((row.item_id, row.text))
        size += len(row.text)
    return answer(held) if out is None else out.unionAll(answer(held))
