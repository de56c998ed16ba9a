"""Near-duplicate components by the Jaccard similarity of word shingles, with adaptive multi-match prefixes.

A document's set holds the 64-bit hashes of its distinct runs of five words. Documents with equal sets form one
class, known by a hash of the set. Two sets link when 100 * common >= 80 * union.

Prefixes. All tokens have one global order: rare before frequent, by classes of the document frequency for at
most ``HEAVY_TOKENS`` of the most frequent tokens (any fixed order gives the same result; this one keeps common
passages out of the prefixes), then by hash. A set of n tokens that links to any other shares at least
ceil(0.8 n) of them, so the first n - ceil(0.8 n) + l tokens of two linked sets share at least l. Each set picks
its own l: a longer prefix costs postings but asks candidates for more shared tokens; l minimises the cost
estimated from the frequencies. A pair is verified only if it shares min(l, l') prefix tokens.

Filters. Two sets of n and m tokens link only if they share 80 (n + m) / 180 of them, and what they share lies at or
behind their first common token. So each posting carries n and how many of the set's tokens are left from there on
(its *room*); two entries of a posting are a pair only if both have room for what n and m ask. The first common
token of a linked pair passes, so no link is lost.

Groups. Postings of up to ``SMALL`` sets give all such pairs. In longer ones each set first meets the hub, the set
with most room for its size: in a group of copies that is the text the others were made from, or one as close.
Then the sets still in different components meet, by token and size band: a set of n tokens looks for smaller sets
only in the bands from 0.8 n up to the size its room allows. Pairs within a component are not compared again: a group
of near copies costs about its size, and no link between different components is missed. Components come from
alternating stars.

Verification compares whole sets. Pairs are gathered in cells of at most about ``CELL_PAIRS`` pairs that share
sets, and a set is sent once per cell that needs it. The texts that are needed are found by a bit table of
``FILTER_BITS`` bits whatever the input, and hashed again; all the rest of the corpus stays where it is.

Defined results: null text, and text without a word, has the empty set, links with nothing and is its own
component; with one to four words the whole sequence is the only shingle; rows with equal id and text link as
copies; a component without an id but null has null; an empty table gives an empty result; other columns are
ignored. Classes are told apart by 64 bits: among n different sets a chance match has probability n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import packed, text_key, unpacked
from gaugeflow.operators.skew import salted_lookup
from gaugeflow.session import stage

SHINGLE = 5
LEAST_PERCENT = 80
HEAVY_TOKENS = 1 << 20
HEAVY_LEAST = 16
FLUSH = 1 << 20  # tokens a task holds before it sends them or their counts
SEGMENT = 1 << 20  # bytes hashed at once
SMALL = 8
HEAVY_SALTS = 64
CELL_PAIRS = 512
FILTER_BITS = 1 << 25
BAND = 1.02  # ratio of the sizes at the ends of a band
SALTS = 8
ROW_COST, PAIR_COST, VERIFY_COST = 1.0, 1.0, 4.0

_RANDOM = np.random.default_rng(20240117)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = _RANDOM.integers(0, 1 << 64, SHINGLE, dtype=np.uint64) | np.uint64(1)
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\f\r"))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base, np.ones(1, dtype=np.uint64))
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(int(have[-1]) * base % (1 << 64))])
    _POWERS[base] = have
    return have


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """One hash per word, from running sums of byte values times powers of an odd base modulo 2**64."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_LOWER), dtype=np.uint8)
    space = np.concatenate([[True], _SPACE[raw], [True]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    out, done = np.zeros(len(starts), dtype=np.uint64), 0
    while done < len(starts):
        low = starts[done]
        upto = max(done + 1, int(np.searchsorted(ends, low + SEGMENT, side="right")))
        part = raw[low : ends[upto - 1]]
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[part] * _powers(_BASE, len(part))[: len(part)], dtype=np.uint64)])
        s, e = starts[done:upto] - low, ends[done:upto] - low
        out[done:upto] = (sums[e] - sums[s]) * _powers(_INVERSE, len(part) + 1)[s]
        done = upto
    return mixed(out)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes (unsigned)."""
    w = word_hashes(text or "")
    n = max(1, len(w) - SHINGLE + 1) if len(w) else 0
    if not n:
        return np.zeros(0, dtype=np.uint64)
    width = min(SHINGLE, len(w))
    total = np.full(n, np.uint64(width))
    for k in range(width):
        total = total + w[k : k + n] * _MIX[k]
    return np.unique(mixed(total))


def set_hash(tokens: np.ndarray) -> int:
    total = np.array([len(tokens)], dtype=np.uint64) + mixed(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(mixed(total).view(np.int64)[0])


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, node): size and class of every document's set; node is null for empty sets."""
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes = [], []
            for text in batch.column(2):
                own = shingles(text.as_py())
                sizes.append(len(own))
                nodes.append(set_hash(own) if len(own) else None)
            arrays = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", "n", "node"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, key bigint, n bigint, node bigint")


# Document frequencies: tasks send the leading 32 bits of their tokens in ranges, two bytes a token.


def _packed(tokens: list[np.ndarray], ranges: int) -> pa.RecordBatch:
    values, counts = np.unique(np.concatenate(tokens), return_counts=True)
    per = 65536 // ranges
    cuts = np.searchsorted(values, np.arange(ranges, dtype=np.uint64) << np.uint64(32 - ranges.bit_length() + 1))
    cuts = np.append(cuts, len(values))
    out = {"range": [], "mids": [], "lows": [], "at": [], "more": []}
    for r in range(ranges):
        v, c = values[cuts[r] : cuts[r + 1]], counts[cuts[r] : cuts[r + 1]]
        if len(v):
            often = np.flatnonzero(c > 1)
            out["range"].append(r)
            out["mids"].append(np.bincount((v >> 16) - r * per, minlength=per).astype("<u4").tobytes())
            out["lows"].append((v & 0xFFFF).astype("<u2").tobytes())
            out["at"].append(often.astype("<u4").tobytes())
            out["more"].append(c[often].astype("<u4").tobytes())
    kinds = [pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out.values(), kinds, strict=True)], list(out))


def _frequent(table: pa.Table, ranges: int) -> pa.Table:
    r = table.column("range")[0].as_py()
    values, counts = [], []
    for row in table.to_pylist():
        mids = np.frombuffer(row["mids"], dtype="<u4")
        high = np.repeat(np.arange(len(mids), dtype=np.uint32) + np.uint32(r * (65536 // ranges)), mids)
        values.append((high << np.uint32(16)) | np.frombuffer(row["lows"], dtype="<u2"))
        c = np.ones(len(high), dtype=np.int64)
        c[np.frombuffer(row["at"], dtype="<u4")] = np.frombuffer(row["more"], dtype="<u4")
        counts.append(c)
    values, counts = np.concatenate(values), np.concatenate(counts)
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    values, total = values[first], np.add.reduceat(counts, first)
    top = np.lexsort((values, -total))[: HEAVY_TOKENS // ranges]
    top = np.sort(top[total[top] >= HEAVY_LEAST])
    rows = {"tokens": [values[top].astype("<u4").tobytes()], "n": [total[top].astype("<i8").tobytes()]}
    return pa.table({"range": pa.array([r], pa.int32()), "tokens": pa.array(rows["tokens"]), "n": pa.array(rows["n"])})


def heavy_tokens(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent leading token halves in order, with the number of documents that hold each."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(65536, 1 << max(0, 4 * partitions - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append((shingles(text.as_py()) >> np.uint64(32)).astype(np.uint32))
                size += len(held[-1])
                if size >= FLUSH:
                    yield _packed(held, ranges)
                    held, size = [], 0
        if size:
            yield _packed(held, ranges)

    sent = docs.select("text").mapInArrow(run, "range int, mids binary, lows binary, at binary, more binary")
    found = sent.groupBy("range").applyInArrow(lambda t: _frequent(t, ranges), "range int, tokens binary, n binary")
    rows = sorted(found.collect(), key=lambda r: r["range"])  # HEAVY_TOKENS entries of 12 bytes at most
    tokens = np.frombuffer(b"".join(r["tokens"] for r in rows), dtype="<u4")
    return tokens, np.frombuffer(b"".join(r["n"] for r in rows), dtype="<i8")


def prefix(tokens: np.ndarray, heavy: np.ndarray, frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Leading halves of the prefix tokens, which of them are heavy, their room, and how many a candidate has to share."""
    half = (tokens >> np.uint64(32)).astype(np.uint32)
    n, seen = len(tokens), np.ones(len(tokens))
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, half), len(heavy) - 1)
        hit = heavy[at] == half
        seen[hit] = frequency[at[hit]]
    rank = np.where(seen > 1, 1 + np.log2(seen).astype(np.int64), 0)
    order = np.argsort(rank, kind="stable")  # tokens come sorted: by class, then by hash
    half, seen = half[order], seen[order]
    least = -(-LEAST_PERCENT * n // 100)
    match = np.arange(1, least + 1)
    # Sets met by a prefix of each length; a long posting's sets meet by its hub, so it counts as a short one.
    met = np.cumsum(np.minimum(seen - 1, SMALL - 1))[n - least :]
    total = ROW_COST * (n - least + match) + PAIR_COST * met + VERIFY_COST * met / match
    chosen = int(match[np.argmin(total)])
    length = n - least + chosen
    half, first = np.unique(half[:length], return_index=True)
    # tokens that agree in their leading half count once, at the first of them
    return half, seen[first] > 1, n - first, max(1, chosen - (length - len(half)))


def postings(docs: DataFrame, heavy) -> DataFrame:
    """(token, node, n, room) of all prefix tokens that more than one set holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, frequency = heavy.value
        sent: set[int] = set()  # copies in one task are sent once
        held: list[tuple] = []
        size = 0

        def sending() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "heavy", "node", "n", "room"])

        for batch in batches:
            for text in batch.column(0):
                own = shingles(text.as_py())
                node = set_hash(own)
                if not len(own) or node in sent:
                    continue
                sent.add(node)
                half, is_heavy, room, _ = prefix(own, known, frequency)
                n = len(half)
                held.append((half.view(np.int32), is_heavy, np.full(n, node, np.int64), np.full(n, len(own), np.int32), room.astype(np.int32)))
                size += n
                if size >= FLUSH:
                    yield sending()
                    held, size = [], 0
        if held:
            yield sending()

    rows = docs.select("text").mapInArrow(run, "token int, heavy boolean, node bigint, n int, room int")
    # A frequent token is held by more than one set anyway, so its sets may be dealt to several tasks.
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64("node"), F.lit(HEAVY_SALTS))).otherwise(0)
    same = Window.partitionBy("token", "salt")
    seen = rows.withColumn("salt", salt).select(
        "token",
        "node",
        "n",
        "room",
        F.lag("node").over(same.orderBy("node")).alias("before"),
        (F.col("heavy") | (F.min("node").over(same) != F.max("node").over(same))).alias("shared"),
    )
    return seen.filter(F.col("shared") & ~F.col("before").eqNullSafe(F.col("node"))).select("token", "node", "n", "room")


def _ends(a: Column, b: Column) -> Column:
    return F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def _may_link(x: Column, y: Column) -> Column:
    """Two entries of a posting, structs with n and room, pass the filters of size and room."""
    n, m = x["n"].cast("bigint"), y["n"].cast("bigint")
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * LEAST_PERCENT
    return sizes & (F.least(x["room"], y["room"]) * F.lit(100 + LEAST_PERCENT).cast("bigint") >= LEAST_PERCENT * (n + m))


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of (a, b): the smallest node of its component, by alternating stars."""

    def ordered(df: DataFrame) -> DataFrame:
        return df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def around(df: DataFrame) -> DataFrame:
        """Each node's smallest neighbour, itself included."""
        return df.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("c"), F.least("a", "b").alias("root"))

    def with_root(df: DataFrame) -> DataFrame:
        return salted_lookup(df.withColumn("c", F.col("a")), around(df), ["c"], spread="b", how="inner")

    def signature(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stage(ordered(edges), "links")
    seen = signature(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = ordered(with_root(both).filter("b > a").select(F.col("b").alias("a"), F.col("root").alias("b")))
        large = stage(large, "links")
        small = with_root(large)
        small = ordered(small.select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(small.select("a", F.col("root").alias("b"))))
        edges = stage(small, "links")
        now = signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _linked(sets: pa.Table, pairs: pa.Table) -> pa.Table:
    """The pairs of one cell that share enough prefix tokens and whose whole sets reach the similarity."""
    held = {}
    for node, match, lead, tokens in zip(*(sets.column(c).to_pylist() for c in ("node", "match", "lead", "tokens")), strict=True):
        held[node] = match, np.frombuffer(lead, dtype=np.uint32), np.frombuffer(tokens, dtype=np.uint64)
    out = []
    for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
        (match, lead, x), (other_match, other_lead, y) = sorted((held[a], held[b]), key=lambda s: len(s[2]))
        if _common(lead, other_lead) < min(match, other_match):
            continue
        common = _common(x, y)
        if 100 * common >= LEAST_PERCENT * (len(x) + len(y) - common):
            out.append((a, b))
    columns = list(zip(*out, strict=True)) or [[], []]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["node", "match", "lead", "tokens"])


class _Verifier:
    """Keeps the verified links of candidate pairs; sets are computed for the texts that need them."""

    def __init__(self, docs: DataFrame, found: DataFrame, heavy):
        self.docs, self.heavy = docs, heavy
        heads = found.filter("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc_id", "key")).alias("head"))
        self.heads = stage(heads.select("node", F.xxhash64("head.doc_id", "head.key").alias("row")), "jaccard-heads")

    def _wanted(self, nodes: DataFrame):
        """Bit table, of ``FILTER_BITS`` bits in all, of the rows that stand for the given classes."""
        row = F.pmod(F.col("row"), F.lit(FILTER_BITS))
        bits = self.heads.join(nodes, "node").select(F.floor(row / 64).cast("int").alias("word"), F.expr("1L << int(pmod(row, 64))").alias("bit"))
        table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
        for batch in bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow().to_batches():
            table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
        return self.docs.sparkSession.sparkContext.broadcast(table)

    def _sets(self, ends: DataFrame) -> DataFrame:
        """(s_g, s_block, node, match, lead, tokens): the sets that each cell needs."""
        filled, heavy = self._wanted(ends.select("node").distinct()), self.heavy
        rows = self.docs.select(F.xxhash64("doc_id", text_key(F.col("text"))).alias("row"), "text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, (known, frequency) = filled.value, heavy.value
            sent: set[int] = set()
            for batch in batches:
                row = batch.column(0).to_numpy()
                place = np.mod(row, FILTER_BITS)
                hit = (table[place // 64] >> (np.mod(row, 64))) & 1
                out, size = [], 0
                for i in np.flatnonzero(hit).tolist():
                    if size >= FLUSH:
                        yield _sent(out)
                        out, size = [], 0
                    own = shingles(batch.column(1)[i].as_py())
                    node = set_hash(own)
                    if len(own) and node not in sent:
                        sent.add(node)
                        lead, _, _, match = prefix(own, known, frequency)
                        out.append((node, match, lead.tobytes(), own.tobytes()))
                        size += len(own)
                yield _sent(out)

        hashed = rows.mapInArrow(run, "node bigint, match bigint, lead binary, tokens binary")
        once = hashed.groupBy("node").agg(*[F.first(c).alias(c) for c in ("match", "lead", "tokens")])
        return ends.join(once, "node").select("s_g", "s_block", "node", "match", "lead", "tokens")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes that reach the similarity."""
        pairs = stage(pairs.filter("a <> b").distinct(), "jaccard-pairs")
        # Pairs that share sets meet in one cell: by the smallest partner of one end, in blocks of the other.
        turned = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = turned.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("g")).select(F.col("a").alias("_a"), "g")
        placed = salted_lookup(pairs.withColumn("_a", F.col("a")), low, ["_a"], spread="b", how="inner").drop("_a")
        counts = placed.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / CELL_PAIRS).cast("bigint").alias("blocks"))
        placed = salted_lookup(placed, counts, ["g"], spread="b", how="inner")
        placed = stage(placed.select("g", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"), "a", "b"), "jaccard-cells")
        ends = placed.select(F.col("g").alias("s_g"), F.col("block").alias("s_block"), F.explode(F.array("a", "b")).alias("node")).distinct()
        cells = self._sets(ends).groupBy("s_g", "s_block").cogroup(placed.groupBy("g", "block"))
        return stage(cells.applyInArrow(_linked, "a bigint, b bigint"), "jaccard-links")


def _band(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) / float(np.log(BAND))).cast("int")


def _left_over(long: DataFrame, done: DataFrame) -> DataFrame:
    """Pairs of long postings that pass the filters, between sets of different components."""
    roots = connected(done)
    held = salted_lookup(long, roots, ["node"], spread="token").withColumn("root", F.coalesce("root", "node"))
    counts = held.groupBy("token", "root").agg(F.count(F.lit(1)).alias("c"))
    major = counts.groupBy("token").agg(F.max(F.struct("c", "root")).alias("top"), F.count(F.lit(1)).alias("parts"))
    major = major.filter("parts > 1").select("token", F.col("top.root").alias("major"))
    held = stage(salted_lookup(held, major, ["token"], spread="node", how="inner"), "jaccard-open")
    # The larger set of a pair looks for the smaller one in the bands of all sizes its room allows.
    room = F.floor(((100 + LEAST_PERCENT) * F.col("room").cast("bigint") - LEAST_PERCENT * F.col("n")) / LEAST_PERCENT)
    least = F.ceil(F.col("n") * F.lit(LEAST_PERCENT) / 100)
    most = F.least(F.col("n").cast("bigint"), room)
    entry = F.struct("node", "n", "room", "root")
    spread = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    large = held.filter(most >= least).select(
        "token", entry.alias("x"), (F.col("root") == F.col("major")).alias("x_major"), F.explode(F.sequence(_band(least), _band(most))).alias("band")
    )
    small = held.select("token", entry.alias("y"), (F.col("root") == F.col("major")).alias("y_major"), _band(F.col("n")).alias("band"), spread.alias("salt"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    # Each entry becomes a row per band and salt, which Spark's size check doesn't count: never broadcast.
    large = large.select("*", salts).hint("merge")
    met = large.filter("NOT x_major").join(small, ["token", "band", "salt"]).unionByName(
        large.filter("x_major").join(small.filter("NOT y_major"), ["token", "band", "salt"])
    )
    met = met.filter((F.col("x.root") != F.col("y.root")) & _may_link(F.col("x"), F.col("y")))
    return met.select(_ends(F.col("x.node"), F.col("y.node")).alias("p")).select("p.a", "p.b")


def links(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Links (a, b) of classes that connect all their components."""
    heavy = docs.sparkSession.sparkContext.broadcast(heavy_tokens(docs))
    rows = stage(postings(docs, heavy), "jaccard-postings")
    share = F.col("room") / F.col("n")
    sizes = rows.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.max(F.struct(share.alias("share"), "node", "n", "room")).alias("hub"))
    verify = _Verifier(docs, found, heavy)
    # All pairs of short postings, at most SMALL * (SMALL - 1) / 2 each.
    short = salted_lookup(rows, sizes.filter(F.col("c") <= SMALL).select("token"), ["token"], spread="node", how="inner")
    lists = short.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("node", "n", "room"))).alias("s"))

    def with_later(x: Column, i: Column) -> Column:
        later = F.filter(F.slice("s", i + 2, SMALL), lambda y: _may_link(x, y))
        return F.transform(later, lambda y: _ends(x["node"], y["node"]))

    near = lists.select(F.explode(F.flatten(F.transform("s", with_later))).alias("p")).select("p.a", "p.b")
    # Long postings: each set with the hub.
    long = stage(salted_lookup(rows, sizes.filter(F.col("c") > SMALL).select("token", "hub"), ["token"], spread="node", how="inner"), "jaccard-long")
    own = F.struct("node", "n", "room")
    first = long.filter((F.col("node") != F.col("hub.node")) & _may_link(own, F.col("hub"))).select(_ends(F.col("node"), F.col("hub.node")).alias("p"))
    done = verify.links(near.unionByName(first.select("p.a", "p.b")))
    return done.unionByName(verify.links(_left_over(long.drop("hub"), done)))


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document."""
    return keyed_components(docs).select("doc_id", "n_shingles", "component_id")


def keyed_components(docs: DataFrame) -> DataFrame:
    """``components`` with the text key, and whether the row is the first of its component."""
    docs = docs.select("doc_id", "text")
    found = stage(classes(docs), "jaccard-sets-of-documents")
    roots = connected(links(docs, found)).withColumnRenamed("node", "m")
    held = salted_lookup(found.withColumn("m", F.col("node")), roots, ["m"], spread="doc_id")
    held = held.select("doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("root", "m").alias("root"))
    low = held.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "key")).alias("head"))
    out = salted_lookup(held, low, ["root"], spread="doc_id")
    own = F.col("root").isNull()
    return out.select(
        "doc_id",
        "key",
        "n_shingles",
        F.when(own, F.col("doc_id")).otherwise(F.col("low")).alias("component_id"),
        (own | F.struct("doc_id", "key").eqNullSafe(F.col("head"))).alias("first"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, and all without a word, in the columns of ``docs``."""
    heads = keyed_components(docs).filter("first").select(F.col("doc_id").alias("head_id"), F.col("key").alias("head_key"), "n_shingles").distinct()
    rows = packed(docs, "doc_id").withColumn("key", text_key(F.col("text"))).join(
        heads, F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("key") == F.col("head_key"))
    )
    # Rows equal in id and text differ in their other columns at most: the first by content stays.
    order = Window.partitionBy("head_id", "head_key").orderBy(F.to_json("row"))
    kept = rows.withColumn("rank", F.row_number().over(order)).filter("rank = 1 OR n_shingles = 0")
    return kept.select(*unpacked(kept, docs))
