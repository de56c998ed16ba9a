"""Pack tokenised documents into sequences by first-fit decreasing.

A text is tokenised with a given tokenizer file and closed by ``END``. What fills whole sequences is cut off in
pieces of ``LENGTH``; every remainder stays in one piece. Pieces are dealt to randomised groups of about
``GROUP`` by a hash, and each group is packed on its own: longest first, each into the first sequence with room,
found by descending a tournament tree over the free room of the sequences. Then the sequences left emptiest are
taken apart to fill the gaps of the others, so that about one sequence per group keeps padding.

Ids are those of ``tokenizers`` without added special tokens. Words between single blanks are looked up in a memo
of bounded size per process and what is missing is encoded in one call per text; any text where the blanks don't
separate words for the tokenizer (two spaces in a row, rare scripts, special strings) is encoded whole.

Defined results: null text is empty (its only id is END); rows with equal or null ids are packed each; an empty
table gives an empty result; other columns are ignored. Reruns agree for rows that differ in id or text.

Only pieces (ids of documents, lengths, checksums) are shuffled; ids of tokens never leave the task, except for
the pieces that may be cut again, which carry theirs.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import text_key
from gaugeflow.session import stage

LENGTH = 2048
END = 1
GROUP = 8192
MEMO_BYTES = 64 << 20  # what the words kept by a process may take
ENTRY_BYTES = 200  # of a kept word besides its letters
LONGEST_WORD = 200  # longer words are not kept
TOKENIZER = "byte_bpe_50k.json"
RARE = re.compile(r"[^\x00-\u024f]|<\|")  # what the ranks may split in another way than the library
UNEVEN = re.compile(r"\s | \s")
_LOADED: dict[str, Encoder] = {}


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers."""

    def __init__(self, path: str):
        self.path = path
        self.memo: dict[str, bytes] = {}
        self.held = 0
        self.fast = self._ranks(path)

    @functools.cached_property
    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _ranks(self, path: str):
        """The same merges as ranks, if they lie beside the file: about four times as fast."""
        ranks = path.removesuffix(".json") + ".tiktoken"
        if not os.path.exists(ranks):
            return None
        import base64

        import tiktoken
        from public_tokenizers import PATTERN

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.lengths = np.zeros(max(table.values()) + 1, dtype=np.int64)
        for token, rank in table.items():
            self.lengths[rank] = len(token)
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def whole(self, text: str) -> bytes:
        """The ids of a text by the library, or by the ranks where these can't differ."""
        if self.fast is None or RARE.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), dtype="<u4").tobytes()

    def _learn(self, missing: list[str]) -> dict[str, bytes]:
        """Encode words, each behind a blank, in one call and cut the ids where the words' bytes end."""
        if not missing:
            return {}
        ids = np.array(self.fast.encode_ordinary(" " + " ".join(missing)), dtype="<u4")
        ends = np.cumsum([len(w.encode()) + 1 for w in missing])
        cuts = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
        data, at, found = ids.tobytes(), 0, {}
        for word, cut in zip(missing, cuts.tolist(), strict=True):
            found[word] = data[at * 4 : cut * 4]
            at = cut
        return found

    def _keep(self, found: dict[str, bytes]) -> None:
        """Keep words for later texts; when they take too much all are dropped."""
        size = sum(len(w) + len(ids) + ENTRY_BYTES for w, ids in found.items() if len(w) <= LONGEST_WORD)
        if self.held + size > MEMO_BYTES:
            self.memo.clear()
            self.held = 0
        if size <= MEMO_BYTES:
            self.memo.update((w, ids) for w, ids in found.items() if len(w) <= LONGEST_WORD)
            self.held += size

    def encode(self, text: str) -> bytes:
        if self.fast is None or not text or text[0] == " " or text[-1] == " " or RARE.search(text) or UNEVEN.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        memo = self.memo
        # looked up word by word: a difference with the memo's keys would walk the whole memo for each text
        found = self._learn(sorted({w for w in rest if w not in memo}))
        start = np.array(self.fast.encode_ordinary(first), dtype="<u4").tobytes()
        data = start + b"".join([memo[w] if w in memo else found[w] for w in rest])
        self._keep(found)
        return data


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


class Tournament:
    """First bin with enough room: each inner node holds the most room below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def first(self, size: int) -> int:
        node = 1
        while node < self.leaves:
            node *= 2
            if self.most[node] < size:
                node += 1
        return node - self.leaves

    def take(self, place: int, size: int) -> None:
        node = place + self.leaves
        self.most[node] -= size
        node //= 2
        while node:
            self.most[node] = max(self.most[2 * node], self.most[2 * node + 1])
            node //= 2


def first_fit_decreasing(sizes: list[int], room: int = LENGTH) -> list[list[int]]:
    """Numbers of the items in each bin; ``sizes`` come in falling order and each fits an empty bin."""
    tree, bins = Tournament(len(sizes), room), []
    for item, size in enumerate(sizes):
        place = tree.first(size)
        if place == len(bins):
            bins.append([])
        bins[place].append(item)
        tree.take(place, size)
    return bins


def fill_gaps(bins: list[list[int]], sizes: list[int], room: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """(item, from, length) per bin, after the emptiest bins were cut up to fill the others."""
    parts = [[(i, 0, sizes[i]) for i in own] for own in bins]
    free = [room - sum(sizes[i] for i in own) for own in bins]
    order = sorted(range(len(bins)), key=lambda b: (-free[b], b))  # emptiest first
    gaps, given = [b for b in reversed(order) if free[b]], 0
    while given < len(order):
        source = order[given]
        total = sum(free[b] for b in gaps if b != source)
        if not parts[source] or total < room - free[source] or source not in gaps:
            break
        gaps.remove(source)
        for item, start, length in parts[source]:
            while length:
                target = gaps[0]
                n = min(length, free[target])
                parts[target].append((item, start, n))
                start, length, free[target] = start + n, length - n, free[target] - n
                if not free[target]:
                    gaps.pop(0)
        parts[source] = []
        given += 1
    return [p for p in parts if p]


PIECE = "key bigint, start bigint, length bigint, doc_tokens bigint, ids binary, crc bigint"


def pieces(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces of every document; remainders carry their ids, whole sequences only the checksum."""
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    end = np.array([END], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        names = ["doc_id", "key", "start", "length", "doc_tokens", "ids", "crc"]
        for batch in batches:
            kinds = [batch.schema.field(0).type] + [pa.int64()] * 4 + [pa.binary(), pa.int64()]
            out = []
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, key, text in zip(ids, keys, batch.column(2), strict=True):
                data = encode.encode(text.as_py()) + end
                total = len(data) // 4
                for start in range(0, total, LENGTH):
                    part = data[start * 4 : (start + LENGTH) * 4]
                    n = len(part) // 4
                    out.append((doc_id, key, start, n, total, part if n < LENGTH else None, zlib.crc32(part)))
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {PIECE}")


def _pack(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    rows.sort(key=lambda r: (-r["length"], r["doc_id"] is not None, () if r["doc_id"] is None else (r["doc_id"],), r["key"], r["start"]))
    sizes = [r["length"] for r in rows]
    out = []
    for place, parts in enumerate(fill_gaps(first_fit_decreasing(sizes), sizes)):
        offset, number = 0, (rows[0]["bin_group"] << 24) + place
        for item, start, n in parts:
            r = rows[item]
            cut = n < r["length"]
            crc = zlib.crc32(r["ids"][start * 4 : (start + n) * 4]) if cut else r["crc"]
            out.append((r["doc_id"], r["start"] + start, n, crc, r["doc_tokens"], number, offset))
            offset += n
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    columns = list(zip(*out, strict=True)) or [[]] * len(names)
    kinds = [table.schema.field("doc_id").type] + [pa.int64()] * 6
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Every piece with its place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = stage(pieces(docs, tokenizer), "packing-pieces")
    groups = max(1, -(-cut.count() // GROUP))
    group = F.pmod(F.xxhash64(F.lit(11), "doc_id", "key", "start"), F.lit(groups)).alias("bin_group")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return cut.select("*", group).groupBy("bin_group").applyInArrow(_pack, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)
