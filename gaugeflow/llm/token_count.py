"""Token counts by a tokenizer compiled into a deterministic finite-state transducer.

The transducer reads code points. Each transition carries the change in the number of tokens the text would have
if it ended there, so the count of a text is the sum over its transitions and nothing is pending at the end.
A state is made of

* the place in the split into words: inside a run of letters, digits, other signs or white space, behind an
  apostrophe that may begin a contraction, or at a start;
* the merges so far: for every suffix of the current word that some longer token begins with, the last token
  before that suffix and its distance in tokens. A token sequence is the tokenizer's own exactly when each pair of
  neighbours is (merging the pair's bytes gives the pair back), so this tells which token ends at the next byte;
* how much of a special string has been read, and the count to return to when it is completed.

States and transitions are made when first met and kept per process, at most ``TRANSITIONS`` of them; beyond that
the table is emptied and filled anew, with the same results. Word classes of characters are asked of the library.

Long texts are cut into chunks of ``CHUNK`` code points that are spread over the cluster. What a chunk does to any
state it is entered in is its *state map*: behind the first white space that follows another character, the state
no longer depends on the entry, so the map is (head up to there, tokens behind it, text since the last such place).
Maps compose associatively; an exclusive prefix scan over them, in blocks of ``FAN`` and then over blocks,
gives each chunk the state it is entered in and the number of tokens before it.

Defined results: null text counts as empty (0 bytes, 0 tokens); equal rows are counted each; an empty table gives
an empty result; null ids stay null; other columns are ignored. Texts of any length are counted whole: one chunk
without white space is its own head, so a map is never larger than its chunk, and what the last step holds of a text
without any white space is the text itself.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import text_key

CHUNK = 1 << 16
FAN = 256
LIMIT = 1024
TRANSITIONS = 600_000
TOKENIZER = "byte_bpe_50k.json"
NEVER = 1 << 30
# How a contraction goes on behind its apostrophe
CLOSED = ("s", "t", "m", "d")
OPEN = {"r": "e", "v": "e", "l": "l"}


def byte_letters() -> dict[str, int]:
    """Bytes behind the letters of a byte-level vocabulary: visible Latin-1 signs stand for themselves."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Vocabulary as a trie over bytes, and which tokens may stand side by side."""

    def __init__(self, vocab: dict[str, int], merges: list):
        letters = byte_letters()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.rank: dict[int, int] = {}
        self.made = {}  # token: (rank that makes it, left part, right part)
        for rank, (left, right) in enumerate(pairs):
            whole = vocab[left + right]
            self.rank.setdefault(vocab[left] << 20 | vocab[right], rank)
            self.made.setdefault(whole, (rank, vocab[left], vocab[right]))
        self.child: dict[int, int] = {}
        self.token, self.grows = [-1], bytearray(1)
        single = {vocab[c] for c in letters if c in vocab}
        for name, number in sorted(vocab.items(), key=lambda x: x[1]):
            if number not in single and not (number in self.made and self._whole(number)):
                continue  # no text ever gives this token
            node = 0
            for letter in name:
                key = node << 8 | letters[letter]
                self.grows[node] = 1
                node = self.child.setdefault(key, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
                    self.grows.append(0)
            self.token[node] = number
        self.known: dict[int, bool] = {}

    def _whole(self, token: int) -> bool:
        rank, left, right = self.made[token]
        return self._apart(left, right, rank, rank, first=False)

    def _apart(self, left: int, right: int, left_until: int, right_until: int, first: bool = True) -> bool:
        """False if some merge crosses the border before ``left`` and ``right`` are complete.

        Goes back in time: of the two tokens at the border the one made last is undone. Equal merges happen
        from left to right.
        """
        while True:
            rank = self.rank.get(left << 20 | right)
            if first and rank is not None and rank < left_until and rank <= right_until:
                return False
            first = True
            made_left, made_right = self.made.get(left), self.made.get(right)
            if not made_left and not made_right:
                return True
            if made_left and (not made_right or made_left[0] > made_right[0]):
                left_until, _, left = made_left
            else:
                right_until, right, _ = made_right

    def stay(self, left: int, right: int) -> bool:
        """True if the bytes of the two tokens, merged together, give the two tokens."""
        key = left << 20 | right
        found = self.known.get(key)
        if found is None:
            if len(self.known) > 4 * TRANSITIONS:
                self.known.clear()
            found = self.known[key] = self._apart(left, right, NEVER, NEVER)
        return found

    #: Live suffixes of an empty word: (trie node, last token before it, tokens since the end), the empty suffix last.
    EMPTY = ((0, -1, 0),)

    def step(self, live: tuple, data: bytes) -> tuple[tuple, int]:
        """State behind more bytes of the same word, and the change of its token count."""
        total = 0
        for byte in data:
            grown, end = [], None
            for node, before, off in live:
                child = self.child.get(node << 8 | byte)
                if child is None:
                    continue
                token = self.token[child]
                if end is None and token >= 0 and (before < 0 or self.stay(before, token)):
                    end, change = token, off + 1
                if self.grows[child]:
                    grown.append((child, before, off))
            live = (*((node, before, off - change) for node, before, off in grown), (0, end, 0))
            total += change
        return live, total


class State(dict):
    """Transitions by character: (next state, change of the count). Missing ones are compiled."""

    __slots__ = ("key", "machine")

    def __missing__(self, char: str):
        step = self[char] = self.machine.compile(self.key, char)
        return step


class Transducer:
    """The whole tokenizer: ``run`` feeds text to a state and returns the next state and the change of the count."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or not split["use_regex"] or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path}: not a byte-level tokenizer without normalizer")
        self.special = [t["content"] for t in spec["added_tokens"]]
        for text, token in zip(self.special, spec["added_tokens"], strict=True):
            if any(token[k] for k in ("single_word", "lstrip", "rstrip")) or any(text[0] in s[1:] or c.isspace() for s in self.special for c in s):
                raise ValueError(f"{path}: special string {text!r} is not supported")
        self.begun = {s[:k] for s in self.special for k in range(len(s))}
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.merges = Merges(model["vocab"], model["merges"])
        self.kinds: dict[str, str] = {}
        self.reset()

    def reset(self) -> None:
        for state in getattr(self, "states", {}).values():
            state.clear()  # they refer to each other
        self.states: dict[tuple, State] = {}
        self.compiled = 0

    def state(self, key: tuple) -> State:
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State()
            found.key, found.machine = key, self
        return found

    #: (place, live suffixes, last white space, part of a special string, its count less the present one)
    START = ("start", Merges.EMPTY, "", "", 0)

    def kind(self, char: str) -> str:
        """letter, digit, space or other, as the library splits."""
        found = self.kinds.get(char)
        if found is None:
            tests = {"letter": "a", "digit": "1", "other": "!"}
            found = next((k for k, c in tests.items() if len(self.pieces(c + char)) == 1), "space")
            self.kinds[char] = found
        return found

    def synced(self, space: str) -> State:
        """The state behind a white space that follows another character, whatever came before."""
        return self.state(("space", Merges.EMPTY, space, "", 0))

    def compile(self, key: tuple, char: str) -> tuple[State, int]:
        self.compiled += 1
        place, live, last, begun, back = key
        grown = begun + char
        if grown in self.special:
            return self.state(self.START), back + 1
        (place, live, last), change = self._word(place, live, last, char)
        if grown in self.begun:
            begun, back = grown, back - change
        elif char in self.begun:
            begun, back = char, -change
        else:
            begun, back = "", 0
        return self.state((place, live, last, begun, back)), change

    def _begin(self, char: str, kind: str) -> tuple[tuple, int]:
        """A word begins with a character that is no white space."""
        live, change = self.merges.step(Merges.EMPTY, char.encode())
        return ("quote" if char == "'" else kind, live, ""), change

    def _word(self, place: str, live: tuple, last: str, char: str) -> tuple[tuple, int]:
        step, empty, kind, data = self.merges.step, Merges.EMPTY, self.kind(char), char.encode()
        if place == "space":
            longer, counted = step(live, last.encode())  # as if the text ended there: one word
            if kind == "space":
                return ("space", longer, char), step(longer, data)[1]
            if last == " ":  # goes with the next word
                begun, own = step(empty, b" ")
                begun, change = step(begun, data)
                return (kind, begun, ""), own + change - counted
            own = step(empty, last.encode())[1]
            after, change = self._begin(char, kind)
            return after, own + change - counted
        if kind == "space":
            return ("space", empty, char), step(empty, data)[1]
        if place == "quote":  # a word of one apostrophe so far
            if char in CLOSED:
                return ("start", empty, ""), step(live, data)[1]
            if char in OPEN:
                return ("quote" + char, live, ""), step(empty, data)[1]
            place = "other"
        if place[:5] == "quote":  # an apostrophe and the first of two letters, counted as two words
            first = place[5:].encode()
            alone, counted = step(empty, first)
            if char == OPEN[place[5:]]:
                return ("start", empty, ""), step(live, first + data)[1] - counted
            place, live = "letter", alone
        if place == kind:
            live, change = step(live, data)
            return (kind, live, ""), change
        return self._begin(char, kind)

    def run(self, state: State, text: str) -> tuple[State, int]:
        if self.compiled > TRANSITIONS:
            key = state.key
            self.reset()
            state = self.state(key)
        total = 0
        for char in text:
            state, change = state[char]
            total += change
        return state, total

    def count(self, text: str) -> int:
        state, total = self.state(self.START), 0
        for at in range(0, len(text), CHUNK):
            state, more = self.run(state, text[at : at + CHUNK])
            total += more
        return total

    def sync(self, text: str, backwards: bool = False) -> int:
        """Place behind the first (last) white space that follows another character; 0 if there is none."""
        places = range(len(text) - 1, 0, -1) if backwards else range(1, len(text))
        return next((p + 1 for p in places if self.kind(text[p]) == "space" and self.kind(text[p - 1]) != "space"), 0)

    def chunk_map(self, text: str) -> tuple[str, int, str | None]:
        """(head, tokens behind the head, text from the last white space that tells the state); see ``compose``."""
        cut = self.sync(text)
        if not cut:
            return text, 0, None
        _, tokens = self.run(self.synced(text[cut - 1]), text[cut:])
        return text[:cut], tokens, text[self.sync(text, backwards=True) - 1 :]

    def exit(self, tail: str) -> State:
        return self.run(self.synced(tail[0]), tail[1:])[0]

    def compose(self, first: tuple, second: tuple) -> tuple:
        """The map of two neighbouring stretches: apply ``first``, then ``second``."""
        head, tokens, tail = first
        if tail is None:
            return head + second[0], second[1], second[2]
        tokens += self.run(self.exit(tail), second[0])[1] + second[1]
        return head, tokens, tail + second[0] if second[2] is None else second[2]

    def scan(self, maps: list[tuple]) -> tuple[list[tuple], tuple]:
        """Exclusive prefix scan (up-sweep and down-sweep over a binary tree) and the map of everything."""
        if not maps:
            return [], ("", 0, None)
        if len(maps) == 1:
            return [("", 0, None)], maps[0]
        pairs = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        above, total = self.scan(pairs)
        before = [above[i // 2] if i % 2 == 0 else self.compose(above[i // 2], maps[i - 1]) for i in range(len(maps))]
        return before, total

    def tokens_of(self, stretch: tuple) -> int:
        """Tokens of a stretch that begins the text."""
        head, tokens, _ = stretch
        return self.count(head) + tokens


_LOADED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _LOADED:
        _LOADED[path] = Transducer(path)
    return _LOADED[path]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))


def _chunk_maps(rows: DataFrame, tokenizer: str, chunk: int) -> DataFrame:
    """One row per chunk of each different (doc_id, text): key columns, seq, copies, head, tokens, tail."""
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    cut = rows.select("doc_id", "n_bytes", text_key(F.col("text")).alias("key"), F.posexplode(pieces).alias("seq", "piece"))
    fields = cut.drop("piece").schema
    spread = cut.repartition("key", "seq")
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields] + ["head string", "tokens bigint", "tail string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for batch in batches:
            maps = [machine.chunk_map(text) for text in batch.column(4).to_pylist()]
            heads, tokens, tails = map(list, zip(*maps, strict=True)) if maps else ([], [], [])
            arrays = [*batch.columns[:4], pa.array(heads, pa.string()), pa.array(tokens, pa.int64()), pa.array(tails, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields] + ["head", "tokens", "tail"])

    maps = spread.mapInArrow(run, schema)
    copies = [F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in ("head", "tokens", "tail"))]
    return maps.groupBy("doc_id", "n_bytes", "key", "seq").agg(*copies)


def _scanned(maps: DataFrame, by: list[str], order: str, tokenizer: str, prefix: bool) -> DataFrame:
    """Compose the maps of each group in order: one row per group, or with ``prefix`` the map before each row."""
    names = [c for c in maps.columns if prefix or c in by or c in ("copies", "head", "tokens", "tail")]
    schema = maps.select(*names).schema

    def run(table: pa.Table) -> pa.Table:
        machine = transducer(tokenizer)
        table = table.sort_by(order)
        rows = list(zip(*(table.column(c).to_pylist() for c in ("head", "tokens", "tail")), strict=True))
        before, total = machine.scan(rows)
        kept = table if prefix else table.slice(0, 1)
        heads, tokens, tails = map(list, zip(*(before if prefix else [total]), strict=True))
        new = {"head": pa.array(heads, pa.string()), "tokens": pa.array(tokens, pa.int64()), "tail": pa.array(tails, pa.string())}
        return pa.table([new.get(c, kept.column(c) if c not in new else None) for c in names], names)

    return maps.groupBy(*by).applyInArrow(run, schema)


def chunk_offsets(docs: DataFrame, tokenizer: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_id, n_bytes, seq, tokens_before of every chunk: how many tokens the text before it has on its own."""
    key = ["doc_id", "n_bytes", "key"]
    maps = _chunk_maps(_keyed(docs), tokenizer, chunk).withColumn("block", F.expr(f"seq div {fan}"))
    inner = _scanned(maps, [*key, "block"], "seq", tokenizer, prefix=True)
    totals = _scanned(maps, [*key, "block"], "seq", tokenizer, prefix=False)
    outer = _scanned(totals, key, "block", tokenizer, prefix=True)
    outer = outer.select(*[F.col(c).alias(f"_{c}") for c in (*key, "block", "head", "tokens", "tail")])
    same = (F.col("_doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("_key") == F.col("key")) & (F.col("_n_bytes") == F.col("n_bytes")) & (F.col("_block") == F.col("block"))
    joined = inner.join(outer, same).select("doc_id", "n_bytes", "seq", "copies", "head", "tokens", "tail", "_head", "_tokens", "_tail")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[4:]]
            counts = [machine.tokens_of(machine.compose((r[3], r[4], r[5]), (r[0], r[1], r[2]))) for r in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "seq", "copies", "tokens_before"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, seq int, copies bigint, tokens_before bigint"
    out = joined.mapInArrow(run, schema)
    return out.select("doc_id", "n_bytes", "seq", "tokens_before", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    rows = _keyed(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_tokens bigint"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for batch in batches:
            counts = [machine.count(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for batch in batches:
            maps = zip(*(c.to_pylist() for c in batch.columns[3:]), strict=True)
            counts = [machine.tokens_of(m) for m in maps]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "copies", "n_tokens"])

    short = rows.filter(F.length("text") <= chunk).mapInArrow(whole, schema)
    key = ["doc_id", "n_bytes", "key"]
    maps = _chunk_maps(rows.filter(F.length("text") > chunk), tokenizer, chunk).withColumn("block", F.expr(f"seq div {fan}"))
    blocks = _scanned(maps, [*key, "block"], "seq", tokenizer, prefix=False)
    texts = _scanned(blocks, key, "block", tokenizer, prefix=False)
    counted = texts.select("doc_id", "n_bytes", "copies", "head", "tokens", "tail").mapInArrow(
        totals, f"doc_id {kind}, n_bytes bigint, copies bigint, n_tokens bigint"
    )
    long = counted.select("doc_id", "n_bytes", "n_tokens", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")
    return short.unionAll(long).withColumn("over_limit", F.col("n_tokens") > limit)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)
