"""The corpus operators against plain Python on a small table with nulls, ties, repeats and clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from gaugeflow.llm import fingerprint, jaccard, langid, license_scan, line_dedup, mixing, packing, quality, secrets, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node bigint, size string, key string"


def make_rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(30, 90))]
        text = "\n".join(" ".join(words[k : k + 12]) for k in range(0, len(words), 12))
        rows.append([i, text, "en" if i % 2 else "de", f"s{i % 7}"])
        if i % 6 == 0:  # a near copy and an exact one
            rows.append([100 + i, text.replace(words[3], "other", 1), "en", f"s{i % 5}"])
            rows.append([200 + i, text.upper() if i % 12 else text, "en", None])
    for i in range(300, 312):
        rows.append([i, "the same line on all sites\n" + rows[i - 300][1][::-1], None, f"s{i % 8}"])
    rows += [[400, None, None, None], [401, "", "en", "s1"], [402, " \t\n ", "en", "s1"], [403, "one two", "de", "s2"]]
    rows += [[404, "ONE two", "de", "s2"], [405, "x" * 5000 + " é🙂 " + "lang " * 3000, "fr", "s3"], [None, "no id here at all", "en", "s9"]]
    rows.append(list(rows[0]))  # a repeated row
    return [(r[0], r[1], r[2], r[3], len(r[1] or ""), 1, "x", None) for r in rows]


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(60)] + [(7, 1, None), (999, 0, 1)], "doc_id bigint, quality int, toxic int")


def shingle_set(text):
    words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(5)), strict=False))


def test_jaccard_components(docs):
    sets = [shingle_set(r[1]) for r in ROWS]
    root = list(range(len(ROWS)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ROWS)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for k, r in enumerate(ROWS):
        ids[find(k)].append(r[0])
    want = sorted(
        ((r[0], len(sets[k]), r[0] if not sets[k] else min((i for i in ids[find(k)] if i is not None), default=None)) for k, r in enumerate(ROWS)),
        key=repr,
    )
    assert sorted(map(tuple, jaccard.components(docs).collect()), key=repr) == want
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    heads = {find(k) for k in range(len(ROWS)) if sets[k]}
    assert kept.count() == len(heads) + sum(not s for s in sets)


def test_prefixes_share_enough_tokens():
    rng = np.random.default_rng(3)
    for _ in range(300):
        base = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 80), dtype=np.uint64))
        other = np.unique(np.concatenate([base[rng.random(len(base)) < 0.95], rng.integers(0, 1 << 63, 2, dtype=np.uint64)]))
        common = len(np.intersect1d(base, other))
        if 100 * common < 80 * (len(base) + len(other) - common):
            continue
        heavy = np.unique((rng.choice(base, 5) >> np.uint64(32)).astype(np.uint32))
        often = rng.integers(16, 900, len(heavy))
        (a, _, room_a, m), (b, _, room_b, n) = jaccard.prefix(base, heavy, often), jaccard.prefix(other, heavy, often)
        shared, at_a, at_b = np.intersect1d(a, b, return_indices=True)
        assert len(shared) >= min(m, n)
        room = np.minimum(room_a[at_a], room_b[at_b]).max()  # at the first common token
        assert 180 * room >= 80 * (len(base) + len(other))


def test_language(docs):
    got = langid.identify(docs, per_language=1000).collect()
    assert len(got) == len(ROWS)
    text = {r[0]: r[1] for r in ROWS}
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text[r.doc_id] or ""))
        assert 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() <= len(ROWS) - 3


def test_language_of_plain_texts(spark):
    say = {"en": "the house and the garden with a white fence ", "de": "das haus und der garten mit dem zaun "}
    rows = [(i, " ".join(random.Random(i).sample(say[lang].split(), 5)), lang) for i in range(200) for lang in [("en", "de")[i % 2]]]
    got = langid.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).filter("held_out").collect()
    want = {r[0]: r[2] for r in rows}
    assert sum(r.lang_pred == want[r.doc_id] for r in got) >= 0.97 * len(got)


def test_toxicity(docs, labels, spark):
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    rng = random.Random(1)
    plain = [f"w{k}" for k in range(200)]
    rows, known = [], []
    for i in range(2000):
        bad = i % 10 == 0
        rows.append((i, " ".join(rng.choices(plain, k=40) + (rng.sample(["vile", "awful", "nasty"], 2) if bad else []))))
        known.append((i, int(bad)))
    many = toxicity.toxicity(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(known, "doc_id bigint, toxic int"))
    held = many.filter("held_out").collect()
    assert sum(r.predicted == (r.doc_id % 10 == 0) for r in held) >= 0.97 * len(held)


def statistics(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for k in range(len(words) - 7):
        at[tuple(words[k : k + 8])].append(k)
    covered = {j for v in at.values() if len(v) > 1 for k in v for j in range(k, k + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality(docs):
    got = sorted((tuple(r)[1:6] for r in quality.quality(docs).collect()), key=repr)
    assert got == sorted((statistics(r[1]) for r in ROWS), key=repr)


def test_quality_rejects_the_odd_one(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("abcde"[: rng.randint(2, 5)] + str(rng.randint(0, 99)) for _ in range(rng.randint(80, 120))), "en", "s") for i in range(200)]
    rows.append((900, " ".join("word### $$$&&&" for _ in range(50)) + " " + " ".join(map(str, range(60))), "en", "s"))
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert not got[900].kept and all(got[i].kept for i in range(200))


def test_mixing(docs):
    rows = mixing.mix(docs).collect()
    assert sorted(((r.doc_id, r.size) for r in rows), key=repr) == sorted(((r[0], len(WORD.findall(r[1] or ""))) for r in ROWS), key=repr)
    taken, size, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) < 1 and target[s] <= 2 * size[s] for s in size)
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix(docs).collect()), key=repr)
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    assert abs(sum(len(WORD.findall(r.text)) for r in out.collect()) - sum(taken.values())) <= 2


def test_packing(docs):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack(docs, path).collect()
    want = defaultdict(list)
    for r in ROWS:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want[r[0]].append(ids)
    for r in rows:
        assert any(len(i) == r.doc_tokens and zlib.crc32(i[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for i in want[r.doc_id])
    assert sum(r.length for r in rows) == sum(len(i) for v in want.values() for i in v)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.LENGTH


def test_encoder_agrees_with_the_tokenizer():
    encode = packing.encoder(packing.default_tokenizer())
    texts = ["a  b", " a", "it's \n\n x", "é🙂 ok", "<|endoftext|> a", "a b\n", "a\tb c\n\nd e's", "x " * 50 + "y", "naïve über-alles 12,345.6"]
    by_library = [np.array(encode.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert [encode.encode(t) for t in texts] == by_library
    assert [encode.whole(t) for t in texts] == by_library


def test_kept_words_stay_within_their_bytes(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_BYTES", 5000)
    encode, rng = packing.Encoder(packing.default_tokenizer()), random.Random(1)
    for _ in range(50):
        text = "a " + " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 300))) for _ in range(30))
        ids = np.array(encode.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        assert encode.encode(text) == ids.tobytes()
        assert encode.held <= 5000 and all(len(w) <= packing.LONGEST_WORD for w in encode.memo)


def test_packing_of_text_ids(spark):
    docs = spark.createDataFrame([("k", "one two"), (None, "three"), ("j", None)], "doc_id string, text string")
    rows = packing.pack(docs, packing.default_tokenizer()).collect()
    assert sorted((r.doc_id or "", r.length, r.sequence_id) for r in rows) == [("", 2, 0), ("j", 1, 0), ("k", 3, 0)]


def test_first_fit_decreasing():
    rng = random.Random(4)
    sizes = sorted((rng.randint(1, 100) for _ in range(300)), reverse=True)
    bins, room = [], []
    for i, s in enumerate(sizes):
        place = next((k for k, r in enumerate(room) if r >= s), len(room))
        if place == len(room):
            bins.append([])
            room.append(100)
        bins[place].append(i)
        room[place] -= s
    assert packing.first_fit_decreasing(sizes, 100) == bins
    parts = packing.fill_gaps(bins, sizes, 100)
    assert sum(n for p in parts for _, _, n in p) == sum(sizes)
    assert sum(sum(n for _, _, n in p) < 100 for p in parts) <= 1


def test_line_dedup(docs):
    lines = defaultdict(lambda: (set(), []))
    for r in ROWS:
        for pos, line in enumerate((r[1] or "").split("\n")):
            if line.strip(" \t\n\x0b\f\r"):
                sites, places = lines[line.strip(" \t\n\x0b\f\r")]
                sites.add(r[3])
                places.append((r[0] is not None, r[0] or 0, pos))
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "_removed"]
    want = []
    for r in ROWS:
        kept = [
            line
            for pos, line in enumerate((r[1] or "").split("\n"))
            if len(lines[line.strip(" \t\n\x0b\f\r")][0]) < line_dedup.MIN_SITES
            or min(lines[line.strip(" \t\n\x0b\f\r")][1]) == (r[0] is not None, r[0] or 0, pos)
        ]
        want.append((r[0], None if r[1] is None else "\n".join(kept)))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)


KEY = bytes.fromhex("30130609608648016503040201") + b"\x04\x06secret"


def test_secrets(docs, spark):
    import base64
    import json

    der = b"\x30\x24" + b"\x02\x10" + bytes(range(16)) + b"\x02\x10" + bytes(range(50, 66))
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()).decode().rstrip("=")
    texts = [
        'é password = "abcd1234" x', "token: short", "AKIA" + "B" * 16, "API_KEY=0123456789abcdef0123456789abcdef!",
        base64.b64encode(der).decode(), der.hex(), f"see {head}.eyJhIjoxfQ.c2ln end", "A" * 64, base64.b64encode(b"password=hunter2000000").decode(),
        f"-----BEGIN PRIVATE KEY-----\n{base64.b64encode(der).decode()}\n-----END PRIVATE KEY-----", None, "",
    ]
    got = [r for r in sorted(secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect())]
    assert got[0].spans == "assign:2:22" and got[1].spans == "" and got[2].n_access == 1
    assert got[3].spans == "assign:0:40,hex:8:40"
    kinds = [{s.split(":")[0] for s in r.spans.split(",") if s} for r in got]
    assert kinds[4] == {"der"} and kinds[5] == {"hex", "der"} and kinds[6] == {"jwt"} and kinds[7] == set() and kinds[8] == {"nested"} and kinds[9] == {"der"}
    assert got[3].base_sha256 == hashlib.sha256(got[3].spans.encode()).hexdigest()
    assert secrets.scan(docs).count() == len(ROWS)


def test_license_scan(docs, spark):
    mit = license_scan.TEMPLATES["MIT"]
    texts = ["nothing to see", "x. Released under the MIT License. y", "aa bb " + mit.replace("copies", "COPY", 1) + " zz", None, ""]
    got = sorted(license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect())
    assert [r.licenses for r in got] == ["", "MIT-line", "MIT", "", ""]
    assert got[1].spans == "MIT-line:3:33" and got[1].coverage == 1.0 and 0.95 < got[2].coverage < 1
    assert license_scan.scan(docs).count() == len(ROWS)


def test_fingerprints(docs):
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for k, r in enumerate(order):
        text, following = r[1] or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        same = next((i for i, (a, b) in enumerate(zip(text, edited, strict=False)) if a != b), min(len(text), len(edited)))
        want.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), same))
    got = fingerprint.compare_edits(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.same_start) for r in got), key=repr) == sorted(want, key=repr)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_span_hashes():
    rng = random.Random(6)
    text = "".join(rng.choice("ab") for _ in range(300))
    p = fingerprint.Prefixes(fingerprint.code_points(text))
    for _ in range(300):
        i, j, n = rng.randrange(250), rng.randrange(250), rng.randrange(12)
        assert (p.span(i, i + n) == p.span(j, j + n)) == (text[i : i + n] == text[j : j + n])
        common = next((k for k in range(300 - max(i, j)) if text[i + k] != text[j + k]), 300 - max(i, j))
        assert fingerprint.common_extension(p, i, p, j) == common


@pytest.mark.parametrize(
    "run",
    [
        lambda d, l: toxicity.toxicity(d, l), lambda d, l: license_scan.scan(d), lambda d, l: quality.quality(d), lambda d, l: langid.identify(d),
        lambda d, l: mixing.mix(d), lambda d, l: mixing.apply_mix(d), lambda d, l: packing.pack(d, packing.default_tokenizer()),
        lambda d, l: line_dedup.dedup_lines(d), lambda d, l: secrets.scan(d), lambda d, l: jaccard.components(d), lambda d, l: jaccard.keep_one(d),
        lambda d, l: fingerprint.compare_edits(d),
    ],
)
def test_empty_table(run, empty, labels):
    assert run(empty, labels.limit(0)).collect() == []
