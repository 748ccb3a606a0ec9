"""Sharding, classifier, fingerprints, decontamination and secrets against brute force."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorelake.llm import decontaminate, fingerprint, quality, secrets, sharding

TEXTS = [None, "", "a", "é" * 40, "long " * 900, "a", "Line one.\nLine two!\n\nLine three", "x\0y", "🙂🙂"]


def rows():
    rnd = random.Random(4)
    return [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, " ".join(rnd.choice("abcde") for _ in range(rnd.randint(0, 200)))) for i in range(60)]


def test_shards_are_contiguous_balanced_and_gapless(frame):
    data = [*rows(), (None, "no id"), (5, "same id"), (5, "same id")]
    got = sorted(sharding.shard_by_bytes(frame(data), 4).collect(), key=lambda r: (r.shard, r.slot))
    sizes = sorted(len((t or "").encode()) + 1 for _, t in data)
    assert sorted(r.size for r in got) == sizes
    assert sorted(r.text_crc32 for r in got) == sorted(zlib.crc32((t or "").encode()) for _, t in data)
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    for s in range(4):
        own = [r for r in got if r.shard == s]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - sum(sizes) / 4) <= max(sizes)
    assert sharding.shard_by_bytes(frame([])).collect() == []


def test_classifier_learns_and_scores_everything(spark, frame):
    rnd = random.Random(6)
    good = lambda: " ".join(rnd.choice(["apple", "pear", "plum", "fig"]) for _ in range(20))
    bad = lambda: " ".join(rnd.choice(["zzq", "qqz", "%%", "$$x"]) for _ in range(20))
    data = [(i, good() if i % 2 else bad()) for i in range(300)] + [(400, None), (401, "")]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)] + [(1, 0, 0), (5, None, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    docs = frame(data).withColumn("score", F.lit("clash"))
    fitted = quality.fit(docs, labels, buckets=1 << 12)
    got = {r.doc_id: r.score for r in quality.score(docs, fitted, ["doc_id", "score"]).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(got[i] >= 0.5) == bool(i % 2) for i in held]) > 0.97
    assert got[400] == got[401] and 0 <= got[400] <= 1
    marks = {r.doc_id: r.h for r in docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("h")).collect()}
    assert [i for i in range(300) if marks[i]] == held
    assert quality.fit(frame([]), labels).bias == 0.0


def test_scoring_equals_averaging_vectors():
    rng = np.random.default_rng(1)
    text = np.frombuffer("some words some words here".encode(), np.uint8)
    ids, _ = quality.feature_ids(text, np.array([0, len(text)]), 64)
    table, out = rng.normal(size=(64, 4)), rng.normal(size=(4, 2))
    logit = table[ids].mean(axis=0) @ out
    want = np.exp(logit[1]) / np.exp(logit).sum()
    assert quality.Model(table @ (out[:, 1] - out[:, 0]), 0.0).score(text, np.array([0, len(text)]))[0] == pytest.approx(want)


@pytest.mark.parametrize("rows_per_range", [1, 7, 10_000])
def test_fingerprints_and_next_documents(frame, rows_per_range):
    data = rows()
    got = {r.doc_id: r for r in fingerprint.fingerprint_pairs(frame(data), rows_per_range).collect()}
    order = sorted(data, reverse=True)
    prints = {}
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.edited_fingerprint == fingerprint.encode(fingerprint.multiset_sum(fingerprint.paragraphs(new)))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    assert len(got) == len(data)


def test_fingerprints_with_repeated_and_null_ids(frame):
    data = [(None, "n"), (1, "a. b."), (1, "a. b."), (2, "c.")]
    got = fingerprint.fingerprint_pairs(frame(data), 1).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 5), (1, 5), (2, 2)]
    assert fingerprint.fingerprint_pairs(frame([])).collect() == []


def test_multiset_hash_is_homomorphic():
    parts = [f"p{i}".encode() for i in range(9)]
    whole = fingerprint.multiset_sum(parts)
    assert np.array_equal(whole, fingerprint.multiset_sum(parts[::-1]))
    assert np.array_equal(fingerprint.delete(whole, parts[3]), fingerprint.multiset_sum(parts[:3] + parts[4:]))
    assert np.array_equal(fingerprint.insert(whole, parts[3]), fingerprint.multiset_sum([*parts, parts[3]]))
    half = fingerprint.multiset_sum(parts[:5] + [b"other"] * 1)
    assert 0.3 < fingerprint.likeness(whole, half) < 0.95 and fingerprint.likeness(whole, whole) == 1


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items, window):
    words, hit, found = words_of(text), set(), set()
    for item_id, item in items:
        parts = words_of(item)
        width = min(window, len(parts))
        for j in range(len(parts) - width + 1) if width else ():
            for i in range(len(words) - width + 1):
                if words[i : i + width] == parts[j : j + width]:
                    hit.update(range(i, i + width))
                    found.add(str(item_id))
    return len(words), hit, sorted(found)


@pytest.mark.parametrize(("window", "block_bytes"), [(3, 1 << 20), (4, 60), (10, 1 << 20)])
def test_decontamination_equals_brute_force(spark, frame, window, block_bytes):
    rnd = random.Random(window)
    say = lambda n: rnd.choice([" ", "\n", ", "]).join(rnd.choice(["a", "B", "é", "x9", "q"]) for _ in range(n))
    items = [(i, say(rnd.randint(0, 9))) for i in range(8)] + [(3, "dup id here"), (50, None), (51, "--")]
    data = [(i, say(rnd.randint(0, 40))) for i in range(40)] + [(None, "a B"), (90, None), (91, ""), (0, items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(frame(data).withColumn("items", F.lit("clash")), bench, window, shard_bytes=100, block_bytes=block_bytes)
    got = sorted((tuple(r) for r in decontaminate.digest_columns(found).collect()), key=repr)
    want = []
    for doc_id, text in data:
        n, hit, ids = brute_hits(text, items, window)
        want.append((doc_id, n, len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    assert got == sorted(want, key=repr)
    cut = decontaminate.find_contamination(frame(data), bench, window, block_bytes=block_bytes, remove=True)
    for r in cut.where("doc_id >= 1 and doc_id < 40").collect():
        text = dict(data[1:40])[r.doc_id]
        _, hit, _ = brute_hits(text, items, window)
        assert words_of(r.text) == [w for i, w in enumerate(words_of(text)) if i not in hit]


def test_secrets_base_pattern_and_layers(frame):
    secret = "token = 'abcdefgh12'"
    packed = base64.b64encode(gzip.compress(secret.encode())).decode()
    twice = urllib.parse.quote(base64.b64encode(urllib.parse.quote(secret).encode()).decode(), safe="")
    escaped = "k\\u0074oken=abcdefgh99"
    data = [
        (1, f"ü x {secret}"), (2, f"see {packed} end"), (3, f"see {twice} end"), (4, escaped), (5, None), (6, "token=token: abcdefgh99"),
        (7, "AKIA" + "A" * 11 + " AKIA" + "B" * 12), (8, "0" * 31 + " " + "f" * 32), (9, "ſecret=abcdefghij"), (9, "to%6ben%3Dabcdefgh1"),
    ]
    got = {(r.doc_id, r.n_assign): r for r in secrets.digest_columns(secrets.scan_secrets(frame(data).withColumn("base", F.lit(1)))).collect()}
    one = lambda i: next(r for (d, _), r in got.items() if d == i)
    assert one(1).spans == f"assign:4:{4 + len(secret) - 1}" and one(1).n_assign == 1
    assert one(1).base_sha256 == hashlib.sha256(one(1).spans.encode()).hexdigest()
    assert one(2).spans == f"assign:4:{4 + len(packed)}" and one(2).n_assign == 0
    assert "assign:4:" in one(3).spans and one(3).n_assign == 0
    assert one(4).spans == f"assign:1:{len(escaped)}"
    assert one(5).spans == "" and one(6).spans == ""
    assert one(7).n_access == 1 and one(8).n_hex == 1
    assert one(9).n_assign == 0


@pytest.mark.parametrize(
    "text", ["{\\u0022password\\u0022: \\u0022hunter2secret99\\u0022}", "\\u0070assword: abcdefgh12", "api%5Fkey = abcdefgh12", "<b>secret%3A</b> tok%65n%20:  %22abcdefgh12"]
)
def test_secrets_with_spaces_beside_escapes(text):
    base, added = secrets.find_secrets(text)
    (start, kind, end), *more = added
    key = max(text.find(k) for k in ("password", "\\u0070", "api", "tok%"))
    assert base == more == [] and kind == 0 and start == key and end == len(text) - (len("\\u0022}") if "hunter" in text else 0)


@pytest.mark.parametrize("width", [10, 64, 70, 76])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
@pytest.mark.parametrize("breaks", ["\n", "\r\n  "])
def test_secrets_in_wrapped_base64(width, pack, breaks):
    rnd = random.Random(width)
    noise = lambda: " ".join(str(rnd.random()) for _ in range(12))
    for shift in range(60):  # the secret stands over a break of every kind
        code = base64.b64encode(pack(("," * shift + noise() + " token = 'abcdefgh12' " + noise()).encode())).decode()
        code = breaks.join(code[i : i + width] for i in range(0, len(code), width))
        _, added = secrets.find_secrets(f"see {code}\n\nThe end")
        if pack is bytes:  # mapped to the signs that hold the find, line breaks between them included
            signs = [i for i, c in enumerate(code) if not c.isspace()]
            inside = base64.b64decode("".join(code.split()))
            at, to = inside.index(b"token"), inside.index(b"12'") + 2
            assert (4 + signs[at * 4 // 3], 0, 5 + signs[-(-to * 4 // 3) - 1]) in added
        else:
            assert (4, 0, 4 + len(code)) in added


@pytest.mark.parametrize("char", [b"\0", "\u00a0".encode(), "\u200b".encode(), "\u3000".encode(), b"\xff", b"\xc3"])
def test_secrets_beside_any_bytes(char):
    for pack in (bytes, gzip.compress, zlib.compress, bz2.compress):
        raw = b"some " + char + b" text, token: abcdefgh12 " + char + b" end"
        code = base64.b64encode(pack(raw)).decode()
        at = raw.index(b"token")
        exact = (2 + at * 4 // 3, 0, 2 - (-(at + 17) * 4 // 3))
        assert (exact if pack is bytes else (2, 0, 2 + len(code))) in secrets.find_secrets(f"\u00e9 {code} x")[1]


@pytest.mark.parametrize("packs", [[p, *q] for p in (gzip.compress, zlib.compress, bz2.compress) for q in ([], [gzip.compress], [bz2.compress], [zlib.compress, gzip.compress])])
@pytest.mark.parametrize("lead", ["", "x", "xx"])
def test_secrets_in_streams_above_a_layer(packs, lead):
    rnd = random.Random(3)
    noise = lambda n: " ".join(f"\u00e9{rnd.random()}\u65e5" for _ in range(n))
    nested = base64.b64encode(gzip.compress(b"AKIA" + b"A" * 16)).decode()
    raw = f"{lead}{noise(700)} token {' ' * 9000}= 'abcdefgh12' {noise(700)} {nested} {'0' * 40} {noise(2)}".encode()
    for pack in packs:
        half = rnd.randrange(len(raw))  # streams that follow each other are one
        raw = pack(raw[:half]) + pack(raw[half:])
    code = base64.b64encode(raw).decode()
    for max_layer in (1000, 1001, 6000, secrets.MAX_LAYER):
        assert secrets.find_secrets(f"see {code}.", max_layer) == ([], [(4, kind, 4 + len(code)) for kind in (0, 1, 2)])


def test_secrets_before_a_stray_character():
    code = base64.b64encode(b"token: abcdefgh12!").decode()
    assert secrets.find_secrets(f"{code}x") == ([], [(0, 0, -(-17 * 4 // 3))])


DEFLATE = lambda raw: (lambda c: c.compress(raw) + c.flush())(zlib.compressobj(9, zlib.DEFLATED, -15))
SECRET = "password=hunter2secret99"


def b64(raw):
    return base64.b64encode(raw if isinstance(raw, bytes) else raw.encode()).decode()


@pytest.mark.parametrize("prefix", ["see data/", "a/", "ab/", "abc/", "abcd/", "https://e.org/a/", "a-", "x_y-", "key+"])
@pytest.mark.parametrize("alphabet", [None, b"-_"])
def test_secrets_after_what_shifts_their_base64(prefix, alphabet):
    for tail in ("", " ???>>>~~~ end"):  # signs of either alphabet
        code = base64.b64encode((SECRET + tail).encode(), altchars=alphabet).decode() if alphabet else b64(SECRET + tail)
        base, added = secrets.find_secrets(f"{prefix}{code} x")
        assert base == [] and (len(prefix), 0, len(prefix) + 32) in added
        for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, DEFLATE):
            code = b64(pack((SECRET + tail).encode()))
            added = secrets.find_secrets(f"{prefix}{code} x")[1]
            assert any(kind == 0 and start < len(prefix) + len(code) <= end for start, kind, end in added), pack


def test_two_secrets_in_one_stretch_are_two_spans():
    text = f"{SECRET} and token: abcdefgh12345"
    assert secrets.find_secrets(b64(text))[1] == [(0, 0, 32), (38, 0, 66)]


@pytest.mark.parametrize(
    "code", ["".join(f"\\U{ord(c):08x}" for c in SECRET), "".join(f"\\u{{{ord(c):x}}}" for c in SECRET), "".join(f"%u{ord(c):04X}" for c in SECRET), "password+%3D+hunter2secret99", b64(SECRET.encode("utf-16-le")), b64(SECRET.encode("utf-16-be")), b64(SECRET.encode("utf-16"))]
)
def test_secrets_in_further_forms(code):
    base, added = secrets.find_secrets(f"é {code} x")
    assert base == [] and added and all(2 <= start and end <= 2 + len(code) for start, _, end in added)


def test_planted_secrets_are_found_whatever_encodes_them():
    """Random nestings of encodings around a secret, with prefixes: all found, inside the planted place."""
    rnd = random.Random(11)
    text_forms = [lambda t: urllib.parse.quote(t, safe=""), lambda t: "".join(f"\\u{ord(c):04x}" for c in t), lambda t: "".join(f"%u{ord(c):04x}" for c in t), lambda t: "".join(f"\\x{ord(c):02x}" for c in t)]
    byte_forms = [bytes, gzip.compress, zlib.compress, bz2.compress, lzma.compress, DEFLATE]
    for n in range(150):
        planted = rnd.choice([SECRET, "AKIA" + "Q7" * 8, "0123456789abcdef" * 2, "api_key: Zx81mmpqRT"])
        code = f"{rnd.choice(['', 'so ', 'é, '])}{planted}{rnd.choice(['', ' end', chr(10)])}"
        for _ in range(rnd.randint(1, 3)):
            if rnd.random() < 0.4 and len(code) < 400 and all(ord(c) < 128 for c in code):
                code = rnd.choice(text_forms)(code)
            else:
                packed = rnd.choice(byte_forms)(code.encode())
                # Stretches of fewer than 16 signs aren't taken for base64.
                code = rnd.choice(["", "", "data/", "a-"]) + b64(packed if len(packed) >= 12 else code)
        lead = rnd.choice(["", "see ", "日本 "])
        added = secrets.find_secrets(f"{lead}{code} done")[1]
        if planted not in code:
            assert any(len(lead) <= start and end <= len(lead) + len(code) for start, _, end in added), (n, planted, code[:200])


def test_secrets_in_a_megabyte_stream():
    code = base64.b64encode(gzip.compress(("x" + "\u00e9" * 3_000_000 + " token=abcdefgh12").encode())).decode()
    assert secrets.find_secrets(code)[1] == [(0, 0, len(code))]


def base_by_hand(text):
    """The contract's three patterns by a scanner of its own."""
    found = []
    word, hexes, big = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    value = word + word.upper() + "0123456789+/_.=-"
    lower = lambda c: c.lower() if c in word.upper() else c
    i = 0
    while i < len(text):
        end = 0
        for key in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            if [lower(c) for c in text[i : i + len(key)]] == list(key):
                j = i + len(key)
                for quoted in (1, 0):  # quotes are optional, taken where they can be
                    k = j + (quoted and text[j : j + 1] in ("'", '"'))
                    while text[k : k + 1] == " ":
                        k += 1
                    if text[k : k + 1] not in (":", "=") or k >= len(text):
                        continue
                    k += 1
                    while text[k : k + 1] == " ":
                        k += 1
                    k += text[k : k + 1] in ("'", '"') and k < len(text)
                    m = k
                    while m < len(text) and text[m] in value:
                        m += 1
                    if m > k:
                        end, size = m, m - k
                        break
            if end:
                break
        if end:
            if size >= 8:
                found.append((i, 0, end))
            i = end
        else:
            i += 1
    for kind, start, signs, least in ((1, "AKIA", big, 16), (2, "", hexes, 32)):
        i = 0
        while i < len(text):
            j = i + len(start)
            while j < len(text) and text[j] in signs:
                j += 1
            if text.startswith(start, i) and j > i + len(start):
                if j - i >= least:
                    found.append((i, kind, j))
                i = j
            else:
                i += 1
    return sorted(found)


def test_secrets_base_kinds_equal_brute_force():
    rnd = random.Random(12)
    bits = ["password", "PassWd", "secret", "token", "api_key", "apikey", "'", '"', " ", "  ", ":", "=", "abc", "deadbeef", "0123456789", "AKIA", "ABCDEF123", "\u017f", "\u212a", ".", "\u00e9", "f" * 31, "=", "x-y"]
    n = 0
    for _ in range(6000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 25)))
        assert secrets.scan(text) == base_by_hand(text), text
        n += len(secrets.scan(text))
    assert n > 2000


def test_secrets_in_escaped_compressed_bytes(frame):
    for pack in (gzip.compress, zlib.compress, bz2.compress):
        code = urllib.parse.quote(pack(b"some words, token: abcdefgh12, and others"), safe="")
        assert (4, 0, 4 + len(code)) in secrets.find_secrets(f"see {code} x")[1]
    assert secrets.scan_secrets(frame([])).collect() == []


def test_training_rows_are_bounded_by_rows(spark, frame):
    docs = frame([(i % 2 * 3, f"text {i % 7}") for i in range(900)])
    labels = spark.createDataFrame([(0, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    held = [i for i in (0, 3) if zlib.crc32(str(i).encode()) % 3 == 1]
    got = quality.training_rows(docs, labels, 2).collect()
    assert len(got) == (2 if len(held) < 2 else 0)
    assert len({(r.quality, r.text) for r in quality.training_rows(docs, labels, 1000).collect()}) == 7 * (2 - len(held))


def test_items_without_an_id_and_clashing_columns(spark, frame):
    items = spark.createDataFrame([(None, "a b c"), (7, "a b c"), (2, "x y z"), (None, None)], "item_id long, text string")
    docs = frame([(1, "q a b c q"), (2, "x y z"), (3, None)]).withColumns({"_row": F.lit("r"), "_spans": F.lit("s")})
    for block_bytes in (1 << 20, 4):
        found = decontaminate.find_contamination(docs, items, 3, block_bytes=block_bytes)
        assert {"_row", "_spans"} < set(found.columns)
        assert sorted((r.doc_id, r["_row"], r["_spans"], r["items"], [tuple(s) for s in r.spans]) for r in found.collect()) == [
            (1, "r", "s", ["7"], [(1, 4)]), (2, "r", "s", ["2"], [(0, 3)]), (3, "r", "s", [], [])
        ]
    long = " ".join(["w"] * 300_000 + ["a", "b", "c"] + ["v"] * 300_000)
    assert decontaminate.find_contamination(frame([(1, long)]), items, 3).first().spans[0].first == 300_000


def test_fingerprints_of_many_parts_and_of_one_id(frame):
    one = lambda n: fingerprint.multiset_sum([b"same sentence."] * n)
    for few, many in ((300, 400), (30_000, 40_000), (3, 70_000)):
        assert fingerprint.likeness(one(few), one(many)) > 0.99
    # Lanes by a plain reading of the digest.
    parts = [b"a", b"b", b"b"]
    want = np.zeros(fingerprint.LANES, np.int64)
    for p in parts:
        digest = hashlib.blake2b(p, digest_size=fingerprint.LANES // 8).digest()
        want += [1 if digest[i // 8] >> (7 - i % 8) & 1 else -1 for i in range(fingerprint.LANES)]
    assert (fingerprint.multiset_sum(parts) == want).all()
    # Rows of one id, and of none, fall into several ranges and are still one ring.
    data = [(5, f"text {i}. more {i}.") for i in range(40)] + [(None, f"null {i}.") for i in range(40)] + [(9, "nine."), (1, "x. " * 200_000)]
    got = fingerprint.fingerprint_pairs(frame(data).withColumns({"id": F.lit(1), "hash": F.lit("h"), "range": F.lit(0)}), 5).collect()
    assert len(got) == len(data) and sorted(r.n_chars for r in got) == sorted(len(t) for _, t in data)
    nine = next(r for r in got if r.doc_id == 9)
    follow = {hashlib.sha256(("nin" + t[:2]).encode()).hexdigest() for i, t in data if i == 5}
    assert nine.edited_sha256 in follow


def parts_by_hand(text):
    """Sentences and pairs of words, told character by character."""
    found, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] not in ".!?\r\n":
            end += 1
        stop = end
        while end > at and stop < len(text) and text[stop] in ".!?":
            stop += 1
        sentence = text[at:stop].strip().encode()
        if end > at and sentence:
            words = sentence.split()
            found += [sentence] + ([words[i] + b" " + words[i + 1] for i in range(len(words) - 1)] or words)
        at = max(stop, at + 1)
    return found


def test_likeness_of_short_long_and_repeated_texts_equals_brute_force(frame):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(1, 9)))
    some = lambda n: "".join(word() + rnd.choice([" ", " ", " ", "  ", ". ", "? ", "\n", "..", "!\r\n", ".\n\n"]) for _ in range(n))
    texts = [some(rnd.randrange(0, 30)) for _ in range(60)] + [None, "", "...", "a", "é. ü", " . x", some(60_000), "one " * 90_000]
    data = [(i, t) for i, t in enumerate(texts + texts[:9])]
    got = {r.doc_id: r for r in fingerprint.fingerprint_pairs(frame(data), 9).collect()}
    for doc_id, text in data:
        text, following = text or "", data[doc_id - 1][1] or ""
        half = len(text) // 2
        prints = [fingerprint.multiset_sum(parts_by_hand(t)) for t in (text, text[: len(text) - half] + following[:half], following)]
        r = got[doc_id]
        assert (r.fingerprint, r.edited_fingerprint) == tuple(fingerprint.encode(p) for p in prints[:2])
        for found, other in ((r.near_edited, prints[1]), (r.near_next, prints[2])):
            if (prints[0] == other).all():
                assert found == 1
            else:
                x, y = [float(v) for v in prints[0]], [float(v) for v in other]
                size = (sum(v * v for v in x) * sum(v * v for v in y)) ** 0.5
                assert found == pytest.approx(max(0, sum(a * b for a, b in zip(x, y)) / size) if size else 0, abs=1e-8)


def test_short_texts_outlive_an_edit(frame):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(5))
    data = [(i, " ".join(word() for _ in range(8)) + ".") for i in range(200)]
    got = fingerprint.fingerprint_pairs(frame(data)).collect()
    assert sum(r.near_edited > r.near_next for r in got) >= 196 and np.mean([r.near_edited for r in got]) > 0.3


def test_likeness_estimates_the_cosine_of_multisets():
    rng, seen = random.Random(2), []
    for _ in range(60):
        parts = [f"part {rng.randrange(40)}".encode() for _ in range(60)]
        other = [rng.choice([p, f"part {rng.randrange(40)}".encode()]) for p in parts]
        count = lambda ps: {p: ps.count(p) for p in ps}
        x, y = count(parts), count(other)
        true = sum(n * y.get(p, 0) for p, n in x.items()) / (sum(n * n for n in x.values()) * sum(n * n for n in y.values())) ** 0.5
        seen.append(fingerprint.likeness(fingerprint.multiset_sum(parts), fingerprint.multiset_sum(other)) - true)
    assert abs(np.mean(seen)) < 0.03 and np.std(seen) < 0.12


@pytest.mark.parametrize("packs", [[], [gzip.compress], [bz2.compress]])
def test_secrets_at_the_end_of_raw_deflate_above_a_layer(packs):
    """Raw deflate, and what is packed in it, is read to its end, not up to a layer's size."""
    rnd = random.Random(21)
    raw = b" ".join(str(rnd.random()).encode() for _ in range(400)) + b" token = 'abcdefgh12' AKIA" + b"A" * 16 + b" " + b"0" * 40
    for pack in [*packs, DEFLATE]:
        raw = pack(raw)
    code = b64(raw)
    for max_layer in (1000, 1001, 6000, secrets.MAX_LAYER):
        added = secrets.find_secrets(f"see {code}.", max_layer)[1]
        assert {(4, kind, 4 + len(code)) for kind in (0, 1, 2)} <= set(added), max_layer


def test_secrets_stand_anywhere_in_long_texts(frame):
    """Every text is scanned to its end: each part of it that has a secret of each kind, plain or packed, is found."""
    plain = "token = 'abcdefgh12' AKIA" + "A" * 16 + " " + "0" * 40
    packed, filler = b64(gzip.compress(plain.encode())), "some words in between " * 60_000
    text = "".join(f"{filler}{plain} {packed} " for _ in range(5))
    (r,) = secrets.digest_columns(secrets.scan_secrets(frame([(1, text)]))).collect()
    assert len(text) > 6_000_000 and (r.n_assign, r.n_access, r.n_hex) == (5, 5, 5)
    assert sum(int(x.split(":")[2]) - int(x.split(":")[1]) == len(packed) for x in r.spans.split(",")) == 15
    assert int(r.spans.split(",")[-1].split(":")[2]) == len(text) - 1


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, DEFLATE])
@pytest.mark.parametrize("lead", ["", "x ", "data/", "a-b/"])
def test_secrets_packed_in_base64_longer_than_a_piece_of_a_stream(pack, lead):
    """What base64 in a stream holds is unpacked to its end, also where the stretch is longer than the stream's pieces."""
    rnd = random.Random(31)
    raw = " ".join(str(rnd.random()) for _ in range(400)) + " token = 'abcdefgh12' AKIA" + "A" * 16 + " " + "0" * 40
    inner = b64(pack(raw.encode()))
    wrapped = "\n".join(inner[i : i + 76] for i in range(0, len(inner), 76))
    for text in (inner,) if "/" in lead else (inner, wrapped, b64(inner)):
        for outer in (gzip.compress, DEFLATE):
            code = b64(outer(f"Before: {lead}{text}; after it.".encode()))
            for max_layer in (1500, secrets.MAX_LAYER):
                assert {(4, kind, 4 + len(code)) for kind in (0, 1, 2)} <= set(secrets.find_secrets(f"see {code}.", max_layer)[1]), (max_layer, outer)
