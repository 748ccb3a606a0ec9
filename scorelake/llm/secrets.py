"""Secret scans by a recursive decoding worklist.

A text is layer 0.  Every layer is scanned with the three patterns; it becomes a further layer as a
whole with its URL escapes undone (once more with ``+`` as a space), one with its Unicode escapes
undone, and each base64 or compressed stretch in it becomes one, until nothing new turns up.

Base64 is read in both alphabets at once.  What stands before it (a path, a word and a hyphen) can
belong to the same signs and shift it, so a stretch is decoded from each of its first four signs: any
start inside it is in step with one of them.  Packed content (gzip, zlib, bzip2, xz, raw deflate) is
looked for at the stretch's start and after each sign that can separate.  Text in UTF-16 is read as such.
Base64 wrapped into lines is decoded line by line and as one stretch.  A layer whose content and
place were seen before isn't opened again, so self-reproducing archives end.  Finds in a decoded layer
are mapped to code points of the text: exactly through escapes, through plain base64 to the signs that
hold the find's bytes, to the whole encoded stretch through packed content.

Each document is scanned where it is read: no shuffle.  Null counts as empty; repeated rows are
scanned each; input columns named like a result column are replaced.  Decoded bytes
are scanned whatever they are: those that aren't UTF-8 count as replacement characters.  A stream
that unpacks to more than ``max_layer`` characters is scanned in overlapping pieces of about that
size, so a task's memory stays bounded; what is packed in base64 stretches of it that are longer than
a piece is unpacked from the stream itself.  Texts themselves are scanned whole, however long.  An empty table gives no
rows.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import urllib.parse
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import map_arrow

KINDS = ("assign", "access", "hex")
MAX_LAYER = 4 << 20
OVERLAP = 4096

# The patterns of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

KEYWORDS = ("passw", "secret", "token", "api")
IS_HEX = bytes(1 if chr(i) in "0123456789abcdef" else 0 for i in range(256))
HEX_RUN = b"\x01" * 32

BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Signs of base64 that also separate words and paths.
SEPARATOR = re.compile(r"[/+_-]+")
ONE_ALPHABET = str.maketrans("-_", "+/")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
PERCENT_PLUS = re.compile(r"(?:%[0-9A-Fa-f]{2}|\+)+")
#: A compressed stream under URL escapes, by its first bytes.
PACKED_PERCENT = re.compile(r"(?:%1[fF]%8[bB]|BZh[1-9]|%[fF][dD]7zXZ%00|(?:x|%78)%(?:01|5[eE]|9[cC]|[dD][aA]))(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~!*'()/+-])+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\})+")
PERCENT_U = re.compile(r"(?:%u[0-9A-Fa-f]{4})+")
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
#: Base64 stretches of consecutive lines, each up to its line's end but the last; linear, as it starts at a stretch's start only.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{4,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}(?:[ \t]*+\r?\n[ \t]*+={1,2})?")
TAIL = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)*+[ \t\r\n=]*+")
SPACES = re.compile(" {2,}")
#: Bytes of a base64 stretch in a stream, line breaks included, and those among them that something can stand after.
BREAKS = b" \t\r\n"
STRETCH = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-" + BREAKS
OPENS = re.compile(rb"[/+_\s-]+")
ONE_ALPHABET_BYTES = bytes.maketrans(b"-_", b"+/")
UNDECODED = re.compile("[\udc80-\udcff]")

#: A layer: its text, and for each character where it starts and ends in the document; None: identity.
Layer = tuple[str, np.ndarray | None, np.ndarray | None]


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns in one text."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if HEX_RUN in text.encode("utf-8", "surrogatepass").translate(IS_HEX):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


XZ = b"\xfd7z"


def _packed(head: bytes) -> bool:
    """Whether bytes start like a gzip, zlib, bzip2 or xz stream."""
    return head[:2] == b"\x1f\x8b" or head[:3] == b"BZh" or head[:3] == XZ or head[:1] == b"\x78" and len(head) > 1 and int.from_bytes(head[:2], "big") % 31 == 0


def _inflate(chunks: Iterator[bytes], max_layer: int) -> Iterator[bytes]:
    """What a compressed stream, given in pieces, unpacks to, in pieces; streams that follow it join on."""
    rest = b""
    while True:
        while len(rest) < 3 and (more := next(chunks, None)) is not None:
            rest = (rest + more).lstrip(b"\0")
        if not _packed(rest):
            return
        try:
            if rest[:3] in (b"BZh", XZ):
                other = bz2.BZ2Decompressor() if rest[:3] == b"BZh" else lzma.LZMADecompressor(memlimit=256 << 20)
                while not other.eof:
                    if piece := other.decompress(rest, max_layer):
                        yield piece
                    rest = b""
                    if not other.eof and other.needs_input and (rest := next(chunks, None)) is None:
                        return
                rest = other.unused_data
            else:
                one = zlib.decompressobj(47)
                while not one.eof:
                    if piece := one.decompress(rest, max_layer):
                        yield piece
                    rest = one.unconsumed_tail
                    if not one.eof and not rest and not piece and (rest := next(chunks, None)) is None:
                        return
                rest = one.unused_data
        except (zlib.error, lzma.LZMAError, OSError, ValueError):
            return
        rest = rest.lstrip(b"\0")


def _texts(chunks: Iterator[bytes], max_layer: int) -> Iterator[str]:
    """The text of bytes given in pieces, whatever they hold, in overlapping pieces.

    No cut goes through the base64 that it ends in, unless that is longer than a piece.  Spaces are
    drawn together, as the patterns allow any number and all characters stand for one place.
    """
    decoder, text = codecs.getincrementaldecoder("utf-8")("replace"), ""
    for chunk in chunks:
        text += decoder.decode(chunk)
        if len(text) > max_layer:
            text = SPACES.sub(" ", text)
        if len(text) > max_layer:
            yield text
            open_at = next((m.start() for m in TAIL.finditer(text) if m.end() == len(text)), len(text))
            text = text[min(len(text) - min(OVERLAP, max_layer // 2), max(open_at, len(text) - max_layer)) :]
    text += decoder.decode(b"", True)
    if text:
        yield text


def _raw_deflate(chunks: Iterator[bytes | memoryview], max_layer: int) -> Iterator[bytes]:
    """What a raw deflate stream, given in pieces, unpacks to, in pieces, as far as it goes."""
    one, rest = zlib.decompressobj(-15), b""
    try:
        while not one.eof:
            if piece := one.decompress(rest, max_layer):
                yield piece
            rest = one.unconsumed_tail
            if not one.eof and not rest and not piece and (rest := next(chunks, None)) is None:
                return
    except zlib.error:
        return


def _can_deflate(raw: bytes | memoryview) -> bool:
    """Whether the first block's kind fits: 3 is none, 0 has its length twice, 2 has at most 286 codes."""
    kind = raw[0] >> 1 & 3 if len(raw) > 4 else 3
    return not (kind == 3 or kind == 2 and raw[0] >> 3 > 29 or kind == 0 and (raw[1] ^ raw[3] != 255 or raw[2] ^ raw[4] != 255))


def _deflated(raw: memoryview, max_layer: int) -> bool:
    """Whether all these bytes are a raw deflate stream; it has no mark, so it is unpacked, up to ``max_layer`` bytes, to see."""
    if not _can_deflate(raw):
        return False
    one = zlib.decompressobj(-15)
    try:
        out = one.decompress(raw, max_layer)
    except zlib.error:
        return False
    return bool(out) and (len(out) >= max_layer or one.eof and len(one.unused_data) <= 2)


def _characters(raw: bytes) -> tuple[str, np.ndarray]:
    """Bytes as text, and where each character's bytes start (with the end of all): UTF-16 by its zeros, else UTF-8; others count as replacement characters."""
    pairs = len(raw) // 2
    for name, zeros in (("utf-16-le", raw[1 : 2 * pairs : 2]), ("utf-16-be", raw[0 : 2 * pairs : 2])) if pairs >= 4 else ():
        if 4 * zeros.count(0) >= 3 * pairs:
            text = raw[: 2 * pairs].decode(name, "replace")
            sizes = [4 if ord(c) > 0xFFFF else 2 for c in text]
            return text, np.concatenate([[0], np.cumsum(sizes)])
    if raw.isascii():
        return raw.decode("ascii"), np.arange(len(raw) + 1)
    text = raw.decode("utf-8", "surrogateescape")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    sizes[(codes >= 0xDC80) & (codes <= 0xDCFF)] = 1
    return UNDECODED.sub("\ufffd", text), np.concatenate([[0], np.cumsum(sizes)])


def _unwrap_base64(token: str, places: np.ndarray, layer: Layer, max_layer: int) -> Iterator[Layer]:
    """Layers inside a base64 stretch; ``places``: where its signs (without line breaks) stand in the layer's text."""
    _, starts, ends = layer
    body = token.rstrip("=").translate(ONE_ALPHABET)
    begins = places if starts is None else starts[places]
    stops = places + 1 if ends is None else ends[places]
    whole = lambda inner: (inner, np.broadcast_to(begins[0], len(inner)), np.broadcast_to(stops[-1], len(inner)))
    # Starts of what can stand in the stretch; all in step with one of its first four signs.
    opens: dict[int, list[int]] = {step: [step] if step == 0 else [] for step in range(4)}
    for m in SEPARATOR.finditer(token):
        for at in {m.start() + 1, m.end()}:
            if len(body) - at >= 8:
                opens[at % 4].append(at)
    for step in range(min(4, len(body) - 3)):
        signs = body[step:]
        signs = signs[: len(signs) - (len(signs) % 4 == 1)]  # a single last sign holds no byte
        raw = base64.b64decode(signs + "=" * (-len(signs) % 4))
        text, at = _characters(raw)
        first, last = step + at[:-1] * 4 // 3, np.minimum(step + (at[1:] * 4 + 2) // 3, len(body)) - 1
        yield text, begins[first], stops[last]
        view = memoryview(raw)
        for start in opens[step]:
            inside = view[(start - step) * 3 // 4 :]
            head = bytes(inside[:16]).lstrip(b"\0")
            if _packed(head):
                yield from map(whole, _unwrap(lambda inside=inside: iter([bytes(inside)]), max_layer, 1))  # the bytes' own text is a layer already
            elif _deflated(inside, max_layer):
                yield from map(whole, _unwrap(lambda inside=inside: _raw_deflate(iter([inside]), max_layer), max_layer))


def _unwrap(source: Callable[[], Iterator[bytes]], max_layer: int, depth: int = 0, own: bool = True, seen: set[bytes] | None = None) -> Iterator[str]:
    """Texts inside bytes that ``source`` gives in pieces: their own and of what they unpack to, from level ``depth`` on.

    Each level is unpacked anew from the source, so that no level has to be held.  Without ``own`` the
    first level's text is left out.  ``seen``: digests of levels that were opened.
    """
    seen = set() if seen is None else seen
    while True:

        def level(depth: int = depth) -> Iterator[bytes]:
            chunks = source()
            for _ in range(depth):
                chunks = _inflate(chunks, max_layer)
            return chunks

        digest, head, long = hashlib.sha1(), b"", []

        def watched(chunks: Iterator[bytes]) -> Iterator[bytes]:
            nonlocal head
            for chunk in chunks:
                digest.update(chunk)
                head = head if len(head) > 2 else (head + chunk[:3]).lstrip(b"\0")
                yield chunk

        chunks = _long_stretches(watched(level()), max_layer, long)
        if own:
            yield from _texts(chunks, max_layer)
        else:
            for _ in chunks:
                pass
        if digest.digest() in seen:
            return
        seen.add(digest.digest())
        for start, end in long:
            yield from _unwrap_long(level, start, end, max_layer, seen)
        if not _packed(head):
            return
        depth, own = depth + 1, True


def _long_stretches(chunks: Iterator[bytes], least: int, found: list[tuple[int, int]]) -> Iterator[bytes]:
    """The chunks; places of base64 stretches longer than ``least`` that a cut can go through are put into ``found``."""
    at = begin = 0
    for chunk in chunks:
        lead = len(chunk) - len(chunk.lstrip(STRETCH))
        if lead < len(chunk):
            if at + lead - begin > least:
                found.append((begin, at + lead))
            begin = at + len(chunk.rstrip(STRETCH))
        at += len(chunk)
        yield chunk
    if at - begin > least:
        found.append((begin, at))


def _part(chunks: Iterator[bytes], start: int, end: int) -> Iterator[bytes]:
    at = 0
    for chunk in chunks:
        if part := chunk[max(0, start - at) : max(0, end - at)]:
            yield part
        at += len(chunk)
        if at >= end:
            return


def _decoded(chunks: Iterator[bytes], step: int) -> Iterator[bytes]:
    """Bytes of a base64 stretch, given in pieces, from its sign ``step`` on."""
    rest = b""
    for chunk in chunks:
        rest += chunk.translate(ONE_ALPHABET_BYTES, BREAKS)
        whole = (len(rest) - step) // 4 * 4
        if whole > 0:
            yield base64.b64decode(rest[step : step + whole])
            rest, step = rest[step + whole :], 0
    rest = rest[step:]
    rest = rest[: len(rest) - (len(rest) % 4 == 1)]
    if rest:
        yield base64.b64decode(rest + b"=" * (-len(rest) % 4))


def _goes_on(signs: bytes) -> tuple[bool, bool]:
    """Whether a base64 stretch's first signs are of a stream with a mark, or of raw deflate, that doesn't end in them."""
    signs = signs.translate(ONE_ALPHABET_BYTES, BREAKS)
    raw = base64.b64decode(signs[: len(signs) // 4 * 4])
    if marked := _packed(raw.lstrip(b"\0")):
        raw = raw.lstrip(b"\0")
        if raw[:3] in (b"BZh", XZ):
            return True, False
    elif not _can_deflate(raw):
        return False, False
    one = zlib.decompressobj(47 if marked else -15)
    try:
        one.decompress(raw)
    except zlib.error:
        return False, False
    return marked and not one.eof, not marked and not one.eof


def _opens(chunks: Iterator[bytes], at: int, probe: int) -> Iterator[tuple[int, bool]]:
    """Where streams start that go on beyond ``probe`` signs in a stretch that begins at ``at``, and whether they are raw deflate; shorter ones lie in a piece."""
    held, first = b"", True
    for chunk in chunks:
        held += chunk
        upto = max(0, len(held) - probe)
        places = {0} if first and upto else set()
        for m in OPENS.finditer(held, 0, upto):
            places |= {m.start() + 1, m.end()}
        for place in sorted(places):
            if any(_goes_on(held[place : place + 256])):
                marked, raw = _goes_on(held[place : place + probe])
                if marked or raw:
                    yield at + place, raw
        first = first and not upto
        held, at = held[upto:], at + upto


def _unwrap_long(level: Callable[[], Iterator[bytes]], start: int, end: int, max_layer: int, seen: set[bytes]) -> Iterator[str]:
    """Texts that are packed in a base64 stretch of a stream which is longer than a piece, and so is never held.

    What stands in it plainly is found in the overlapping pieces.
    """
    for step in range(4):
        yield from _unwrap(lambda step=step: _decoded(_part(level(), start, end), step), max_layer, 0, False, seen)
    for at, raw in _opens(_part(level(), start, end), start, min(1 << 16, max_layer // 2)):
        source = lambda at=at: _decoded(_part(level(), at, end), 0)
        if raw:
            yield from _unwrap(lambda source=source: _raw_deflate(source(), max_layer), max_layer, 0, True, seen)
        else:
            yield from _unwrap(source, max_layer, 1, True, seen)


def _percent(run: str) -> list[tuple[str, int]]:
    """Characters of an escaped run, each with the escapes' length."""
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        return [(c, 3 * len(c.encode())) for c in raw.decode()]
    except UnicodeDecodeError:
        return [(chr(b), 3) for b in raw]


def _percent_plus(run: str) -> list[tuple[str, int]]:
    out: list[tuple[str, int]] = []
    for part in re.split(r"(\++)", run):
        out += [(" ", 1)] * len(part) if part[:1] == "+" else _percent(part)
    return out


def _backslash(run: str) -> list[tuple[str, int]]:
    out: list[tuple[str, int]] = []
    for m in re.finditer(r"[\\%](?:u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2})|U([0-9A-Fa-f]{8})|u\{([0-9A-Fa-f]{1,6})\})", run):
        code = int(m[1] or m[2] or m[3] or m[4], 16)
        if 0xDC00 <= code < 0xE000 and out and 0xD800 <= ord(out[-1][0]) < 0xDC00:
            high, width = out.pop()
            out.append((chr(0x10000 + (ord(high) - 0xD800 << 10) + code - 0xDC00), width + len(m[0])))
        else:
            out.append((chr(code) if code < 0x110000 else "\ufffd", len(m[0])))
    return out


def _unescape(layer: Layer, pattern: re.Pattern, decode) -> Layer:
    """A whole layer with the escapes of one kind undone."""
    text, starts, ends = layer
    parts, first, last, at = [], [], [], 0
    for m in [*pattern.finditer(text), None]:
        upto = m.start() if m else len(text)
        parts.append(text[at:upto])
        plain = np.arange(at, upto)
        first.append(plain)
        last.append(plain)
        if m:
            chars, widths = zip(*decode(m[0]))
            parts += chars
            stop = upto + np.cumsum(widths)
            first.append(stop - widths)
            last.append(stop - 1)
            at = m.end()
    first, last = np.concatenate(first), np.concatenate(last)
    return "".join(parts), first if starts is None else starts[first], last + 1 if ends is None else ends[last]


def _wrapped(text: str) -> Iterator[tuple[int, int]]:
    """Places of base64 stretches over several lines: lines of one width and a shorter last one.

    The first line may be shorter too, as something can stand before it; then the stretch is given
    with and without it.
    """
    for group in WRAPPED.finditer(text) if "\n" in text else ():
        lines = [(m.start(), m.end()) for m in LINE.finditer(text, group.start(), group.end())]
        width = [b - a for a, b in lines]
        lines[-1] = (lines[-1][0], group.end())  # padding can stand on a line of its own
        i = 0
        while i < len(lines):
            j = i + 1
            while j < len(lines) and width[j] == width[i]:
                j += 1
            if j < len(lines) and width[j] < width[i]:
                j += 1
            if j > i + 1:
                yield lines[i][0], lines[j - 1][1]
                if i and 16 <= width[i - 1] < width[i]:
                    yield lines[i - 1][0], lines[j - 1][1]
            elif j == len(lines) and i and 16 <= width[i - 1] < width[i]:
                yield lines[i - 1][0], lines[i][1]
            i = j


def _children(layer: Layer, max_layer: int) -> Iterator[Layer]:
    text, starts, ends = layer
    for mark, pattern, decode in (("%", PERCENT, _percent), ("\\", UNICODE, _backslash), ("%u", PERCENT_U, _backslash)):
        if mark in text and pattern.search(text):
            yield _unescape(layer, pattern, decode)
            if mark == "%" and "+" in text:
                yield _unescape(layer, PERCENT_PLUS, _percent_plus)
    span = lambda start, end: (start if starts is None else starts[start], end if ends is None else ends[end - 1])
    for m in PACKED_PERCENT.finditer(text) if "%" in text else ():
        a, b = span(*m.span())
        raw = urllib.parse.unquote_to_bytes(m[0])
        for inner in _unwrap(lambda raw=raw: iter([raw]), max_layer):
            yield inner, np.broadcast_to(np.int64(a), len(inner)), np.broadcast_to(np.int64(b), len(inner))
    for m in BASE64.finditer(text):
        yield from _unwrap_base64(m[0], np.arange(m.start(), m.end()), layer, max_layer)
    for start, end in _wrapped(text):
        places = np.flatnonzero([not c.isspace() for c in text[start:end]]) + start
        yield from _unwrap_base64("".join(text[start:end].split()), places, layer, max_layer)


def find_secrets(text: str, max_layer: int = MAX_LAYER) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, kind, end) of the base finds, and of those that decoding adds."""
    base = scan(text)
    added: set[tuple[int, int, int]] = set()
    seen: set[tuple[bytes, int, int]] = set()
    todo = [_children((text, None, None), max_layer)]
    while todo:  # one layer at a time: a stream can unpack to any number of pieces
        if (layer := next(todo[-1], None)) is None:
            todo.pop()
            continue
        inner, starts, ends = layer
        if not inner:
            continue
        key = (hashlib.sha1(inner.encode("utf-8", "surrogatepass")).digest(), int(starts[0]), int(ends[-1]))
        if key in seen:
            continue
        seen.add(key)
        added.update((int(starts[a]), kind, int(ends[b - 1])) for a, kind, b in scan(inner))
        todo.append(_children(layer, max_layer))
    return base, sorted(added.difference(base))


RESULT = {"base": "array<struct<start:int,kind:int,end:int>>", "added": "array<struct<start:int,kind:int,end:int>>"}


def scan_secrets(docs: DataFrame, text_col: str = "text", max_layer: int = MAX_LAYER) -> DataFrame:
    """``docs`` with ``base`` and ``added`` finds (code points, kind as index into KINDS); the text is dropped."""
    kept = [f for f in docs.schema.fields if f.name not in RESULT and f.name != text_col]
    docs = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`").alias("_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{k} {v}" for k, v in RESULT.items())])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    row = lambda spans: [dict(zip(("start", "kind", "end"), s)) for s in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_secrets(t.as_py() or "", max_layer) for t in batch.column(batch.num_columns - 1)]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array([row(x[i]) for x in found], kind) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + list(RESULT))

    return map_arrow(docs, run, schema)


def digest_columns(found: DataFrame) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda spans: F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ","
    )
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"),
    )
