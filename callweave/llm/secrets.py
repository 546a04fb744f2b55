"""Secret scans through nested encodings.

Each text is a layer of bytes. A layer is scanned for secrets, then unwrapped:

* all percent and Unicode escapes of a layer, and the short backslash escapes beside
  them, are decoded in place into one layer as long as the text, with a map of offsets,
  so a secret of which only a part is escaped is found with what stands round it. Each
  escape stands for itself: one that is no valid character spoils nothing else;
* a base64 run is decoded from each of its first four characters, which between them
  meet every place inside the run where an encoding may begin; what comes out before
  that place is noise and holds no secret;
* lines of base64 that follow each other, as wrapped encodings do, are one run;
* wherever decoded bytes hold a zlib, gzip, bzip2, xz, lzma or zstandard stream, whatever
  wrapped it, its contents are a layer, members in a row joined. A cut stream counts as
  far as it goes, and so does a broken one where decoded bytes begin with it. Raw deflate
  has no mark: it is tried where a base64 run or the contents of a stream begin;
* decoded bytes that hold UTF-16, either byte first, are narrowed into a layer for each
  way of pairing them, UTF-32 in two steps.

Every layer is scanned as bytes, printable or not.

Each layer is unwrapped in turn until none is left; one seen before at the same place
is not entered again, so encodings that reproduce themselves end. A secret in an
escaped layer is reported at the characters that spell it, one inside base64 at the
span of the outermost run that holds it.

Layers shrink or are seen before, except compressed ones. Streams of which EXPANSION
bytes are not enough to hold all that are open at once are scanned in chunks, cut where
no pattern or encoding can go on; so a stream of any size is scanned to its end. Three
things are not exact and put the run into `unopened`, and redact() masks it whole: a
chunk without such a place, which is cut with an overlap; streams inside streams beyond
NESTED bytes in one text, or four times EXPANSION open at once, which could go on
without end; streams that ask for more than MEMORY bytes to be opened.

Defined results: null and empty texts have no spans; the same secret found twice
at one span counts once; repeated rows are scanned alike; other columns are kept.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in their order, patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}

ESCAPE = re.compile(rb"%([0-9A-Fa-f]{2})|\\(?:u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2})|([abfnrtv0\\/'\"])|u\{0*([0-9A-Fa-f]{1,6})\}|U000([0-9A-Fa-f]{5}))")
PERCENT = re.compile(rb"%([0-9A-Fa-f]{2})()()()()()")
BACKSLASH = re.compile(ESCAPE.pattern.replace(rb"%([0-9A-Fa-f]{2})|", rb"()"))
SHORT = dict(zip(b"abfnrtv0\\/'\"", b"\a\b\f\n\r\t\v\0\\/'\"", strict=True))
_CHAR, _WRAP = "[A-Za-z0-9+/_-]", r"(?:[ \t]*(?:[\r\n]|\\[rn]))+[ \t]*"
#: A run of base64, 16 characters at least; its lines may be wrapped, line ends written as escapes too.
BASE64 = re.compile(rf"(?<!{_CHAR})(?=(?:{_CHAR}(?:{_WRAP})?){{16}}){_CHAR}+(?:{_WRAP}{_CHAR}+)*=*".encode())
LINE = re.compile(rf"(?:^|(?<=[\r\n \t])|(?<=\\[rn])){_CHAR}+=*".encode())
STANDARD = bytes.maketrans(b"-_", b"+/")
#: How streams begin, by first byte; zlib ones without a preset dictionary.
MARKS = {
    "gzip": {0x1F: rb"\x8b\x08"},
    "bzip2": {0x42: rb"Zh[1-9](?:1AY&SY|\x17rE8P\x90)"},
    "xz": {0xFD: rb"7zXZ\x00"},
    "lzma": {0x5D: rb"\x00\x00[\x00-\xff][\x00-\x10](?:\xff{8}|[\x00-\xff]{5}\x00{3})"},
    "zstd": {0x28: rb"\xb5\x2f\xfd"},
    "zlib": {c: b"[" + b"".join(b"\\x%02x" % f for f in range(256) if (c << 8 | f) % 31 == 0 and not f & 32) + b"]" for c in range(8, 128, 16)},
}
#: Patterns begin with a set of bytes, which is searched much faster than alternatives.
STREAM = re.compile(
    b"[" + b"".join(b"\\x%02x" % c for heads in MARKS.values() for c in heads) + b"](?:"
    + b"|".join(b"(?P<%s>%s)" % (kind.encode(), b"|".join(b"(?<=\\x%02x)%s" % head for head in heads.items())) for kind, heads in MARKS.items()) + b")",
    re.S,
)
MEMBER = {kind: re.compile(b"|".join(b"\\x%02x%s" % head for head in heads.items()), re.S) for kind, heads in MARKS.items()}
#: Twelve ASCII characters in UTF-16 or UTF-32, the least that any pattern or encoding has.
WIDE = re.compile(rb"(?:[\t\n\r -~]\x00){12}|(?:\x00[\t\n\r -~]){12}|(?:[\t\n\r -~]\x00{3}){12}|(?:\x00{3}[\t\n\r -~]){12}")
#: One linear-time pass finds the texts that could hold anything at all; the others are done.
ANY = rf"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}|%[0-9A-Fa-f]{{2}}|\\[ux][0-9A-Fa-f]{{2}}|\\u\{{|\\U000|\\[\"'\\/]|(?:{_CHAR}(?:{_WRAP})?){{16}}"
#: The same for layers: what holds none of these holds no secret and no encoding; keys and hexadecimal digits are runs of base64 too.
INSIDE = (
    re.compile(rf"{_CHAR}(?:(?:{_WRAP})?{_CHAR}){{15}}".encode()),
    re.compile(rb"[pPsStTaA](?i:(?<=p)ass(?:word|wd)|(?<=s)ecret|(?<=t)oken|(?<=a)pi_?key)"),
    re.compile(rb"[%\\](?:(?<=%)[0-9A-Fa-f]{2}|(?<=\\)(?:[ux][0-9A-Fa-f]{2}|u\{|U000|[\"'\\/]))"),
    STREAM,
)
#: Levels of escapes that are layers of their own; deeper ones are decoded to their end in one pass.
DEPTH = 16
#: Bytes of a stream that are fed and taken at once.
FEED = 16 << 10
#: Bytes fed at once where what is taken cannot be bounded; memory to open a stream.
SIP, MEMORY = 32, 128 << 20
#: Bytes of open streams that are held at once; size and overlap of the chunks beyond; bytes of nested streams in a text.
EXPANSION = 16 << 20
CHUNK, OVERLAP = 1 << 20, 64 << 10
NESTED = 1 << 30
#: Where a chunk may end, before the last byte: a byte that is in no pattern, or a blank between words that no pattern or encoding spans.
CUT = re.compile(rb"[^\x00A-Za-z0-9+/_.=%:\\\"' \t\r\n-]|\x00{8}|[g-mo-qs-zG-Z] (?=[A-Za-z0-9])", re.S)
MASK = "[SECRET]"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns in one layer."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


class Layer:
    """Bytes with the characters of the text that each stands for; inside base64, `outer` for all of them."""

    def __init__(self, data: bytes, outer: tuple[int, int] | None = None, parent: Layer | None = None, pieces: list[tuple[int, int, int]] = ()) -> None:
        self.data, self.outer, self.parent = data, outer, parent
        self.pieces = pieces  # (first byte, first and last byte in the parent), literal pieces as they are
        self.firsts = [p[0] for p in pieces]

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The span of the text that spells these bytes."""
        layer = self
        while layer.outer is None and layer.parent is not None:
            start, end = layer._up(start)[0], layer._up(end - 1)[1]
            layer = layer.parent
        return layer.outer or (start, end)

    def _up(self, at: int) -> tuple[int, int]:
        k = bisect_right(self.firsts, at) - 1
        first, start, end = self.pieces[k]
        return (start, end) if end else (start + at - first, start + at - first + 1)


def _code(m: re.Match) -> bytes:
    """The byte of an escape; characters above U+00FF are in no pattern and stand as a question mark."""
    if m[4]:
        return bytes((SHORT[m[4][0]],))
    code = int(m[1] or m[2] or m[3] or m[5] or m[6], 16)
    return bytes((code,)) if code < 256 else b"?"


def unescaped(layer: Layer, escape: re.Pattern = ESCAPE) -> Layer | None:
    """The layer with its escapes decoded in place, None without any."""
    data = layer.data
    if layer.outer is not None:
        out, n = escape.subn(_code, data)
        return Layer(out, layer.outer) if n else None
    out, pieces, at, n = [], [], 0, 0
    for m in escape.finditer(data):
        if m.start() > at:
            pieces.append((n, at, 0))
            out.append(data[at : m.start()])
            n += m.start() - at
        pieces.append((n, m.start(), m.end()))
        out.append(_code(m))
        at, n = m.end(), n + 1
    if not out:
        return None
    pieces.append((n, at, 0))
    return Layer(b"".join([*out, data[at:]]), None, layer, pieces)


def settled(layer: Layer) -> Layer:
    """The layer with escapes decoded until none is left, in one pass however deep they stand."""
    out, pieces = bytearray(), []
    for k, byte in enumerate(layer.data):
        out.append(byte)
        pieces.append((k, k + 1))
        while len(out) > 1 and (m := next((m for n in range(2, 13) if (m := ESCAPE.fullmatch(out, max(0, len(out) - n)))), None)):
            start = pieces[m.start()][0]
            code = _code(m)
            del out[m.start() :], pieces[m.start() :]
            out += code
            pieces.append((start, k + 1))
    if layer.outer is not None:
        return Layer(bytes(out), layer.outer)
    return Layer(bytes(out), None, layer, [(n, a, b) for n, (a, b) in enumerate(pieces)])


def unpacked(layer: Layer, m: re.Match):
    """The layers of a base64 run, decoded from each of its first four characters."""
    lines = [(x.start() + m.start(), x.end() + m.start()) for x in LINE.finditer(m[0])]
    run = b"".join(layer.data[a:b] for a, b in lines).rstrip(b"=").translate(STANDARD)
    for k in range(4):
        body = run[k : len(run) - ((len(run) - k) % 4 == 1)]
        data = base64.b64decode(body + b"=" * (-len(body) % 4))
        if not _worth(data):
            continue
        if len(lines) == 1 or layer.outer is not None:
            yield Layer(data, layer.span(*m.span()))
            continue
        pieces, n = [(0, *lines[0])], 0
        for (start, end), after in zip(lines, lines[1:], strict=False):
            n += end - start
            # a byte that is spelled by two lines stands for both
            whole, split = divmod(max(0, n - k) * 6, 8)
            if split:
                pieces.append((whole, start, after[1]))
            pieces.append((whole + (split > 0), *after))
        yield Layer(data, None, layer, pieces)


def contents(data: bytes, at: int, kind: str):
    """What the stream at a place holds, in pieces; returns the place after it and how it ended.

    Members in a row are one stream. A broken or cut stream gives what comes before the break.
    """
    member = _deflated if kind in ("gzip", "zlib", "raw") else _other
    while True:
        at, how = yield from member(data, at, kind)
        if how != "whole" or kind in ("zlib", "raw") or not MEMBER[kind].match(data, at):
            return at, how


def _deflated(data: bytes, at: int, kind: str):
    stream, feed = zlib.decompressobj({"gzip": 31, "zlib": 15, "raw": -15}[kind]), b""
    while not stream.eof:
        if not feed:
            feed = data[at : at + FEED]
            at += len(feed)
        if not feed:
            yield stream.flush()
            return at, "cut"
        before = stream.copy()
        try:
            yield stream.decompress(feed, FEED)
        except zlib.error:
            for k in range(len(feed)):
                try:
                    yield before.decompress(feed[k : k + 1])
                except zlib.error:
                    return at - len(feed) + k, "broken"
            return at, "broken"
        feed = stream.unconsumed_tail
    return at - len(stream.unused_data), "whole"


def _opener(kind: str):
    if kind == "bzip2":
        return bz2.BZ2Decompressor()
    if kind == "zstd":
        return zstandard.ZstdDecompressor(max_window_size=MEMORY).decompressobj()
    return lzma.LZMADecompressor(lzma.FORMAT_XZ if kind == "xz" else lzma.FORMAT_ALONE, memlimit=MEMORY)


def _other(data: bytes, at: int, kind: str):
    """As contents() does, for one member; a break loses the last SIP bytes before it."""
    stream = _opener(kind)
    while not stream.eof:
        feed = data[at : at + SIP]
        if not feed:
            return at, "cut"
        try:
            if kind == "zstd":
                yield stream.decompress(feed)
            else:
                yield stream.decompress(feed, FEED)
                while not stream.eof and not stream.needs_input:
                    yield stream.decompress(b"", FEED)
        except (OSError, EOFError, lzma.LZMAError, zstandard.ZstdError) as error:
            return at, "large" if "memory" in str(error).lower() else "broken"
        at += len(feed)
    return at - len(stream.unused_data), "whole"


def narrowed(layer: Layer):
    """The layers of UTF-16 text that a layer holds: each pairing of its bytes, other characters as question marks."""
    done = set()
    for first in (0, 1):
        data = np.frombuffer(layer.data[first:] + b"\0" * ((len(layer.data) - first) % 2), np.uint8)
        for low in (0, 1):
            out = np.where(data[1 - low :: 2] == 0, data[low::2], ord("?")).astype(np.uint8).tobytes()
            if out in done or not _holds(out) and not _wide(out):
                continue
            done.add(out)
            if layer.outer is not None:
                yield Layer(out, layer.outer)
            else:
                yield Layer(out, None, layer, [(n, first + 2 * n, min(first + 2 * n + 2, len(layer.data))) for n in range(len(out))])


def _wide(data: bytes) -> bool:
    return data.count(0) > 10 and WIDE.search(data) is not None


def _raw(data: bytes) -> bool:
    """Whether the bytes begin as raw deflate does."""
    try:
        return zlib.decompressobj(-15).decompress(data[:FEED], 64) != b""
    except zlib.error:
        return False


def _worth(data: bytes) -> bool:
    """Whether decoded bytes may hold anything, streams without a mark and UTF-16 included."""
    return _holds(data) or _wide(data) or _raw(data)


def _holds(data: bytes) -> bool:
    return any(pattern.search(data) for pattern in INSIDE)


def _spans(data: bytes) -> list[tuple[str, int, int]]:
    return base_spans(data.decode("latin-1"))


def _cut(data: bytes, searched: int) -> int:
    """The last place where a chunk may end, 0 if there is none; bytes before `searched` have none."""
    for size in (1 << 12, len(data)):
        at = 0
        for m in CUT.finditer(data, max(0, searched - 8, len(data) - size)):
            at = m.end()
        if at:
            return at
    return 0


class Scan:
    """The layers of one text, and what became of them."""

    def __init__(self) -> None:
        self.shut: set[tuple[int, int]] = set()  # spans that may hold more than was found
        self.seen: set[tuple] = set()
        self.room, self.nested = EXPANSION, 0

    def new(self, what: str, span: tuple[int, int], data: bytes) -> bool:
        key = (what, span, hashlib.blake2b(data, digest_size=16).digest())
        return key not in self.seen and not self.seen.add(key)

    def inside(self, layer: Layer, level: int = 0, depth: int = 0, cut: bool = False):
        """(layer, its level of escapes, streams round it, whether it is a chunk that goes on) of all that a layer holds."""
        if level <= DEPTH:
            inner = (unescaped if level < DEPTH else settled)(layer)
            if inner is not None and (_holds(inner.data) or _wide(inner.data)):
                yield inner, level + 1, depth, cut
            if inner is not None and b"%" in layer.data and b"\\" in layer.data:
                # bytes of a stream may look like an escape of the other kind
                for kind in (PERCENT, BACKSLASH):
                    if (one := unescaped(layer, kind)) is not None and one.data != inner.data:
                        yield one, DEPTH + 1, depth, cut
        for m in BASE64.finditer(layer.data):
            if self.new("run", layer.span(*m.span()), m[0]):
                for inner in unpacked(layer, m):
                    yield inner, 0, depth, cut and m.end() == len(layer.data)
        if layer.outer is not None or layer.parent is not None:
            at = 0
            if _wide(layer.data):
                for inner in narrowed(layer):
                    yield inner, 0, depth, cut
            if level == 0 and _raw(layer.data):
                yield from self.stream(layer, 0, "raw", depth, cut)
            while m := STREAM.search(layer.data, at):
                end = yield from self.stream(layer, m.start(), m.lastgroup, depth, cut)
                at = max(m.start() + 1, end)

    def stream(self, layer: Layer, at: int, kind: str, depth: int, cut: bool):
        """The contents of the stream at a place, if it is one, whole or in chunks; returns the place after it."""
        pieces, end, buffer = contents(layer.data, at, kind), None, bytearray()
        span = layer.outer
        whole, searched = True, 0
        while end is None:
            least = len(buffer) + CHUNK if not whole else self.room + 1
            while end is None and len(buffer) < least:
                try:
                    piece = next(pieces)
                except StopIteration as stop:
                    end, how = stop.value
                    break
                buffer += piece
                self.nested += len(piece) if depth else 0
                if self.nested > NESTED:
                    self.shut.add(span or layer.span(at, len(layer.data)))
                    return len(layer.data)
            if end is not None:
                break
            if whole:
                # too large to be held: from here on in chunks
                whole = False
                if span is None or at or kind == "raw":
                    rest = contents(layer.data, at, kind)
                    try:
                        while True:
                            next(rest)
                    except StopIteration as stop:
                        span = layer.span(at, max(at + 1, stop.value[0]))
                        if (at or kind == "raw") and stop.value[1] == "broken":
                            return at + 1
                if self.room < -4 * EXPANSION:
                    self.shut.add(span)
                    return len(layer.data)
            to = _cut(buffer, searched) if len(buffer) >= CHUNK else 0
            if not to and len(buffer) < max(CHUNK, self.room):
                searched = len(buffer) if len(buffer) >= CHUNK else 0
                continue
            if not to:
                self.shut.add(span)
            data, buffer, searched = bytes(buffer[: to or len(buffer)]), buffer[to or max(1, len(buffer) - OVERLAP) :], 0
            yield from self._held(data, span, depth, True)
        if (at or kind == "raw") and how == "broken":
            # bytes that look like a stream by chance
            return at + 1
        span = span or layer.span(at, max(at + 1, end))
        if cut and how == "cut" or how == "large":
            self.shut.add(span)
        if buffer:
            data = bytes(buffer)
            buffer.clear()
            yield from self._held(data, span, depth, False)
        return end

    def _held(self, data: bytes, span: tuple[int, int], depth: int, cut: bool):
        if _worth(data) and self.new("stream", span, data):
            self.room -= len(data)
            yield Layer(data, span), 0, depth + 1, cut
            self.room += len(data)


def scan_layers(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], list[tuple[int, int]]]:
    """(base spans, all spans, spans not fully opened), spans ordered by start, then kind as listed, then end."""
    if not text:
        return [], [], []
    base = base_spans(text)
    found, scan = set(base), Scan()
    # no pattern or encoding has other than ASCII characters: a byte a character keeps the offsets
    work = [scan.inside(Layer(text.encode("ascii", "replace")))]
    while work:
        inner = next(work[-1], None)
        if inner is None:
            work.pop()
            continue
        layer = inner[0]
        found.update((kind, *layer.span(start, end)) for kind, start, end in _spans(layer.data))
        work.append(scan.inside(*inner))
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(base, key=order), sorted(found, key=order), sorted(scan.shut)


def scan_text(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """(base spans, all spans, number of runs not fully opened)."""
    base, every, shut = scan_layers(text)
    return base, every, len(shut)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """text with each span, overlapping ones merged, replaced by MASK."""
    out, at = [], 0
    merged: list[list[int]] = []
    for start, end in sorted((s, e) for _, s, e in spans):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += text[at:start], MASK
        at = end
    return "".join([*out, text[at:]])


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _candidates(texts: pa.Array) -> list[bool]:
    return pc.fill_null(pc.match_substring_regex(texts, ANY), False).to_pylist()


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans, unopened) of docs (doc_id, text)."""

    def run(batches):
        for batch in batches:
            texts, rows = batch.column("text"), []
            for text, may in zip(texts, _candidates(texts), strict=True):
                base, every, unopened = scan_text(text.as_py()) if may else ([], [], 0)
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), len(every), unopened))
            names = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans", "unopened")
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long, unopened long")


def redact(docs: DataFrame) -> DataFrame:
    """docs with every found span of text masked, and runs that could not be opened to their end; all rows and all other columns stay as they are."""

    def clean(text):
        _, every, shut = scan_layers(text)
        return mask(text, every + [("shut", *s) for s in shut])

    @F.pandas_udf("string")
    def masked(texts):
        may = _candidates(pa.array(texts, pa.string(), from_pandas=True))
        return texts.where([not m for m in may], [clean(t) if m else t for t, m in zip(texts, may, strict=True)])

    return docs.select(*(masked(docs["text"]).alias("text") if c == "text" else docs[c] for c in docs.columns))
