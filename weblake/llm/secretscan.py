"""Secrets in texts and in what is wrapped inside them.

Every text is the first layer of a worklist. A layer is searched for secrets, then unwrapped:

* URL escapes (`%41`), Unicode and hex escapes (`\\u0041`, `\\x41`) and numeric character references
  (`&#65;`) give a further layer for each stretch that has them, with its escapes undone; a stretch ends where no
  secret and no base64 can reach across;
* each base64 run (either alphabet, 16 characters or more) that unpacks to text, or to gzip, zlib,
  bz2 or xz data (all members of them) that unpack to text, gives a layer of its own. Runs that are wrapped over
  lines of one width (indented or not) are unpacked as one, and line by line as well.

Layers are unwrapped until nothing new comes out. Inflated data that equal those they came from end
their branch. Every layer knows where its characters come from, and what is found in it is reported at
the span of the original text. Inflated data pass through in windows, so their length takes no memory, and there is no
limit for a document. Only bombs are stopped: what comes of one stretch of the text may be `RATIO` times as long, and
`FLOOR` bytes in any case. `cut_off` says that a stretch was stopped there, or that its data lack their end; secrets of
the text itself and other stretches are never affected, and `redacted` masks such a stretch as a whole.

Defined cases: a null text counts as empty and has no spans; equal spans of one kind are reported
once, the outermost layer's; other columns pass through untouched; rows are independent, so
repeated rows get equal results and a lost executor's rows are simply scanned again.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import html
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
FOUND = "struct<spans:array<struct<kind:string,start:long,end:long,depth:int>>,cut_off:boolean>"
_FOUND = pa.struct([("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32())]))),
                    ("cut_off", pa.bool_())])

# The base patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
# Where a text can be cut: no secret, escape or base64 block has such a character, nor a space between these words.
_SAFE = re.compile(r"""[^A-Za-z0-9+/_.=\-\s"':%\\&#;{}]|(?<![:=\s])\x20(?![:=\s])|(?<=[^A-Za-z0-9+/_=\-\s])\n""")
RATIO, FLOOR = 1100, 1 << 24  # deflate's greatest ratio is 1032
_STEP, _WINDOW = 1 << 16, 1 << 20
_NEXT_LINE = re.compile(r"[ \t]*\r?\n[ \t]*([A-Za-z0-9+/_-]+)")
ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\x[0-9A-Fa-f]{2})+|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
_SURROGATES = re.compile(r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}")
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f�]")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base matches of one layer: per kind leftmost and non-overlapping, short ones dropped."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for run in RUN.finditer(text):  # a long enough match of the other kinds lies in one such run
        at, word = run.start(), run[0]
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            out += [(kind, at + m.start(), at + m.end()) for m in pattern.finditer(word) if m.end() - m.start() >= LEAST[kind]]
    return out


class Room:
    """What may still come of a stretch."""

    def __init__(self, left: int):
        self.left = left

    def take(self, n: int) -> bool:
        if n <= self.left:
            self.left -= n
            return True
        return False


class Layer:
    """A text and where its characters come from: `back` gives the parent's span for a span of this text.
    `digest` stands for the inflated data that the text is of."""

    def __init__(self, text: str, parent: "Layer | None" = None, back: Callable[[int, int], tuple[int, int]] | None = None,
                 room: Room | None = None, digest: bytes = b""):
        self.text, self.parent, self.depth, self.back, self.room, self.digest = text, parent, parent.depth + 1 if parent else 0, back, room, digest

    def origin(self, start: int, end: int) -> tuple[int, int]:
        """The span of the original text that [start, end) of this layer comes from."""
        layer = self
        while layer.parent is not None:
            start, end = layer.back(start, end)
            layer = layer.parent
        return start, end

    def room_for(self, length: int) -> Room:
        """That of the stretch this layer came from; a new one for a stretch of the text itself."""
        return self.room or Room(max(FLOOR, RATIO * length))

    def comes_from(self, digest: bytes) -> bool:
        layer: Layer | None = self
        while layer is not None and layer.digest != digest:
            layer = layer.parent
        return layer is not None


def _unescape(match: str) -> str:
    if match[0] == "&":
        return html.unescape(match)
    if match[:2] == "\\u":
        code = int(match[2:].strip("{}"), 16)
        return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else match
    raw = bytes.fromhex(match.replace("%", "").replace("\\x", ""))
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _stretches(text: str) -> Iterator[list[tuple[int, int, str]]]:
    """The escapes (start, end, what they stand for), those with no safe cut between them together."""
    pairs = {m.start(): m for m in _SURROGATES.finditer(text)}
    held: list[tuple[int, int, str]] = []
    for m in ESCAPE.finditer(text):
        if held and m.start() < held[-1][1]:
            continue  # the second half of a pair
        if held and _cut(text, held[-1][1], m.start()) is not None:
            yield held
            held = []
        if pair := pairs.get(m.start()):
            held.append((m.start(), pair.end(), pair[0].encode("ascii").decode("unicode_escape").encode("utf-16", "surrogatepass").decode("utf-16")))
        else:
            held.append((m.start(), m.end(), _unescape(m[0])))
    if held:
        yield held


def _cut(text: str, start: int, end: int) -> int | None:
    """The first safe cut in [start, end) of plain text, not next to what surrounds it."""
    m = _SAFE.search(text, start + 1)
    return m.start() if m and m.end() < end else None


def _cut_before(text: str, start: int, end: int) -> int:
    """Where to begin so that all that reaches `end` is there: the last safe cut of [start, end), or `start`."""
    size = 256
    while True:
        low = max(start, end - size)
        last = None
        for m in _SAFE.finditer(text, low):
            if m.end() >= end:
                break
            last = m
        if last is not None and last.start() > low:
            return last.start() - (last[0] == " ")
        if low == start:
            return start
        size *= 4


def _escapes(layer: Layer) -> Iterator["Layer | tuple[int, int]"]:
    """A layer for each stretch with escapes; a span where the room was too small."""
    text = layer.text
    if not any(x in text for x in ("%", "\\u", "\\x", "&#")):
        return
    past = 0
    for escapes in _stretches(text):
        begin = _cut_before(text, past, escapes[0][0])
        past = escapes[-1][1]
        stop = _cut(text, past, len(text))
        inner = _undone(layer, escapes, begin, len(text) if stop is None else stop)
        if inner.room.take(len(inner.text)):
            yield inner
        else:
            yield begin, len(text) if stop is None else stop


def _undone(layer: Layer, escapes: list[tuple[int, int, str]], begin: int, stop: int) -> Layer:
    """[begin, stop) of a layer with these escapes undone."""
    text, parts, at, done = layer.text, [], 0, begin
    starts, source, copied = [], [], []  # of each piece: its place, where it is from, whether character by character

    def piece(start: int, end: int, new: str, same: bool) -> None:
        nonlocal at
        if new:
            starts.append(at)
            source.append((start, end))
            copied.append(same)
            parts.append(new)
            at += len(new)

    for start, end, new in escapes:
        piece(done, start, text[done:start], True)
        piece(start, end, new, False)
        done = end
    piece(done, stop, text[done:stop], True)

    def back(start: int, end: int) -> tuple[int, int]:
        i, j = bisect_right(starts, start) - 1, bisect_right(starts, end - 1) - 1
        return (source[i][0] + (start - starts[i] if copied[i] else 0), source[j][0] + end - starts[j] if copied[j] else source[j][1])

    return Layer("".join(parts), layer, back, layer.room_for(stop - begin))


def _unpacker(data: bytes):
    if data[:2] == b"\x1f\x8b" or data[:1] == b"\x78" and len(data) > 2 and (data[0] * 256 + data[1]) % 31 == 0:
        return zlib.decompressobj(47)
    return bz2.BZ2Decompressor() if data[:3] == b"BZh" else lzma.LZMADecompressor() if data[:6] == b"\xfd7zXZ\x00" else None


class Inflated:
    """What all members of gzip, zlib, bz2 or xz data hold, in chunks, as often as asked for. After a pass, `whole` says
    whether the data reached their end, and `rest` is what follows the last member."""

    def __init__(self, data: "Callable[[], Iterator[bytes]]"):
        self.data, self.whole, self.rest = data, True, b""

    def __call__(self) -> Iterator[bytes]:
        self.whole, self.rest = True, b""
        chunks, head = self.data(), b""
        while True:
            while len(head) < 6 and (more := next(chunks, None)) is not None:
                head = (head + more).lstrip(b"\0")
            if (unpacker := _unpacker(head)) is None:
                self.rest = b"".join([head, *chunks])
                return
            while not unpacker.eof:
                try:
                    out = unpacker.decompress(head, _STEP)
                except (zlib.error, OSError, EOFError, lzma.LZMAError):
                    self.whole = False
                    return
                if out:
                    yield out
                head = getattr(unpacker, "unconsumed_tail", b"")
                if not unpacker.eof and not head and len(out) < _STEP and getattr(unpacker, "needs_input", True):
                    if (more := next(chunks, None)) is None:
                        self.whole = False
                        return
                    head = more
            head = unpacker.unused_data.lstrip(b"\0")


def _first(chunks: Iterator[bytes], n: int) -> Iterator[bytes]:
    for c in chunks:
        yield c[:n]
        n -= len(c)
        if n <= 0:
            return


def _slices(data: bytes) -> Iterator[bytes]:
    return (data[i:i + _STEP] for i in range(0, len(data), _STEP))


def _readable(data: bytes) -> str | None:
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return text if text and not _CONTROL.search(text) else None


def _texts(chunks: Iterator[bytes], whole: bool) -> Iterator[str]:
    """The chunks as text; UnicodeDecodeError if they are none."""
    decode = codecs.getincrementaldecoder("utf-8")().decode
    for c in chunks:
        text = decode(c)
        if _CONTROL.search(text):
            raise UnicodeDecodeError("utf-8", c, 0, 1, "control character")
        yield text
    if whole:
        decode(b"", True)


def _windows(texts: Iterator[str]) -> Iterator[str]:
    """Windows of a long text, cut where it is safe; longer ones where it is not."""
    held, seen = "", 0
    for text in texts:
        held += text
        if len(held) - seen >= _WINDOW:
            at = _cut_before(held, seen, len(held))
            if at > seen:
                yield held[:at + 1]
                held, seen = held[at:], 0
            else:
                seen = len(held) - 1
    if held:
        yield held


def _inflated(layer: Layer, data: bytes, room: Room) -> tuple[Iterator[tuple[str, bytes]], bool] | None:
    """Texts (with their data's digest) that packed data hold, packed several times over as well, and whether they
    are whole; None if there is no text."""
    make, whole, rests = lambda: _slices(data), True, []
    digests = {hashlib.sha256(data).digest()}
    digest = b""
    while True:
        chunks, head = make(), b""
        while len(head) < 6 and (more := next(chunks, None)) is not None:
            head += more
        if _unpacker(head) is None:
            break
        inner = Inflated(make)
        kept, size, summed, over = [], 0, hashlib.sha256(), False
        for c in inner():
            size += len(c)
            if over := size > room.left:
                break
            summed.update(c)
            if size <= _WINDOW:
                kept.append(c)
        if not size:
            break
        digest = summed.digest()
        if digest in digests or layer.comes_from(digest):  # it unpacks to itself
            return None
        digests.add(digest)
        whole = whole and inner.whole and not over
        rests.append(b"" if over else inner.rest)
        if size <= _WINDOW and not over:
            small = b"".join(kept)
            make = lambda small=small: iter((small,))
        else:
            make = lambda inner=inner, n=min(size, room.left): _first(inner(), n)
        if over:
            break
    if not rests:
        return None
    more = [t for r in rests if (t := _readable(r))]
    try:
        length = sum(map(len, _texts(make(), whole)))
    except UnicodeDecodeError:
        length = 0
    if not length and not more:
        return None if whole else (iter(()), False)
    whole = room.take(min(length, room.left)) and whole
    return ((t, digest) for t in chain(_windows(_texts(make(), whole)) if length else (), more)), whole


def _wrapped(text: str, run: tuple[int, int]) -> list[tuple[int, int]]:
    """The lines of the block that `run` starts: full ones of one width, then at most one shorter; the first may start within a line."""
    lines, at = [run], run[0]
    while at and text[at - 1] in " \t":
        at -= 1
    width = run[1] - run[0] if not at or text[at - 1] == "\n" else None
    while m := _NEXT_LINE.match(text, lines[-1][1]):
        n = m.end(1) - m.start(1)
        width = width or n
        if n > width:
            break
        lines.append(m.span(1))
        if n < width:
            break
    return lines


def _candidates(text: str) -> Iterator[list[list[tuple[int, int]]]]:
    """What may be base64, as lists of stretches to join: of each list the first that unpacks counts."""
    done = 0
    for run in RUN.finditer(text):
        if run.start() >= done and len(lines := _wrapped(text, run.span())) > 1:
            done = lines[-1][0]
            yield [x for x in (lines, lines[:-1], lines[1:], lines[1:-1]) if len(x) > 1]
        yield [[run.span()]]
        if re.search(r"[/_-]", run[0]):
            for m in re.finditer(r"[A-Za-z0-9+]{16,}", run[0]):
                if m.end() - m.start() < len(run[0]):
                    yield [[(run.start() + m.start(), run.start() + m.end())]]


def _joined(layer: Layer, spans: list[tuple[int, int]]) -> tuple[Iterator[Layer], bool] | None:
    """The layers that base64 in these stretches unpacks to, and whether they are whole; None if there are none."""
    word = "".join(layer.text[s:e] for s, e in spans).replace("-", "+").replace("_", "/")
    if len(word) % 4 == 1:
        return None
    try:
        data = base64.b64decode(word + "=" * (-len(word) % 4))
    except binascii.Error:
        return None
    room = layer.room_for(len(word))
    if _unpacker(data) is not None and (found := _inflated(layer, data, room)):
        texts, whole = found
        return (Layer(t, layer, lambda start, end: (spans[0][0], spans[-1][1]), room, digest) for t, digest in texts), whole
    if (text := _readable(data)) is None:
        return None
    if not room.take(len(text)):
        return iter(()), False
    before = [0, *accumulate(e - s for s, e in spans)]

    def place(i: int) -> int:
        k = min(bisect_right(before, i), len(spans)) - 1
        return spans[k][0] + i - before[k]

    def back(start: int, end: int) -> tuple[int, int]:
        first = len(text[:start].encode())
        last = first + len(text[start:end].encode())
        return place(first * 4 // 3), place(min(before[-1], (last * 4 + 2) // 3) - 1) + 1

    return iter((Layer(text, layer, back, room),)), True


def _packed(layer: Layer) -> Iterator["Layer | tuple[int, int]"]:
    """Layers from base64; a span where data were not unpacked to their end."""
    whole_to = 0
    for ways in _candidates(layer.text):
        for spans in ways:
            if (found := _joined(layer, spans)) is not None:
                break
        else:
            continue
        inner, whole = found
        if whole and len(spans) > 1:
            whole_to = spans[-1][1]
        yield from inner
        if not whole and spans[-1][1] > whole_to:  # a line alone is no cut where its block is whole
            yield spans[0][0], spans[-1][1]


def scan(text: str | None, max_decoded: int | None = None) -> tuple[list[tuple[str, int, int, int]], list[tuple[int, int]]]:
    """All spans (kind, start, end, depth of the layer) by start, kind and end, and the spans of the text that were not
    unpacked to their end; `max_decoded`: a limit for the whole text, instead of that by stretches."""
    found: dict[tuple[str, int, int], int] = {}
    cuts: list[tuple[int, int]] = []

    def entered(layer: Layer) -> tuple[Layer, Iterator]:
        for kind, start, end in base_spans(layer.text):
            at = (kind, *layer.origin(start, end))
            found[at] = min(found.get(at, layer.depth), layer.depth)
        return layer, chain(_escapes(layer), _packed(layer))

    stack = [entered(Layer(text or "", room=None if max_decoded is None else Room(max_decoded)))]
    while stack:  # one layer after the other, so that only the layers above one are held
        layer, inner = stack[-1]
        match next(inner, None):
            case None:
                stack.pop()
            case Layer() as new:
                stack.append(entered(new))
            case span:
                cuts.append(layer.origin(*span))
    order = sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return [(*x, found[x]) for x in order], cuts


def find(text: str | None, max_decoded: int | None = None) -> tuple[list[tuple[str, int, int, int]], bool]:
    """The spans of `scan`, and whether anything was not unpacked to its end."""
    spans, cuts = scan(text, max_decoded)
    return spans, bool(cuts)


def secrets(text: Column | str, max_decoded: int | None = None) -> Column:
    """FOUND for each text: spans in code points, end exclusive; depth 0 marks the base spans."""
    @F.arrow_udf(FOUND)
    def scan(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            spans, cut = find(t.as_py(), max_decoded)
            out.append({"spans": [dict(zip(("kind", "start", "end", "depth"), s)) for s in spans], "cut_off": cut})
        return pa.array(out, _FOUND)

    return scan(F.col(text) if isinstance(text, str) else text)


def redacted(text: Column | str, mark: str = "[SECRET]") -> Column:
    """Each text with its stretches of secrets, and those that were not unpacked to their end, replaced by `mark`; texts
    without any as they were, null stays null."""
    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            t = t.as_py()
            parts, done = [], 0
            spans, cuts = scan(t)
            for start, end in sorted([(a, b) for _, a, b, _ in spans] + cuts):
                if end > done:
                    if start >= done:
                        parts += [t[done:start], mark]
                    done = end
            out.append("".join(parts) + t[done:] if parts else t)
        return pa.array(out, pa.string())

    return masked(F.col(text) if isinstance(text, str) else text)
