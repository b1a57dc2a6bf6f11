"""Operator 6: secrets in texts and in what is encoded in them.

A text is the first layer.  Decoding one level of its percent or Unicode escapes gives
the next, until none is left; every layer is searched for secrets and for base64 runs, with
compressed data inside those.  What a run's content holds, in all that is encoded in it, is worked out
once per content and reported at every place where that content stands; a content met again
below itself ends a cycle.  A match in a layer is reported at the span of the outer text that it came from.

Escapes of an escape sign, nested any number of times (``%252525..41``), are cut to ``NESTED`` levels in one step, so that
the levels of a text are few and the work stays in proportion to its length.

A run of base64 letters is decoded at its four offsets, and what follows a slash, dash or underscore in it is looked at as
well, since these stand in paths and names too.  Base64 may be broken over lines, hold UTF-16, and compressed data
with or without a header.  Compressed pieces are inflated with all their members; a content
of more than ``MAX_LAYER`` bytes is searched as a stream, in parts cut between lines, so that a
decompression bomb does not fill the task.  Only data compressed more than ``LEVELS`` times
over, such as a file that inflates to itself, is left and counted in ``n_unopened``.

Edge cases.  A null or blank text has no spans.  Rows are independent, so null ids, repeated
rows and other columns do not matter.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import html
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LAYER = 32 << 20  # bytes that are held at once
PIECE = 4 << 20  # bytes or characters of a step
OVERLAP = 1 << 16
NESTED = 6  # levels of one nested escape sign that are looked at one by one
LEVELS = 100  # of compressed data directly in compressed data
# Kinds in the order that breaks ties, and the patterns of the scan.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
_CHAIN = re.compile(r"([%\\&])([^\s%\\&]{2,14}?)\2{" + str(NESTED) + r",}")
_PARTING = re.compile(r"[/_-]")
_CONTROL = re.compile(rb"[\x00-\x08\x0e-\x1f]")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_BLANK = re.compile(r"[\x20\t\r\n]+")
_RUN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=\x20\t\r\n"
_SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_decoded bigint, n_unopened bigint"

Span = tuple[int, int, int]  # start, kind number, end


class Layer(NamedTuple):
    """A text; character k comes from ``start[k] .. end[k]`` of the outer text, or stands there itself."""

    text: str
    start: np.ndarray | None
    end: np.ndarray | None

    def outer(self, lo: int, hi: int) -> tuple[int, int]:
        return (lo, hi) if self.start is None else (int(self.start[lo]), int(self.end[hi - 1]))


def matches(text: str) -> list[Span]:
    """Secrets written plainly in ``text``, in order."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _escapes(text: str) -> re.Pattern | None:
    """Pattern of the escapes to decode next: percent signs before the others."""
    if "%" in text and _PERCENT.search(text):
        return _PERCENT
    return _UNICODE if ("\\" in text or "&#" in text) and _UNICODE.search(text) else None


def _same_sign(sign: str, unit: str) -> bool:
    """Whether ``sign`` and ``unit`` decode to the sign again, so that repeated units are nested escapes of it."""
    text = sign + unit
    for _ in range(3):
        pattern = _escapes(text)
        if pattern is None:
            break
        text = pattern.sub(lambda m: _unescape(m.group()), text)
        if text == sign:
            return True
    return False


def _cut_chains(layer: Layer) -> Layer:
    """Escapes of a sign nested deeper than ``NESTED`` levels cut to these; the sign keeps its place."""
    text, parts, keep, at = layer.text, [], [], 0
    for m in _CHAIN.finditer(text):
        unit = m.group(2)
        if _same_sign(m.group(1), unit):
            rest = m.end() - NESTED * len(unit)
            parts += [text[at: m.start() + 1], text[rest: m.end()]]
            keep += [np.arange(at, m.start() + 1), np.arange(rest, m.end())]
            at = m.end()
    if not parts:
        return layer
    parts.append(text[at:])
    at = np.concatenate([*keep, np.arange(at, len(text))])
    first, last = (at, at + 1) if layer.start is None else (layer.start[at], layer.end[at])
    return Layer("".join(parts), first, last)


def unescaped(layer: Layer) -> Layer | None:
    """The whole text with one level of its escapes decoded, so that neighbours stay neighbours; None without escapes."""
    if _escapes(layer.text) is None:
        return None
    layer = _cut_chains(layer)
    text, pattern = layer.text, _escapes(layer.text)
    parts, first, last, at = [], [], [], 0
    for m in pattern.finditer(text):
        new = _unescape(m.group())
        parts += [text[at:m.start()], new]
        first += [np.arange(at, m.start()), np.full(len(new), m.start())]
        last += [np.arange(at, m.start()), np.full(len(new), m.end() - 1)]
        at = m.end()
    parts.append(text[at:])
    first, last = (np.concatenate([*x, np.arange(at, len(text))]) for x in (first, last))
    if layer.start is None:
        return Layer("".join(parts), first, last + 1)
    return Layer("".join(parts), layer.start[first], layer.end[last])


def _unescape(piece: str) -> str:
    if piece[0] == "%":
        return unquote_to_bytes(piece).decode("utf-8", "replace")
    if piece[0] == "&":
        return html.unescape(piece)
    code = int(piece[2:].strip("{}"), 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"


def _wbits(head: bytes) -> int:
    return 31 if head[:2] == b"\x1f\x8b" else 15 if head[:1] == b"\x78" and len(head) > 1 and int.from_bytes(head[:2], "big") % 31 == 0 else 0


def _members(data: bytes, source: Iterator[bytes], wbits: int) -> Iterator[bytes]:
    """Content of all members of gzip data, or of zlib data, in pieces; what follows is ignored."""
    first, inside = True, zlib.decompressobj(wbits)
    while True:
        try:
            while data and not inside.eof:
                yield inside.decompress(data, PIECE)
                data = inside.unconsumed_tail
            if not inside.eof:
                data = next(source, b"")
                if not data:
                    yield inside.flush()
                    return
        except zlib.error:
            if first:
                raise
            return
        if inside.eof:
            rest = inside.unused_data.lstrip(b"\0")
            while len(rest) < 2 and (more := next(source, b"")):
                rest = (rest + more).lstrip(b"\0")
            if wbits != 31 or _wbits(rest) != 31:
                return
            first, data, inside = False, rest, zlib.decompressobj(wbits)


def _inflate(source: Iterator[bytes], levels: int = LEVELS) -> Iterator[bytes]:
    """Bytes of ``source``, inflated as often as they are compressed, in pieces."""
    head = b""
    while len(head) < 2 and (more := next(source, b"")):
        head += more
    wbits = _wbits(head)
    if wbits:
        if not levels:
            raise RecursionError
        inner = filter(None, _members(head, source, wbits))
        try:
            one = next(inner, b"")
        except zlib.error:
            wbits = 0
        else:
            yield from _inflate(chain([one], inner), levels - 1)
    if not wbits:
        yield head
        yield from source


class Large(NamedTuple):
    """Compressed data with a content of more than ``MAX_LAYER`` bytes, which is read as a stream."""

    data: bytes


def _odd(text: str) -> bool:
    return any(c < " " and c not in "\t\n\r\x0b\x0c" for c in set(text))


def _texts(data: bytes) -> Iterator[str]:
    """The content of ``data`` in parts cut where no match and no base64 run crosses; fails if it is no text."""
    decode, held = codecs.getincrementaldecoder("utf-8")(), ""
    for piece in _inflate(iter([data])):
        new = decode.decode(piece)
        if _odd(new):
            raise ValueError("no text")
        held += new
        if len(held) >= PIECE:
            safe = held.rstrip(_RUN)
            cut = max(safe.rfind(c) for c in "\t\n\x0b\x0c\r") + 1
            if not cut and len(held) >= MAX_LAYER:
                cut = max(held.rfind(c) for c in "\t\n\x0b\x0c\r") + 1
                if not cut:  # one line: parts overlap
                    yield held
                    held = held[-OVERLAP:]
            if cut:
                yield held[:cut]
                held = held[cut:]
    yield held + decode.decode(b"", True)


def _unpack(piece: str) -> tuple[str | Large | None, bool]:
    """Text inside a base64 piece, inflated where it is compressed, and whether it was left closed."""
    data = _bytes(piece.rstrip("="))
    return (None, False) if data is None else _content(data)


def _bytes(letters: str) -> bytes | None:
    plain = letters.replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain[: len(plain) - (len(plain) % 4 == 1)] + "=" * (-len(plain) % 4 % 3), validate=True)
    except (binascii.Error, ValueError):
        return None


def _content(data: bytes) -> tuple[str | Large | None, bool]:
    """Text that ``data`` holds, inflated where it is compressed, and whether it was left closed."""
    try:
        if _wbits(data):
            parts, size = [], 0
            for part in _inflate(iter([data])):
                parts.append(part)
                size += len(part)
                if size > MAX_LAYER:
                    return Large(data), False
            text = b"".join(parts).decode()
        else:
            text = data.decode()
    except RecursionError:
        return None, True
    except (UnicodeDecodeError, zlib.error):
        return _without_mark(data), False
    if _odd(text):
        return _without_mark(data), False
    return (text if len(text) >= 8 else None), False


def _without_mark(data: bytes | memoryview) -> str | Large | None:
    """Text of ``data`` that is UTF-16, or deflated without a header."""
    if len(data) >= 16:
        marked = bytes(data[:2]) in (b"\xff\xfe", b"\xfe\xff")
        for code, zeros in (("utf-16-le", data[1:32:2]), ("utf-16-be", data[0:32:2])):
            if marked or not any(zeros):
                try:
                    text = str(data[: len(data) // 2 * 2], "utf-16" if marked else code)
                except UnicodeDecodeError:
                    continue
                return text if len(text) >= 8 and not _odd(text) else None
    inside = zlib.decompressobj(-15)
    try:
        head = inside.decompress(data, 256)  # bytes that are not deflated mostly fail here
        head.decode("utf-8", "strict" if inside.eof else "ignore")
        if len(head) < 8 or _CONTROL.search(head):
            return None
        plain = head + inside.decompress(inside.unconsumed_tail, MAX_LAYER)
        if inside.unconsumed_tail:
            return Large(_with_header(bytes(data), plain, inside))
        text = (plain + inside.flush()).decode()
    except (zlib.error, UnicodeDecodeError):
        return None
    return text if inside.eof and not _odd(text) else None


def _with_header(data: bytes, plain: bytes, inside) -> bytes:
    """Headerless deflated data as a gzip member, so that it can be read as a stream like the others."""
    crc, size = zlib.crc32(plain), len(plain)
    while not inside.eof and inside.unconsumed_tail:
        more = inside.decompress(inside.unconsumed_tail, PIECE)
        crc, size = zlib.crc32(more, crc), size + len(more)
    return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + data + crc.to_bytes(4, "little") + (size & 0xFFFFFFFF).to_bytes(4, "little")


def _placed(text: str, lo: int, hi: int) -> Iterator[tuple[int, int, str | Large | None, bool]]:
    """Contents of a run of base64 letters that do not begin at its first one.

    They may begin at one of its first letters or after a parting sign, and end with the run or before a parting sign.
    The run is decoded once per offset.  Of the places inside one stretch of text only the first is kept, so each
    byte is decoded once.
    """
    letters = text[lo:hi].rstrip("=")
    cuts = [m.end() for m in _PARTING.finditer(letters)]
    for r in range(4):
        places = sorted({p for p in [r, *cuts] if p % 4 == r and len(letters) - p >= 16})
        data = _bytes(letters[r:]) if places else None
        if data is None:
            continue
        view, done = memoryview(data), 0
        control = [m.start() for m in _CONTROL.finditer(data)]
        for p in places:
            at = (p - r) // 4 * 3
            if _wbits(data[at: at + 2]):
                yield (lo + p, hi, *_content(data[at:]))
            elif (inner := _without_mark(view[at:])) is not None:
                yield lo + p, hi, inner, False
            elif at >= done:
                after = bisect_left(control, at)
                stop = control[after] if after < len(control) else len(data)
                try:
                    inner = str(view[at:stop], "utf-8")
                except UnicodeDecodeError as e:
                    stop = at + e.start
                if stop == len(data):
                    yield lo + p, hi, inner if len(inner) >= 8 and not _odd(inner) else None, False
                else:  # text up to a parting sign
                    end = cuts[k] - 1 if (k := bisect_right(cuts, r + stop // 3 * 4 + 4) - 1) >= 0 else 0
                    if end - p >= 16:
                        yield (lo + p, lo + end, *_unpack(letters[p:end]))
                done = stop + 1
    for a, b in zip([0, *cuts], [*(c - 1 for c in cuts), None], strict=True):
        if cuts and b is not None and b - a >= 16:
            yield (lo + a, lo + b, *_unpack(letters[a:b]))


def _wrapped(text: str) -> Iterator[tuple[int, int]]:
    """Spans of base64 that may be broken over lines: a run of lines, without its first or last, or while lines are equally long."""
    for m in _LINES.finditer(text):
        lines = [x.span() for x in _LINE.finditer(text, m.start(), m.end())]
        seen = set()
        for first in (0, 1):
            width = [len(text[a:b].rstrip("=")) for a, b in lines[first:]]
            equal = next((k for k, w in enumerate(width) if w != width[0]), len(width))
            for n in (len(width), len(width) - 1, equal, equal + 1):
                if 2 <= n <= len(width):
                    seen.add((lines[first][0], lines[first + n - 1][1]))
        yield from sorted(seen)


def packed(text: str) -> tuple[list[tuple[int, int, str | Large]], list[tuple[int, int]]]:
    """(start, end, content) of the base64 pieces, and the compressed pieces left closed."""
    out, closed = [], []

    def take(lo, hi, inner, shut):
        if shut:
            closed.append((lo, hi))
        if inner is not None:
            out.append((lo, hi, inner))
        return inner is not None or shut
    for m in _BASE64.finditer(text):
        if not take(*m.span(), *_unpack(m.group())):
            for found in _placed(text, *m.span()):
                take(*found)
    for lo, hi in _wrapped(text):
        take(lo, hi, *_unpack(_BLANK.sub("", text[lo:hi])))
    return out, closed


class _Contents:
    """What decoded contents of a document hold, by content."""

    def __init__(self):
        self.direct: dict[str | Large, tuple[set[int], list[str | Large], int]] = {}
        self.all: dict[str | Large, tuple[set[int], int]] = {}
        self.reading: set[Large] = set()

    def __call__(self, content: str | Large) -> tuple[set[int], int]:
        """Kinds found in ``content`` and in everything below it, and the pieces left closed."""
        if content not in self.all:
            kinds, closed, seen, work = set(), 0, {content}, [content]
            while work:
                own, below, shut = self._look(work.pop())
                kinds |= own
                closed += shut
                new = set(below) - seen
                seen |= new
                work += new
            self.all[content] = kinds, closed
        return self.all[content]

    def _stream(self, large: Large) -> tuple[set[int], list[str | Large], int]:
        kinds, closed = set(), 0
        if large in self.reading:
            return kinds, [], 0
        self.reading.add(large)
        try:
            for part in _texts(large.data):
                inside = _Contents()  # of its own, so that parts do not add up
                inside.reading = self.reading
                own, shut = inside(part)
                kinds |= own
                closed += shut
        except RecursionError:
            closed += 1
        except (ValueError, zlib.error):
            kinds, closed = set(), 0
        finally:
            self.reading.discard(large)
        return kinds, [], closed

    def _look(self, text: str | Large) -> tuple[set[int], list[str | Large], int]:
        if text not in self.direct and isinstance(text, Large):
            self.direct[text] = self._stream(text)
        if text not in self.direct:
            pieces, closed = packed(text)
            lower = unescaped(Layer(text, None, None))
            self.direct[text] = ({k for _, k, _ in matches(text)}, [p[2] for p in pieces] + ([lower.text] if lower else []), len(closed))
        return self.direct[text]


def scan(text: str) -> tuple[list[Span], list[Span], int]:
    """Plain spans, spans found in decoded layers only, and the pieces left closed."""
    base = matches(text)
    found: set[Span] = set()
    unopened: dict[tuple[int, int], int] = {}  # an outer piece can be met in several layers
    contents = _Contents()
    layer = Layer(text, None, None)
    while layer is not None:  # every level of escapes is shorter than the one before
        if layer.start is not None:
            for lo, kind, hi in matches(layer.text):
                a, b = layer.outer(lo, hi)
                found.add((a, kind, b))
        pieces, closed = packed(layer.text)
        for lo, hi, inner in pieces:
            a, b = layer.outer(lo, hi)
            kinds, shut = contents(inner)
            found |= {(a, kind, b) for kind in kinds}
            unopened[a, b] = max(unopened.get((a, b), 0), shut)
        for lo, hi in closed:
            unopened[layer.outer(lo, hi)] = 1
        layer = unescaped(layer)
    return base, sorted(found - set(base)), sum(unopened.values())


def joined(spans: list[Span], kinds: tuple[str, ...] = KINDS) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_decoded", "n_unopened"]
    for batch in batches:
        rows = []
        for text in batch.column(1):
            base, more, unopened = scan(text.as_py() or "")
            n = [0, 0, 0]
            for _, k, _ in base:
                n[k] += 1
            rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more), unopened))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every document (doc_id, text): counts and digest of the plain ones, all spans."""
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return ids.mapInArrow(_scan_batches, _SCHEMA)
