"""Secret scans with a worklist of decoded layers.

A text is scanned, and so is every layer that can be unwrapped from it: URL,
Unicode and character escapes, base64 runs (over line breaks, at any alignment,
of UTF-8, UTF-16 or other bytes), and compressed data in either.  New layers go
on the worklist until none is left; a layer whose content was seen at the same
place is not entered again, so cycles end.  Every layer keeps, for each of its
characters, the stretch of the original text that it comes from, and what is
found in it is reported there.

Escapes are unwrapped once for a layer, and through to the end for another, in
one sweep: a decoded character that completes a further escape is decoded on
the spot.  Layers between differ from these two in escapes alone, whose first
characters are in no pattern, and a chain of n levels takes time n.

Compressed data is read through all its members in windows of bounded size,
which overlap.  A secret there is reported at the stretch that was compressed.
Runs of blanks longer than a window's overlap are shortened, so they hide
nothing.  Base64 blocks that hold compressed data and are themselves in
compressed data of more than one window are decoded as far as a window goes.

Cases: a null or empty text has no spans; overlapping finds are all reported;
repeated rows give repeated results; very long texts are scanned whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, text_groups

KINDS = ("assign", "access", "hex")
#: Bytes of decompressed data scanned at once, and how far two such windows overlap.
WINDOW, OVERLAP = 1 << 20, 1 << 14
#: The base patterns.  Runs shorter than the least length fail as a whole, so the length is part of the pattern.
_ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

_ESCAPES = r"%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
_ESCAPE = re.compile(_ESCAPES)
_ESCAPE_END = re.compile(f"(?:{_ESCAPES})\\Z")
_LONGEST_ESCAPE = 10
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)*={0,2}")
_STANDARD = str.maketrans("-_", "+/")
#: An undecodable byte b is the character 0xDC00 + b, as in Python's surrogateescape.
_BYTES = re.compile("[\udc80-\udcff]+")
_BYTE_RUN = re.compile("[\x00-\xff\udc80-\udcff]+")
_MAGIC = re.compile("\x1f[\x8b\udc8b]\x08|BZh[1-9]1AY&SY|[\xfd\udcfd]7zXZ\x00|x[\x01\x5e\x9c\xda\udc9c\udcda]")
_MAGIC_BYTES = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\Ax[\x01\x5e\x9c\xda]")
_LEGIBLE = re.compile(rb"[\t\n\r\x20-\x7e]{12,}")
_DARK = bytes(b if 32 <= b < 127 or b in b"\t\n\r" else 0 for b in range(256))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start and then kind."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return _by_place(found)


class _Layer:
    """A decoded text; character i comes from original[starts[i]:ends[i]], and fresh[i] says it was decoded."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray, fresh: np.ndarray):
        self.text, self.starts, self.ends, self.fresh = text, starts, ends, fresh

    def span(self, a: int, b: int) -> tuple[int, int]:
        return int(self.starts[a:b].min()), int(self.ends[a:b].max())


def _original(text: str) -> _Layer:
    n = np.arange(len(text), dtype=np.int64)
    return _Layer(text, n, n + 1, np.zeros(len(text), bool))


# ---- escapes -----------------------------------------------------------------

def _one_escape(s: str) -> str | None:
    if s[0] == "%":
        byte = int(s[1:], 16)
        return chr(byte if byte < 128 else 0xDC00 + byte)
    code = int(s[3:-1], 16) if s[:3].lower() == "&#x" else int(s[2:-1]) if s[0] == "&" else int(s[2:], 16)
    return chr(code) if code < 0xD800 or 0xDFFF < code < 0x110000 else None


def _unescaped(layer: _Layer, through: bool) -> _Layer | None:
    """The layer with its escapes decoded, once or ``through`` all their levels; None if it has none."""
    text, starts, ends, fresh = layer.text, array("q", layer.starts.tobytes()), array("q", layer.ends.tobytes()), bytearray(layer.fresh.tobytes())
    out, froms, tos, news, at = [], array("q"), array("q"), bytearray(), 0

    def copy(a: int, b: int) -> None:
        out.extend(text[a:b])
        froms.extend(starts[a:b])
        tos.extend(ends[a:b])
        news.extend(fresh[a:b])

    def put(new: str, size: int) -> None:  # the last ``size`` characters become ``new``
        a, b = min(froms[-size:]), max(tos[-size:])
        del out[-size:], froms[-size:], tos[-size:], news[-size:]
        out.append(new)
        froms.append(a)
        tos.append(b)
        news.append(1)

    changed = False
    search = 0
    while m := _ESCAPE.search(text, search):
        new, search = _one_escape(m[0]), m.start() + 1
        if new is None:
            continue
        copy(at, m.end())
        put(new, m.end() - m.start())
        at, search, changed = m.end(), m.end(), True
        if not through:
            continue
        while True:
            tail = "".join(out[-_LONGEST_ESCAPE:])
            end = _ESCAPE_END.search(tail) if tail[-1] in "0123456789abcdefABCDEF;" else None
            new = _one_escape(end[0]) if end else None
            if new is not None:
                put(new, len(end[0]))
            elif at < len(text) and any(c in tail for c in "%\\&"):  # an escape may be going on
                copy(at, at + 1)
                at += 1
            else:
                break
        search = at
    if not changed:
        return None
    copy(at, len(text))
    return _Layer("".join(out), np.frombuffer(froms, np.int64), np.frombuffer(tos, np.int64), np.frombuffer(news, bool))


def _utf8(layer: _Layer) -> _Layer:
    """Runs of bytes that are UTF-8 as its characters."""
    parts, keep, at = [], [], 0
    for m in _BYTES.finditer(layer.text):
        try:
            new = m[0].encode("utf-8", "surrogateescape").decode()
        except UnicodeDecodeError:
            continue
        size = np.fromiter((len(c.encode()) for c in new), np.int64, len(new))
        stop = m.start() + np.cumsum(size)
        parts += [layer.text[at:m.start()], new]
        keep += [np.stack([np.arange(at, m.start())] * 2), np.stack([stop - size, stop - 1])]
        at = m.end()
    if not parts:
        return layer
    first, last = np.concatenate([*keep, np.stack([np.arange(at, len(layer.text))] * 2)], axis=1).astype(np.int64)
    return _Layer("".join([*parts, layer.text[at:]]), layer.starts[first], layer.ends[last], layer.fresh[first])


# ---- compressed data -----------------------------------------------------------

def _decoder(data: bytes) -> Callable | None:
    if data[:3] == b"\x1f\x8b\x08":
        return lambda: zlib.decompressobj(31)
    if data[:1] == b"x" and len(data) > 2 and int.from_bytes(data[:2], "big") % 31 == 0:
        return zlib.decompressobj
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor
    return lzma.LZMADecompressor if data[:6] == b"\xfd7zXZ\x00" else None


def _inflated(pieces: Iterator[bytes], used: list[int]) -> Iterator[bytes]:
    """The contents of all members in a row; ``used[0]`` is the number of bytes they took."""
    coder, held, fed = None, b"", 0
    try:
        for piece in pieces:
            held, fed = held + piece, fed + len(piece)
            while True:
                if coder is None:
                    make = _decoder(held)
                    if make is None:
                        if len(held) < 6:
                            break
                        return
                    coder = make()
                out = coder.decompress(held, WINDOW)
                held = coder.unused_data if coder.eof else getattr(coder, "unconsumed_tail", b"")
                used[0] = fed - len(held)
                if out:
                    yield out
                if coder.eof:
                    coder = None
                    if not held:
                        break
                elif getattr(coder, "needs_input", not held and len(out) < WINDOW):
                    break
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return


def _starts(data: bytes, places: Iterator[int]) -> Iterator[int]:
    """The ``places`` at which compressed data may begin; of gzip headers that end at the same byte the first alone."""
    ends, tried = None, set()
    for a in places:
        if data[a:a + 3] == b"\x1f\x8b\x08":
            flags, end = data[a + 3] if a + 3 < len(data) else 255, a + 10
            if flags & 4:
                end += 2 + int.from_bytes(data[end:end + 2], "little")
            for named in (8, 16):  # a name and a comment, each up to a zero byte
                if flags & named:
                    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0) if ends is None else ends
                    at = int(np.searchsorted(ends, end))
                    end = int(ends[at]) + 1 if at < len(ends) else len(data)
            if flags & 0xE0 or end >= len(data) or end in tried:
                continue
            tried.add(end)
        yield a


def _cut(data: memoryview) -> Iterator[bytes]:
    a, size = 0, 1 << 9  # little is copied where the data soon proves not to be compressed
    while a < len(data):
        yield bytes(data[a:a + size])
        a, size = a + size, min(2 * size, 1 << 16)


def _windows(data: memoryview, used: list[int]) -> Iterator[bytes]:
    """Decompressed data, level by level down to what is not compressed, in overlapping windows."""
    pieces, heads, depth = _inflated(_cut(data), used), set(), 0
    while True:
        first = next(pieces, b"")
        mark = hashlib.sha1(first).digest()
        if not first or mark in heads:  # nothing, or data that unpacks to itself
            return
        heads.add(mark)
        second = next(pieces, b"")
        whole = chain([first, second], pieces) if second else iter([first])
        if _decoder(first) is None or depth == 100:
            break
        depth += bool(second)  # only what is larger than a piece is read through readers one inside the other
        inner = _inflated(whole if second else _cut(memoryview(first)), [0])
        begin = next(inner, b"")
        if not begin:  # only looked like compressed data
            whole = iter([first]) if not second else whole
            break
        pieces = chain([begin], inner)
    tail = b""
    for piece in whole:
        tail += piece
        if len(tail) >= WINDOW:
            yield tail
            tail = re.sub(rb"\x20{3,}", b"  ", tail)[-OVERLAP:]
    if tail:
        yield tail


def _packed_layers(layer: _Layer) -> Iterator[_Layer]:
    """What is compressed in the bytes that escapes gave."""
    done = 0
    for run in _BYTE_RUN.finditer(layer.text):
        places = [m.start() - run.start() for m in _MAGIC.finditer(layer.text, run.start(), run.end())
                  if layer.fresh[m.start():m.start() + 2].any()]
        if not places:
            continue
        data = bytes(map(_byte, run[0]))
        for a in _starts(data, iter(places)):
            used = [0]
            if run.start() + a < done:
                continue
            for window in _windows(memoryview(data)[a:], used):
                done = run.start() + a + used[0]
                for text, _ in _views(window):
                    yield _spread(text, *layer.span(run.start() + a, done))


def _byte(c: str) -> int:
    return ord(c) & 0xFF


def _spread(text: str, a: int, b: int) -> _Layer:
    return _Layer(text, np.full(len(text), a, np.int64), np.full(len(text), b, np.int64), np.ones(len(text), bool))


# ---- bytes as text, base64 -------------------------------------------------------

def _views(data: bytes) -> list[tuple[str, np.ndarray]]:
    """(text, the byte at which each character begins and the last one's end) for each way to read the data."""
    try:
        text = data.decode()
        if "\0" not in text:
            size = np.ones(len(text), np.int64) if len(text) == len(data) else np.fromiter((len(c.encode()) for c in text), np.int64, len(text))
            return [(text, np.concatenate([[0], np.cumsum(size)]))]
    except UnicodeDecodeError:
        pass
    found, n = [], np.arange(len(data) + 2, dtype=np.int64)
    if _LEGIBLE.search(data):  # bytes that are not ASCII separate
        found.append((data.translate(_DARK).decode(), n[:len(data) + 1]))
    for odd in (0, 1):  # UTF-16 and the like: every other byte
        half = data[odd::2]
        if _LEGIBLE.search(half) and 2 * data[1 - odd::2].count(0) >= len(half) // 2:
            found.append((half.translate(_DARK).decode(), odd + 2 * np.arange(len(half) + 1, dtype=np.int64)))
    return found


def _base64_layers(layer: _Layer, everywhere: bool) -> Iterator[_Layer]:
    """What base64 runs hold; not ``everywhere``: only runs with decoded characters."""
    for m in _BASE64.finditer(layer.text):
        if not everywhere and not layer.fresh[m.start():m.end()].any():
            continue
        run, place = m[0].rstrip("="), None
        if "\n" in run:
            kept = [(i, c) for i, c in enumerate(run, m.start()) if not c.isspace()]
            place, run = np.array([i for i, _ in kept], np.int64), "".join(c for _, c in kept)
        else:
            place = np.arange(m.start(), m.start() + len(run), dtype=np.int64)
        run = run.translate(_STANDARD)
        for skip in range(4):
            part = run[skip:]
            part = part[:len(part) - (len(part) % 4 == 1)]
            data = base64.b64decode(part + "=" * (-len(part) % 4))
            clean = False
            for begin in _starts(data, (magic.start() for magic in _MAGIC_BYTES.finditer(data))):
                used = [0]
                for window in _windows(memoryview(data)[begin:], used):
                    a, b = skip + begin * 4 // 3, skip + -(-(begin + used[0]) * 4 // 3)
                    b = m.end() if b >= len(run) else int(place[b - 1]) + 1
                    for text, _ in _views(window):
                        yield _spread(text, *layer.span(int(place[a]), b))
                    clean = True
                if clean:
                    break
            if not clean:
                for text, stops in _views(data):
                    clean = clean or (len(stops) == len(text) + 1 and stops[-1] == len(data) and "\0" not in text)
                    a, b = place[skip + stops[:-1] // 3 * 4], place[np.minimum(skip + -(-stops[1:] // 3) * 4, len(run)) - 1]
                    yield _Layer(text, layer.starts[a], layer.ends[b], np.ones(len(text), bool))
            if clean:  # the run is wholly explained
                break


# ---- worklist ------------------------------------------------------------------------

def _may_hold_layers(text: str) -> bool:
    return _ESCAPE.search(text) is not None or _BASE64.search(text) is not None


def _by_place(spans: set[tuple[str, int, int]] | list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans) as (kind, start, end) by start and then kind."""
    if not text:
        return [], []
    base = base_spans(text)
    if not _may_hold_layers(text):
        return base, base
    found, seen, work = set(base), set(), [_original(text)]
    while work:
        layer = work.pop()
        once = _unescaped(layer, False)
        through = once and _unescaped(once, True)
        inner = _base64_layers(layer, True)
        for view in (layer, once, through):
            if view is None:
                continue
            if view is not layer:
                inner = chain(inner, _packed_layers(view))
                view = _utf8(view)
                inner = chain(inner, _base64_layers(view, False))
            for kind, a, b in base_spans(view.text):
                if view.fresh[a:b].any():
                    found.add((kind, *view.span(a, b)))
        for new in inner:
            if not new.text:
                continue
            mark = (hashlib.sha1(new.text.encode("utf-8", "surrogatepass")).digest(), *new.span(0, len(new.text)))
            if mark not in seen:
                seen.add(mark)
                work.append(new)
    return base, _by_place(found)


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def secret_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_groups(batches):
            found = [secret_spans(t) for t in texts]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *counts,
                 pa.array([hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in found], pa.string()),
                 pa.array([_listed(every) for _, every in found], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return pick(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with every stretch that holds a secret replaced by ``mark``."""
    spans = sorted((a, b) for _, a, b in secret_spans(text)[1])
    if not spans:
        return text
    out, at, end = [], 0, -1
    for a, b in spans:
        if a >= end:  # a new stretch
            if end >= 0:
                at = end
            out += [text[at:a], mark]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with secrets replaced in ``text``; ``n_chars``, where it is a column, follows."""
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_groups(batches):
            new = pa.array([redact(t, mark) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([new if c == "text" else part.column(c) for c in columns], columns)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out
