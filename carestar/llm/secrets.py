"""Secret scans through nested encodings by a recursive decoding worklist."""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import column_lists, per_batch, per_text

KINDS = ("assign", "access", "hex")
MASK = "[SECRET]"
# What compressed pieces open to is looked through in parts of about this size.
PART_BYTES = 4 << 20
# A stretch of this size without a place to part it is parted anyway, and counted.
MAX_STRETCH_BYTES = 64 << 20

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
_HEX = re.compile("[0-9a-f]{16,}")
_PERCENT = re.compile("(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
_BASE64 = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?:[A-Za-z0-9+/]{60,76}\r?\n)+[A-Za-z0-9+/]{2,76}={0,2}")
_PART = re.compile("[/_+-]")
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]")
# A byte that no match, run or escape holds, or a line end that no wrapped base64 run goes on after.
_APART = re.compile(
    rb"""[^A-Za-z0-9+/_.=:"'%\\&#;{}\x20\r\n-]|[^A-Za-z0-9+/\r][A-Za-z0-9+/]{0,59}\r?\n"""
)
_TO_STANDARD = bytes.maketrans(b"-_", b"+/")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of each match, in order. Leftmost and not overlapping in a
    kind; matches that are too short are dropped after they have taken their characters."""
    spans = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(word in low for word in _ASSIGN_WORDS):
            spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


class _Layer:
    """A decoded text; each character knows the characters of the whole text it came from. Those
    of a compressed text all come from the same ones, two numbers in place of arrays."""

    def __init__(self, text: str, low: np.ndarray | int | None, high: np.ndarray | int | None):
        self.text, self.low, self.high = text, low, high

    def source(self, start: int, end: int) -> tuple[int, int]:
        if self.low is None:
            return start, end
        if isinstance(self.low, int):
            return self.low, self.high
        return int(self.low[start]), int(self.high[end - 1])

    def child(self, text: str, starts, ends) -> _Layer:
        """The characters of ``text`` come from those places; numbers are one place for all."""
        if isinstance(self.low, int):
            return _Layer(text, self.low, self.high)
        if isinstance(starts, int):
            return _Layer(text, *self.source(starts, ends))
        starts, ends = np.asarray(starts), np.asarray(ends)
        if self.low is None:
            return _Layer(text, starts, ends)
        return _Layer(text, self.low[starts], self.high[ends - 1])


def _replaced(layer: _Layer, found: list[tuple[int, int, str, list[int]]]) -> _Layer | None:
    """The layer with pieces (start, end, new text, width of each new character) put in."""
    if not found:
        return None
    parts, starts, ends, at = [], [], [], 0
    for start, end, new, widths in [*found, (len(layer.text), len(layer.text), "", [])]:
        parts += [layer.text[at:start], new]
        kept = np.arange(at, start)
        edges = start + np.concatenate([[0], np.cumsum(widths)]).astype(np.int64)
        starts += [kept, edges[:-1]]
        ends += [kept + 1, edges[1:]]
        at = end
    return layer.child("".join(parts), np.concatenate(starts), np.concatenate(ends))


def _unquoted(layer: _Layer) -> _Layer | None:
    if "%" not in layer.text:
        return None
    found = []
    for m in _PERCENT.finditer(layer.text):
        new = bytes.fromhex(m[0].replace("%", "")).decode(errors="surrogateescape")
        if any(_width(c) > 1 or c < "\x80" for c in new):  # not only bytes that are no UTF-8
            found.append((m.start(), m.end(), new, [3 * _width(c) for c in new]))
    return _replaced(layer, found)


def _unescaped(layer: _Layer) -> _Layer | None:
    if "\\" not in layer.text and "&#" not in layer.text:
        return None
    found, high = [], None
    for m in _ESCAPE.finditer(layer.text):
        code = int(m[6]) if m[6] else int(next(g for g in m.groups() if g), 16)
        if high and high[0] == m.start() and 0xDC00 <= code < 0xE000:
            _, start, top = high
            new = chr(0x10000 + ((top - 0xD800) << 10) + code - 0xDC00)
            found.append((start, m.end(), new, [m.end() - start]))
        elif code < 0x110000 and not 0xD800 <= code < 0xE000:
            found.append((m.start(), m.end(), chr(code), [m.end() - m.start()]))
        high = (m.end(), m.start(), code) if 0xD800 <= code < 0xDC00 else None
    return _replaced(layer, found)


def _width(c: str) -> int:
    """Bytes of a character; a byte that is not UTF-8 is a lone surrogate."""
    return 1 if "\udc80" <= c <= "\udcff" else len(c.encode())


def _widths(text: str) -> np.ndarray:
    """``_width`` of each character."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    widths = (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF) + 1
    widths[(codes >= 0xDC80) & (codes <= 0xDCFF)] = 1
    return widths


def _readable(data: bytes, holding: bool = False) -> str | None:
    """The text of the bytes if any of it holds something to find or to open or, unless that is
    asked for (``holding``), all of it is printable; bytes that are not UTF-8 keep a character each."""
    text = data.decode(errors="surrogateescape")
    if text and not holding and all(c.isprintable() or c in "\t\r\n" for c in text):
        return text
    return text if base_spans(text) or any(p.search(text) for p in (_BASE64, _PERCENT, _ESCAPE)) else None


def _inflated(data: bytes, limit: int) -> Iterator[tuple[bytes, bool, bool]]:
    """What compressed pieces anywhere in the bytes open to, a part at a time: (part, whether its
    piece has come to its end or is still going on well, whether the part had to be parted where
    a match may lie). Pieces that follow one another are one. Of a piece that is cut short or
    broken, the last part is what came out until then."""
    at = 0
    while piece := _MAGIC.search(data, at):
        at, held, check, whole = piece.start() + 1, bytearray(), PART_BYTES, False
        while piece:
            at, end = max(at, piece.start() + 1), None
            try:
                for out, end in _poured(data, piece):
                    held += out
                    if len(held) <= min(check, limit):
                        continue
                    apart = _last_apart(held)
                    if apart:
                        yield bytes(held[:apart]), True, False
                        del held[:apart]
                    elif len(held) > limit:
                        yield bytes(held), True, True
                        del held[: -min(1 << 20, limit // 4)]
                    check = len(held) + (PART_BYTES if apart else max(PART_BYTES, len(held)))
            except (zlib.error, OSError, ValueError, EOFError):
                end = None
            whole = end is not None
            at = end or at
            piece = _MAGIC.match(data, end) if whole else None
        if held:
            yield bytes(held), whole, False


def _poured(data: bytes | bytearray, piece: re.Match) -> Iterator[tuple[bytes, int | None]]:
    """A compressed piece as it opens, a little at a time, so that of a broken one little is lost;
    with the last of it comes where it ends."""
    machine = _opener(piece[0])
    bounded = (1 << 18,) if isinstance(machine, bz2.BZ2Decompressor) else ()
    for at in range(piece.start(), len(data), 256):
        given = data[at : at + 256]
        while True:
            out = machine.decompress(given, *bounded)
            if machine.eof:
                yield out, min(at + 256, len(data)) - len(machine.unused_data)
                return
            yield out, None
            if not bounded or machine.needs_input:
                break
            given = b""


def _last_apart(held: bytearray) -> int:
    """The last place before which a part may end: nothing to find, to decode or to open lies
    across it. 0: there is none."""
    apart = 0
    for low in (max(0, len(held) - (1 << 16)), 0):
        for m in _APART.finditer(held, low):
            apart = m.end()
        if apart:
            break
    for piece in _MAGIC.finditer(held, 0, apart):
        end = None
        try:
            for _, end in _poured(held, piece):
                pass
        except (zlib.error, OSError, ValueError, EOFError):
            continue
        if end is None or end > apart:
            return piece.start()
    return apart


def _opener(magic: bytes):
    return bz2.BZ2Decompressor() if magic[:1] == b"B" else zlib.decompressobj(31 if magic[:1] == b"\x1f" else 15)


def _opened(data: bytes, limit: int) -> Iterator[tuple[bytes, bool]]:
    """(part, whether it was parted where a match may lie) of what the bytes open to, through any
    compression inside; the same bytes once. One part of each level is held at a time."""
    seen, levels = {_digest(data)}, [_inflated(data, limit)]
    while levels:
        found = next(levels[-1], None)
        if found is None:
            levels.pop()
            continue
        part, whole, parted = found
        if (mark := _digest(part)) in seen:
            continue
        seen.add(mark)
        inside = _MAGIC.search(part)
        if whole or inside or _readable(part, holding=True):
            yield part, parted
        if inside:
            levels.append(_inflated(part, limit))


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _base64_runs(text: str):
    """Runs of base64 letters; lines of 60 to 76 letters are one run with those that follow. The
    first of them may follow other letters up to a / - _ or +."""
    at = 0
    for m in _BASE64.finditer(text):
        if m.start() < at:
            continue
        wrapped = m.end() - m.start() >= 60 and _WRAPPED.match(text, m.start())
        if not wrapped:
            yield m
            if m.end() - m.start() > 60 and text[m.end() : m.end() + 1] in ("\r", "\n"):
                for part in _PART.finditer(text, max(m.start(), m.end() - 77), m.end() - 60):
                    if wrapped := _WRAPPED.match(text, part.end()):
                        break
        if wrapped:
            at = wrapped.end()
            yield wrapped


def _unpacked(layer: _Layer, limit: int, closed: set[tuple[int, int]]) -> Iterator[_Layer]:
    """A layer for each base64 run that opens to text, through any compression inside. What a run
    holds may start after other letters, so it is decoded from each of its first four; of the
    later three, only what holds something to find or to open is text. Runs that open to a stretch
    over the limit are added to ``closed``."""
    for m in _base64_runs(layer.text):
        run = m[0]
        at = np.array([i for i, c in enumerate(run) if c not in "\r\n="]) if "\n" in run else None
        whole = run.replace("\r", "").replace("\n", "").rstrip("=").encode().translate(_TO_STANDARD)
        for phase in range(4):
            body = whole[phase:]
            if len(body) % 4 == 1:
                body = body[:-1]
            try:
                data = base64.b64decode(body + b"=" * (-len(body) % 4))
            except binascii.Error:
                continue
            for part, parted in _opened(data, limit):
                if parted:
                    closed.add(layer.source(m.start(), m.end()))
                text = _readable(part)
                if text is not None:  # a character of compressed text comes from the whole run
                    yield layer.child(text, m.start(), m.end())
            text = _readable(data, phase > 0)
            if text is None:
                continue
            sizes = _widths(text)
            last = np.cumsum(sizes)
            starts, ends = (last - sizes) * 4 // 3, -(-last * 4 // 3)
            starts, ends = starts + phase, np.minimum(ends, len(body)) + phase
            if at is not None:
                starts, ends = at[starts], at[ends - 1] + 1
            yield layer.child(text, m.start() + starts, m.start() + ends)


def scan(text: str, limit: int = MAX_STRETCH_BYTES):
    """(base spans, all spans, layers opened, runs not surely looked through) of a whole text."""
    base, spans, layers, closed = _scan(text, limit)
    return base, spans, layers, len(closed)


def _scan(text: str, limit: int):
    """The worklist starts with the text. Each layer taken from it is scanned; its percent
    escapes, character escapes and base64 runs, with compression inside, give new layers
    until none is new. A layer seen before is not opened again, so cycles end. The newest
    layer is opened first and its layers come one at a time, so the list holds one layer of
    each depth and never those beside one another."""
    base = base_spans(text)
    spans, seen, closed = set(base), {_mark(text)}, set()

    def inside(layer: _Layer) -> Iterator[_Layer]:
        yield from filter(None, (_unquoted(layer), _unescaped(layer)))
        yield from _unpacked(layer, limit, closed)

    work = [inside(_Layer(text, None, None))]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
        elif (mark := _mark(layer.text, layer.source(0, 1))) not in seen:
            seen.add(mark)
            for start, kind, end in base_spans(layer.text):
                low, high = layer.source(start, end)
                spans.add((low, kind, high))
            work.append(inside(layer))
    return base, sorted(spans), len(seen) - 1, closed


def _mark(text: str, place=None):
    """Equal texts unpacked from two places are two layers; within one place they are a cycle."""
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), place


def listed(spans) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans])


def redacted(text: str, spans) -> str:
    """The text with each run of overlapping spans replaced by the mask."""
    parts, at, until = [], 0, -1
    for start, _, end in spans:
        if start >= until:
            if until >= 0:
                parts.append(MASK)
                at = until
            parts.append(text[at:start])
            until = end
        else:
            until = max(until, end)
    if until >= 0:
        parts.append(MASK)
        at = until
    return "".join([*parts, text[at:]])


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, n_assign, n_access, n_hex and base_sha256 of the
    plain matches, ``spans`` (all, as kind:start:end in code points), n_layers opened, n_closed.

    A span found in a layer is mapped to the characters of the whole text that it was decoded
    from: exactly for percent, character and base64 encodings, the whole run for compressed data.

    A null text counts as empty and has no spans. A null id is kept. Repeated rows each give a
    row. An empty table gives no rows. Other columns are not read. What compressed data opens to
    has no limit: it is looked through in parts, parted where nothing to find can lie. A stretch of
    over 64 MiB without such a place is parted with its last MiB in both parts; n_closed is the
    number of runs that hold one.
    """

    def start():
        def work(batch):
            ids, texts = column_lists(batch, "id", "text")
            found = [scan(t or "") for t in texts]
            counts = [[sum(k == kind for _, k, _ in base) for base, *_ in found] for kind in range(3)]
            return {
                "id": ids,
                "n_assign": counts[0],
                "n_access": counts[1],
                "n_hex": counts[2],
                "base_sha256": [hashlib.sha256(listed(b).encode()).hexdigest() for b, *_ in found],
                "spans": [listed(s) for _, s, _, _ in found],
                "n_layers": [n for _, _, n, _ in found],
                "n_closed": [n for *_, n in found],
            }

        return work

    taken = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    schema = (
        "id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "spans string, n_layers long, n_closed long"
    )
    return per_batch(taken, start, schema).withColumnRenamed("id", id_column)


def redact_column(text: Column) -> Column:
    """The texts with every secret span masked, and every run that n_closed of ``scan_secrets``
    counts; null and empty texts stay as they are, texts of any length are read whole."""

    def redact(texts: list) -> list:
        out = []
        for value in texts:
            _, spans, _, closed = _scan(value or "", MAX_STRETCH_BYTES)
            spans = sorted([*spans, *((low, 0, high) for low, high in closed)])
            out.append(redacted(value, spans) if spans else value)
        return out

    return per_text(text, redact, "string")
