"""Secret scan by a recursive decoding worklist.

A text is the first layer. Every layer is scanned for secrets, and every run in it that decodes
(URL escapes, Unicode and byte escapes, base64 of either alphabet, also wrapped over lines or behind a
word of a path, gzip or zlib data inside base64, all members of it) is put on the worklist as a layer of its
own. That goes on until no new layer appears. A layer whose content was seen in the same text before is not
scanned again, which ends cycles. Each layer keeps where its characters came from in the text, as runs of
equal steps, so a secret in a deep layer has a span in the text.

All layers of one text are handled in one task. Compressed data is inflated piece by piece; a piece is a
layer of about ``PIECE`` characters that begins with the last ``OVERLAP`` of the one before, so that memory is
bounded by a piece per depth and nothing is cut off. What is itself encoded and longer than the overlap
may lie over the border of two pieces, and is then found in parts.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame

from tidemark.llm.common import id_and_text, ids, map_texts

# The patterns of the contract. Kinds in the order in which they are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST_VALUE, SHORTEST_ACCESS = 6, 20

PIECE, OVERLAP = 4 << 20, 256 << 10
SHORTEST_BASE64 = 16
#: What is decoded of a run to see whether it is anything, before all of it is.
TASTE = 64
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ONE = r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
_ONE_ESCAPE = re.compile(_ONE)
_ESCAPE = re.compile("(?:" + re.sub(r"\((?!\?)", "(?:", _ONE) + ")+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST_BASE64)
#: Lines of base64 of at least that length, each but the last as long as the first.
_WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{%d,}(?:\r?\n[A-Za-z0-9+/_-]+)+={0,2}" % SHORTEST_BASE64)
_SEPARATOR = re.compile(r"[/_+-]+")
_KEYWORDS = re.compile(r"pass|secret|token|api", re.IGNORECASE | re.ASCII)

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Secrets of one layer as (start, end, kind): leftmost, non-overlapping per kind."""
    found: list[Span] = []
    if _KEYWORDS.search(text):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= SHORTEST_VALUE:
                found.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= SHORTEST_ACCESS:
                found.append((m.start(), m.end(), "access"))
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


class Layer:
    """A decoded text and where it came from in the outermost one, by runs.

    Run i covers the characters from ``at[i]`` to ``at[i + 1]``. Those of a run with step 1 came from
    consecutive places from ``first[i]`` on, those of a run with step 0 all from ``first[i]`` to ``last[i]``.
    """

    def __init__(self, text: str, at: list[int], first: list[int], last: list[int], step: list[int]):
        self.text, self.at, self.first, self.last, self.step = text, at, first, last, step

    @classmethod
    def outermost(cls, text: str) -> Layer:
        return cls(text, [0], [0], [len(text)], [1])

    @classmethod
    def whole(cls, text: str, source: tuple[int, int]) -> Layer:
        """A text that came from one place as a whole."""
        return cls(text, [0], [source[0]], [source[1]], [0])

    def _place(self, i: int) -> tuple[int, int]:
        run = bisect_right(self.at, i) - 1
        if not self.step[run]:
            return self.first[run], self.last[run]
        place = self.first[run] + i - self.at[run]
        return place, place + 1

    def source(self, start: int, end: int) -> tuple[int, int]:
        """Decoding keeps the order of places, so the two ends tell the span."""
        return self._place(start)[0], self._place(end - 1)[1]

    def runs(self, start: int, end: int) -> Iterator[tuple[int, int, int, int]]:
        """(length, first, last, step) of the runs of a part."""
        run = bisect_right(self.at, start) - 1
        while start < end:
            stop = min(end, self.at[run + 1] if run + 1 < len(self.at) else end)
            first = self.first[run] + (start - self.at[run]) * self.step[run]
            yield stop - start, first, self.last[run], self.step[run]
            start, run = stop, run + 1


def _decoded_escapes(run: str) -> list[tuple[str, int, int]]:
    """Characters of a run of escapes with their place in it; surrogate pairs joined."""
    units: list[tuple[int, int, int]] = []
    for m in _ONE_ESCAPE.finditer(run):
        digits = next(g for g in m.groups() if g is not None)
        units.append((int(digits, 10 if m[5] else 16), m.start(), m.end()))
    out = []
    i = 0
    while i < len(units):
        code, start, end = units[i]
        if 0xD800 <= code < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1][0] < 0xE000:
            code = 0x10000 + ((code - 0xD800) << 10) + (units[i + 1][0] - 0xDC00)
            end = units[i + 1][2]
            i += 1
        i += 1
        if code < 0x110000 and not 0xD800 <= code < 0xE000:
            out.append((chr(code), start, end))
    return out


def _decoded_url(run: str) -> list[tuple[str, int, int]]:
    """Characters of a run of URL escapes with their place; bytes that are no UTF-8 are Latin-1."""
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        text = raw.decode("latin-1")
        return [(c, 3 * i, 3 * i + 3) for i, c in enumerate(text)]
    out, at = [], 0
    for c in text:
        size = 3 * len(c.encode())
        out.append((c, at, at + size))
        at += size
    return out


def is_compressed(raw: bytes) -> bool:
    """Whether data starts like gzip or zlib data."""
    return raw[:2] == b"\x1f\x8b" or (raw[:1] == b"\x78" and len(raw) > 2 and (raw[0] << 8 | raw[1]) % 31 == 0)


def inflated(raw: bytes) -> Iterator[bytes]:
    """The content of gzip or zlib data by pieces, one member after the other, as far as it can be read."""
    while is_compressed(raw):
        member, data = zlib.decompressobj(wbits=47), raw
        try:
            while data and not member.eof:
                piece = member.decompress(data, PIECE)
                data = member.unconsumed_tail
                if piece:
                    yield piece
        except zlib.error:
            return
        raw = member.unused_data


def _readable(text: str) -> bool:
    """No control characters but white space."""
    return all(c.isprintable() or c in "\t\n\r" for c in text) if text else False


def _text_pieces(raw: bytes) -> Iterator[str]:
    """Compressed data as pieces of text that overlap; ends where it is no text."""
    decoder, kept = codecs.getincrementaldecoder("utf-8")(), ""
    for piece in inflated(raw):
        try:
            text = decoder.decode(piece)
        except UnicodeDecodeError:
            return
        if text and not _readable(text):
            return
        kept = kept[-OVERLAP:] + text
        if text:
            yield kept


def _raw(run: str) -> bytes | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _readable_start(raw: bytes) -> str:
    """The text that data begins with, up to what is no UTF-8 or a control character."""
    try:
        text = raw.decode()
    except UnicodeDecodeError as error:
        text = raw[: error.start].decode()
    if _readable(text):
        return text
    end = next((i for i, c in enumerate(text) if not (c.isprintable() or c in "\t\n\r")), len(text))
    return text[:end]


def _promises(run: str) -> bool:
    """Whether the beginning of a run decodes to compressed data or to text."""
    taste = _raw(run[:TASTE].rstrip("="))
    if taste is None or len(taste) < 6:
        return False
    return is_compressed(taste) or len(_readable_start(taste).encode()) > len(taste) - 4


def unpacked(run: str) -> Iterator[str]:
    """The texts inside a base64 run, through compression if there is any; nothing if it has no text."""
    raw = _raw(run) if _promises(run) else None
    if raw is None:
        return
    if is_compressed(raw):
        yield from _text_pieces(raw)
        return
    text = _readable_start(raw)
    if text and (len(run) > TASTE or len(text.encode()) == len(raw)):
        yield text


def _texts_of(run: str) -> Iterator[tuple[int, str]]:
    """Texts inside a run and where in it they begin: at its start, or else behind the first separator that
    has any. Only the beginning is decoded to see that, so a run of many separators costs its length."""
    found = False
    for text in unpacked(run):
        found = True
        yield 0, text
    for cut in () if found else _SEPARATOR.finditer(run):
        for at in range(cut.start() + 1, cut.end() + 1):  # a separator may be the first character, too
            if len(run) - at >= SHORTEST_BASE64 and _promises(run[at : at + TASTE]):
                for text in unpacked(run[at:]):
                    found = True
                    yield at, text
                if found:
                    return


def _base64_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, run) of what may be base64: runs and wrapped lines."""
    for m in _BASE64.finditer(text):
        yield m.start(), m.end(), m[0]
    if "\n" not in text:
        return
    for m in _WRAPPED.finditer(text):
        lines = m[0].replace("\r", "").split("\n")
        first, at = 0, m.start()
        while first < len(lines) - 1:
            width, last = len(lines[first]), first + 1
            while last < len(lines) - 1 and len(lines[last]) == width:
                last += 1
            if len(lines[last].rstrip("=")) > width:
                last -= 1
            size = sum(len(x) + 1 for x in lines[first : last + 1]) - 1
            breaks = text.count("\r", at, at + size + last - first)
            if last > first and width >= SHORTEST_BASE64:
                yield at, at + size + breaks, "".join(lines[first : last + 1])
                if last - first > 1:  # the last line may be a word behind it
                    yield at, at + size + breaks - len(lines[last]) - 1, "".join(lines[first:last])
            step = max(last, first + 1)
            at += sum(len(x) + 1 for x in lines[first:step])
            at += text.count("\r", at - 1, at + step - first)
            first = step


def _rewritten(layer: Layer, pattern, decode) -> Layer | None:
    """The layer with all runs of escapes replaced, or None if it has none."""
    pieces: list[str] = []
    at, first, last, step = [], [], [], []
    size = done = 0

    def add(length: int, a: int, b: int, how: int) -> None:
        nonlocal size
        at.append(size)
        first.append(a)
        last.append(b)
        step.append(how)
        size += length

    def copied(start: int, end: int) -> None:
        pieces.append(layer.text[start:end])
        for run in layer.runs(start, end):
            add(*run)

    for m in pattern.finditer(layer.text):
        copied(done, m.start())
        for c, start, end in decode(m[0]):
            pieces.append(c)
            add(len(c), *layer.source(m.start() + start, m.start() + end), 0)
        done = m.end()
    if not done:
        return None
    copied(done, len(layer.text))
    text = "".join(pieces)
    return Layer(text, at, first, last, step) if text else None


def inner_layers(layer: Layer) -> Iterator[Layer]:
    """What one decoding step makes of a layer."""
    if "%" in layer.text:
        found = _rewritten(layer, _URL, _decoded_url)
        if found:
            yield found
    if "\\" in layer.text or "&#" in layer.text:
        found = _rewritten(layer, _ESCAPE, _decoded_escapes)
        if found:
            yield found
    for start, end, run in _base64_runs(layer.text):
        for at, text in _texts_of(run):
            yield Layer.whole(text, layer.source(start + at, end))


def _mark(layer: Layer) -> bytes:
    """Tells layers of one text apart, by content and place."""
    mark = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16)
    mark.update(repr(layer.source(0, len(layer.text))).encode())
    return mark.digest()


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans of the text, and those of all its layers, mapped to the text, without doubles.

    The worklist holds the layers that are being unwrapped, the innermost last; each is made when it is
    its turn, so that no more than one per depth is held.
    """
    base = base_spans(text)
    every = set(base)
    if not text:
        return base, []
    outermost = Layer.outermost(text)
    seen = {_mark(outermost)}
    worklist = [inner_layers(outermost)]
    while worklist:
        inner = next(worklist[-1], None)
        if inner is None:
            worklist.pop()
            continue
        mark = _mark(inner)
        if mark in seen:
            continue
        seen.add(mark)
        for start, end, kind in base_spans(inner.text):
            every.add((*inner.source(start, end), kind))
        worklist.append(inner_layers(inner))
    return base, sorted(every, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_decoded; one row per input row.

    Positions are code points of the text, ends exclusive. ``n_decoded`` counts the spans that only a
    decoded layer shows. NULL and empty texts have no spans; repeated rows and a NULL doc_id are
    scanned like any other.
    """

    def rows(batch) -> Iterator[dict]:
        out: dict[str, list] = {
            n: []
            for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_decoded")
        }
        for text in batch.column("text").to_pylist():
            base, every = scan(text)
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(s[2] == kind for s in base))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(every))
            out["n_decoded"].append(len(every) - len(base))
        yield {"doc_id": ids(batch), **out}

    return map_texts(
        id_and_text(docs),
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
        "spans string, n_decoded bigint",
        rows,
    )
