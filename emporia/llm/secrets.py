"""Secret scans: a worklist of decoded layers, each rescanned, spans mapped to the text.

Layer 0 is the text.  URL and Unicode escapes of a layer are decoded in the whole
layer at once, so that a keyword and its value meet wherever either was escaped;
each escaped stretch is a layer of its own as well (what stands before it may
else take up its keyword as a value).  Base64 runs are decoded from each of
their first four characters, as what stands before may be glued to them, and
lines are joined before that.  Decoded bytes, of base64 and of escapes alike,
are searched for gzip, zlib, bzip2 and xz streams (all members), for ASCII text
and for UTF-16 text; these are new layers on the worklist until no new layer
appears.  Text between other bytes is a layer too: the patterns are ASCII, and
so is all that they can be encoded in.  A layer whose content was already seen
for the same stretch of the text is not opened again, so cycles end.  Each
character of a layer knows the stretch of the original text it came from, so a
secret found five layers deep is reported where it stands in the document; in a
compressed stream that is the whole stream.

Kinds: ``assign`` (a keyword assigned a value of 12+ characters), ``access``
(AKIA keys of 18+), ``hex`` (16+).  Spans found in layer 0 are the base spans;
layers add spans and never remove any.  Null counts as empty; an empty text has
no spans; repeated rows give the same row each; extra columns are not read.

A stream that grows beyond ``LAYER_BYTES`` (a decompression bomb) is read in
overlapping blocks, each a layer.  ``n_unopened`` counts compressed streams that
end with such a block, as their rest is not read with them; the texts themselves
are never cut.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAYER_BYTES = 256 << 20
KINDS = ("assign", "access", "hex")

# Any keyword but its first letter is looked up cheaply; the whole pattern decides.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones may be left out at once

# Encoded stretches.
# They start where a run of their characters starts, so a long run without escapes is read once.
URL = re.compile(r"(?<![A-Za-z0-9_.~+*'(),:;@&=/?$!-])(?:[A-Za-z0-9_.~+*'(),:;@&=/?$!-]*%[0-9A-Fa-f]{2})+[A-Za-z0-9_.~+*'(),:;@&=/?$!-]*")
UNICODE = re.compile(r"(?<![\x21-\x5B\x5D-\x7E])(?:[\x21-\x5B\x5D-\x7E]*(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};))+[\x21-\x5B\x5D-\x7E]*")
URL_ESCAPE = re.compile(r"%([0-9A-Fa-f]{2})")
ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})|(&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});)")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Lines of base64; a line break may itself be written as an escape.
BREAK = r"(?:[\x20\t]*(?:\r?\n|(?:\\r)?\\n)[\x20\t]*)"
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:{BREAK}[A-Za-z0-9+/_-]++)+={{0,2}}")
LINE = re.compile(rf"{BREAK}|([A-Za-z0-9+/_-]+)")
#: The shortest run that any pattern or encoding of one needs.
ASCII = re.compile(rb"[\x20-\x7E\t\r\n]{16,}")
UTF16 = re.compile(rb"(?:[\x20-\x7E\t\r\n]\0){16,}|(?:\0[\x20-\x7E\t\r\n]){16,}")
#: Runs of decoded escapes and what stands between, as bytes.
BYTES = re.compile(r"[\x00-\xFF]{8,}")
SIMPLE = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|u00([0-9A-Fa-f]{2})|([abfnrtv0\\'\"/]))")
SIMPLE_CHARS = dict(zip("abfnrtv0\\'\"/", "\a\b\f\n\r\t\v\0\\'\"/", strict=True))
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17\x72\x45\x38\x50\x90)|\xfd7zXZ\0")
OPENERS = {b"\x1f": lambda: zlib.decompressobj(31), b"\x78": zlib.decompressobj, b"B": bz2.BZ2Decompressor, b"\xfd": lzma.LZMADecompressor}
BAD = (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError)
ZEROS = re.compile(rb"\0*")
PIECE, OVERLAP = 1 << 20, 1 << 20


def find(text: str) -> list[tuple[int, int, str]]:
    """Leftmost, non-overlapping spans per kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12] if ":" in text or "=" in text else []
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def _url(m: re.Match) -> str:
    return chr(int(m[1], 16))


def _escape(m: re.Match) -> str:
    if m[5]:
        return html.unescape(m[5])
    code = int(next(g for g in m.groups()[:4] if g), 16)
    return chr(code) if code < 0x110000 else "�"


def _unescaped(s: str, escape: re.Pattern, char) -> tuple[str, list[int], list[int]] | None:
    """``s`` with every escape decoded, and where each character starts and ends in ``s``.

    All patterns are ASCII, so the bytes of other characters may stay apart.
    """
    out, starts, ends, at = [], [], [], 0
    for m in escape.finditer(s):
        a, b = m.span()
        c = char(m)
        out += s[at:a], c
        starts.extend(range(at, a))
        ends.extend(range(at + 1, a + 1))
        starts.extend([a] * len(c))
        ends.extend([b] * len(c))
        at = b
    if not at:
        return None
    out.append(s[at:])
    starts.extend(range(at, len(s)))
    ends.extend(range(at + 1, len(s) + 1))
    text = "".join(out)
    return (text, starts, ends) if text else None


def _simple(m: re.Match) -> str:
    return SIMPLE_CHARS[m[3]] if m[3] else chr(int(m[1] or m[2], 16))


class Stream:
    """The compressed members that follow each other from ``at`` on."""

    def __init__(self, data: bytes, at: int):
        #: ``end``: behind the members read; ``cut``: the data end within one; ``sound``: no member broke off.
        self.data, self.at, self.end, self.cut, self.sound = data, at, at, False, True

    def pieces(self) -> Iterator[bytes]:
        """Bytes of all members, a piece at a time; what a broken member gave is kept."""
        start = self.at
        while MAGIC.match(self.data, start):
            d = OPENERS[self.data[start : start + 1]]()
            feed, at, full, got = b"", start, False, False
            try:
                while not d.eof:
                    if not feed and not full and getattr(d, "needs_input", True):
                        if at >= len(self.data):
                            self.cut = True
                            break
                        feed, at = self.data[at : at + PIECE], min(at + PIECE, len(self.data))
                    out = d.decompress(feed, PIECE)
                    feed, full = getattr(d, "unconsumed_tail", b""), len(out) >= PIECE
                    if out:
                        got = True
                        yield out
            except BAD:
                if self.end == self.at:  # a first member that is broken further on
                    self.sound, self.end = False, at if got else self.at
                return
            if self.cut:
                self.sound, self.end = False, len(self.data) if got else self.end
                return
            self.end = start = at - len(d.unused_data)
            start = ZEROS.match(self.data, start).end()  # padding between members

    def blocks(self) -> Iterator[tuple[bytes, bool]]:
        """(bytes, is a part): all bytes at once, or blocks of LAYER_BYTES that overlap."""
        held, size, part = [], 0, False
        for piece in self.pieces():
            held.append(piece)
            size += len(piece)
            if size >= LAYER_BYTES:
                block, part = b"".join(held), True
                yield block, True
                held = [block[-min(OVERLAP, LAYER_BYTES // 4) :]]
                size = len(held[0])
        if not part or len(held) > 1:
            yield b"".join(held), part


def _texts(data: bytes, part: bool = False) -> Iterator[tuple[int, str, int, int, int]]:
    """(unopened layers, text, first byte, end, bytes a character; 0: any may depend on the whole) of the texts in bytes."""
    for m in ASCII.finditer(data):
        yield 0, m.group().decode(), *m.span(), 1
    if data.count(0) >= 16:
        for m in UTF16.finditer(data):
            yield 0, m.group().replace(b"\0", b"").decode(), *m.span(), 2
    at = 0
    while m := MAGIC.search(data, at):
        stream, at = Stream(data, m.start()), m.start() + 1
        for _ in stream.pieces():  # its end first: blocks are not held
            pass
        if stream.end == stream.at:
            continue
        if stream.sound:
            at = stream.end
        if part and stream.cut:
            yield 1, "", 0, 0, 0
        for block, cut in Stream(data, m.start()).blocks():
            for lost, text, *_ in _texts(block, cut):
                yield lost, text, m.start(), stream.end, 0


def _mapped(data: bytes, starts, ends, pad: int = 0, escaped: bool = False) -> Iterator[tuple[int, tuple | None]]:
    """(unopened layers, (text, starts, ends)) of the texts in bytes that have their places in a layer; one start and end for compressed ones.

    ASCII text in ``escaped`` bytes is part of the whole decoded layer already.
    """
    for lost, text, a, b, step in _texts(data):
        if not text:
            yield lost, None
        elif not step:
            yield lost, (text, int(starts[a]), int(ends[b - 1]) + pad * (b == len(data)))
        elif step == 2 or not escaped:
            yield lost, (text, starts[a:b:step], ends[a + step - 1 : b : step])


def _base64(body: str, places, pad: int) -> Iterator[tuple[int, tuple | None]]:
    """The texts in a base64 run whose characters stand at ``places``, for each of its four phases."""
    if body.isalpha() and (body.islower() or body.istitle()):  # an ordinary long word
        return
    body = body.translate({45: "+", 95: "/"})
    for phase in range(4):
        part = body[phase:]
        part = part[: len(part) - (len(part) % 4 == 1)]
        data = base64.b64decode(part + "=" * (-len(part) % 4))
        if ASCII.search(data) or MAGIC.search(data) or data.count(0) >= 16:
            at, where = np.arange(len(data)), np.asarray(places, np.int64)
            yield from _mapped(data, where[at * 4 // 3 + phase], where[((at + 1) * 4 + 2) // 3 + phase - 1] + 1, pad)


#: Characters of which a layer must have one, the escapes, what one stands for, and stretches with escapes.
ESCAPES = ((("%",), URL_ESCAPE, _url, URL), (("\\", "&#"), ESCAPE, _escape, UNICODE))


def _decoded(layer: str, flat: bool) -> Iterator[tuple[int, tuple | None]]:
    """(unopened layers, (text, starts, ends)) of all that is encoded in a layer; places do not matter in a ``flat`` one."""
    for needs, escape, char, stretch in ESCAPES:
        if not any(n in layer for n in needs):
            continue
        if flat:
            if (text := escape.sub(char, layer)) and text != layer:
                yield 0, (text, 0, 0)
        else:
            yield 0, _unescaped(layer, escape, char)
        # Compressed and UTF-16 bytes; plain characters of the layer may stand for some of them.
        for e, c in ((escape, char), (SIMPLE, _simple)) if "\\" in needs else ((escape, char),):
            got = (e.sub(c, layer), None, None) if flat else _unescaped(layer, e, c)
            for m in BYTES.finditer(got[0] if got else ""):
                data = m.group().encode("latin-1")
                if MAGIC.search(data) or data.count(0) >= 16:
                    places = (range(len(data)), range(len(data))) if flat else [x[m.start() : m.end()] for x in got[1:]]
                    yield from _mapped(data, *places, escaped=True)
        for m in stretch.finditer(layer):
            if flat:
                yield 0, (escape.sub(char, m.group()) or " ", 0, 0)
            elif (got := _unescaped(m.group(), escape, char)) is not None:
                yield 0, (got[0], [m.start() + x for x in got[1]], [m.start() + x for x in got[2]])
    for m in BASE64.finditer(layer):
        body = m.group().rstrip("=")
        yield from _base64(body, range(m.start(), m.start() + len(body)), m.end() - m.start() - len(body))
    if "\n" in layer or "\\n" in layer:
        for m in WRAPPED.finditer(layer):
            lines = [x.span(1) for x in LINE.finditer(layer, *m.span()) if x[1]]
            if max(b - a for a, b in lines) >= 16:
                yield from _base64("".join(layer[a:b] for a, b in lines), [i for a, b in lines for i in range(a, b)], m.end() - lines[-1][1])


def scan(text: str | None) -> tuple[list, list, int]:
    """(base spans, all spans, unopened layers) of one text; a span is (start, end, kind)."""
    text = text or ""
    base = find(text)
    found, unopened = set(base), 0
    #: Layers whose content is being opened, deepest last: the stretch of the original of each character
    #: (None: the text itself; a number: the same for all), and what is still to come of it.
    work: list = [(None, None, _decoded(text, False))]
    seen: set = set()
    while work:
        starts, ends, todo = work[-1]
        lost, got = next(todo, (0, ()))
        if got == ():
            work.pop()
            continue
        unopened += lost
        if got is None:
            continue
        inner, s, e = got
        if isinstance(starts, int):
            s, e = starts, ends
        elif isinstance(s, int):
            s, e = (s, e) if starts is None else (int(starts[s]), int(ends[e - 1]))
        else:
            s, e = np.asarray(s, np.int64), np.asarray(e, np.int64)
            if starts is not None:
                s, e = starts[s], ends[np.maximum(e - 1, 0)]
        flat = isinstance(s, int)
        key = (s if flat else int(s[0]), e if flat else int(e[-1]), hashlib.blake2b(inner.encode("utf-8", "surrogatepass"), digest_size=16).digest())
        if key in seen:  # cycle detection
            continue
        seen.add(key)
        for a, b, kind in find(inner):
            found.add((s, e, kind) if flat else (int(s[a:b].min()), int(e[a:b].max()), kind))
        work.append((s, e, _decoded(inner, flat)))
    return base, list(found), unopened


def _joined(spans: list) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{k}:{a}:{b}" for a, b, k in ordered)


def scan_documents(docs: DataFrame) -> DataFrame:
    """Spans of every text of ``docs(doc_id, text)``; one narrow pass, no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                base, spans, unopened = scan(text)
                n = [sum(k == kind for _, _, k in base) for kind in KINDS]
                out.append((doc, *n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), unopened))
            yield pd.DataFrame(out, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_unopened"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_unopened long")
