"""Secret scan with a recursive decoding worklist.

The whole text is scanned first (the base spans).  Then every encoded run in
it is unwrapped into a layer of its own and put on a worklist: percent
escapes, backslash-u, percent-u and character-reference escapes, base64 (in one run, or
in lines of one width; at each of its four alignments, so that signs before it
do not hide it), UTF-16 in base64, and compressed data inside base64 or percent escapes
(gzip, zlib, bz2, xz, zstd, behind other bytes or not; deflate without a header from the
first byte; all members, and compressed again or not).  A
layer need not be all text: bytes that are none are passed over.  Each layer is scanned again
and unwrapped further until no new layer appears; a layer whose content was
seen before is not entered again, so decoding cycles end.  A layer knows for
each of its characters which span of the original text it came from, and a
secret found in it is reported at that span.

Defined results: NULL text counts as empty; a document without secrets has
zero counts and an empty span list; repeated rows get equal results.  A
compressed layer over ``MAX_LAYER`` characters is scanned in windows, cut
between characters where no secret and no encoded run goes on; a window grows
until there is such a place, so the results do not depend on its size.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from folioflow.llm.batches import map_columns, pick, replace_rows

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of 32 and more: a shorter run never yields a match

RUN = re.compile(r"[^\s\"'<>]+")
PERCENT = re.compile(r"%[0-9A-Fa-f]{2}")
ESCAPES = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|(?:\\|%)u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
LINE_END = re.compile(r"\r?\n[\x20\t]*")
LAST_LINE = re.compile(LINE_END.pattern + r"([A-Za-z0-9+/_-]+={0,2})(?![A-Za-z0-9+/_=-])")
STRETCH = re.compile(r"[\t\r\n\x20-\x7e]{14}")  # the shortest secret: token=12345678
MAX_LAYER = 8_000_000
LONE = re.compile("[\udc80-\udcff]")
# after these no match and no encoded run goes on: characters that are in none, the space
# between two words, and the end of a line that is not one of wrapped base64
BREAK = re.compile(r"[^\t\r\n\x20-\x7e]|[<>\[\]^`|]|(?<=[g-zG-Z.,])\x20(?=[A-Za-z0-9])|(?<![A-Za-z0-9+/_;}\r-])\r?\n")
PROBE = 65_536
ZSTD_STEP = 512  # compressed bytes read at once
BINARY = re.compile(rb"[^\t\r\n\x20-\x7e]")
HEX_VALUE = np.array([int(chr(b), 16) if chr(b) in "0123456789abcdefABCDEF" else -1 for b in range(256)])
BROKEN = (zlib.error, zstandard.ZstdError, OSError, EOFError, lzma.LZMAError, ValueError)
ZLIB = b"|".join(re.escape(bytes((c, f))) for c in range(0x08, 0x79, 16) for f in range(256) if (c << 8 | f) % 31 == 0 and not f & 0x20)
MAGIC = re.compile(rb"\x1f\x8b\x08|\x28\xb5\x2f\xfd|BZh[1-9]|\xfd7zXZ\x00|" + ZLIB, re.S)  # where compressed data may begin


@dataclass
class Layer:
    """Decoded characters; character i came from ``starts[i] .. ends[i] - 1`` of the text."""

    text: str
    starts: np.ndarray
    ends: np.ndarray


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of each match, leftmost and not overlapping within a kind."""
    out = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


def _member(data: bytes) -> Generator[bytes, None, bytes]:
    """Pieces of the first compressed member of ``data``, if it is one of a known form; returns the bytes after it."""
    if data[:2] == b"\x1f\x8b" or (len(data) > 2 and data[0] & 0x0F == 8 and (data[0] << 8 | data[1]) % 31 == 0):
        work = zlib.decompressobj(47)
        piece = work.decompress(data, MAX_LAYER)
        while piece:
            yield piece
            piece = work.decompress(work.unconsumed_tail, MAX_LAYER) if work.unconsumed_tail else b""
    elif data[:4] == b"\x28\xb5\x2f\xfd":
        work = zstandard.ZstdDecompressor().decompressobj()  # its output is not bounded, so its input is
        for at in range(0, len(data), ZSTD_STEP):
            piece = work.decompress(data[at : at + ZSTD_STEP])
            for lo in range(0, len(piece), MAX_LAYER):
                yield piece[lo : lo + MAX_LAYER]
            if work.eof:
                return work.unused_data + data[at + ZSTD_STEP :]
        return b""
    elif data[:3] == b"BZh" or data[:6] == b"\xfd7zXZ\x00":
        work = bz2.BZ2Decompressor() if data[:3] == b"BZh" else lzma.LZMADecompressor()
        piece = work.decompress(data, MAX_LAYER)
        while piece:
            yield piece
            piece = b"" if work.eof else work.decompress(b"", MAX_LAYER)
    elif data[1:4] == b"\x2a\x4d\x18" and data[0] >> 4 == 5:  # a zstd frame to be skipped
        return data[8 + int.from_bytes(data[4:8], "little") :]
    else:
        return b""
    return work.unused_data


def _packed(data: bytes) -> bool:
    """Whether ``data`` begins with compressed data."""
    try:
        return next(_member(data[:PROBE]), None) is not None
    except BROKEN:
        return False


def _inflate(data: bytes, nested: list[bytes]) -> Iterator[bytes]:
    """Pieces of the members of ``data`` one after the other; what is compressed again goes to ``nested`` whole."""
    while data:
        pieces = _member(data)
        rest = b""
        try:
            piece = next(pieces)
            inner = [piece] if _packed(piece) else None
            try:
                while True:
                    if inner is None:
                        yield piece
                    piece = next(pieces)
                    if inner is not None:
                        inner.append(piece)
            finally:
                if inner is not None:
                    nested.append(b"".join(inner))
        except StopIteration as end:
            rest = (end.value or b"").lstrip(b"\x00")  # zeros: padding between members
        except BROKEN:
            pass  # cut off or damaged: what came before counts
        if rest and not _packed(rest):
            nested.append(rest)
            return
        data = rest


def _unpack(data: bytes) -> Iterator[str]:
    """The texts inside ``data``, which is unwrapped as long as there is compressed data in it."""
    work, seen = [data], set()
    while work:
        data = work.pop()
        mark = hashlib.blake2b(data, digest_size=16).digest()
        if mark in seen:
            continue
        seen.add(mark)
        plain = data.decode("utf-8", "surrogateescape")  # a byte that is no UTF-8 becomes a lone surrogate
        if _legible(plain):
            yield plain
        if not LONE.search(plain) and _readable(plain):
            continue
        yield from _wide(data)
        # bytes that are not all text may be compressed, and may be text in part
        known = False
        for window in _windows(_inflate(data, work)):
            known = True
            if _legible(window):
                yield window
        if not known:
            yield from _bare(data)


def _wide(data: bytes) -> Iterator[str]:
    """Text of two bytes a character (UTF-16 of either order, from either byte on)."""
    if data.count(0) < 14 and data[:2] not in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE):
        return
    for first in (0, 1):
        for order in ("utf-16-le", "utf-16-be"):
            text = data[first:].decode(order, "replace")
            if STRETCH.search(text):
                yield text


def _bare(data: bytes) -> Iterator[str]:
    """The text of a deflate stream without any header, if all that it gives is text."""
    try:
        if not _readable(zlib.decompressobj(-15).decompress(data[:PROBE], PROBE).decode("utf-8", "surrogateescape")):
            return
        work = zlib.decompressobj(-15)

        def pieces() -> Iterator[bytes]:
            piece = work.decompress(data, MAX_LAYER)
            while piece:
                yield piece
                piece = work.decompress(work.unconsumed_tail, MAX_LAYER) if work.unconsumed_tail else b""

        for window in _windows(pieces()):
            if _legible(window):
                yield window
    except BROKEN:
        return


def _windows(pieces: Iterator[bytes]) -> Iterator[str]:
    """Pieces decoded and joined to windows, cut only where no secret and no encoded run goes on."""
    decoder = codecs.getincrementaldecoder("utf-8")("surrogateescape")
    held, looked = "", 0
    for piece in pieces:
        held += decoder.decode(piece)
        if len(held) > MAX_LAYER:
            cut = max((m.end() for m in BREAK.finditer(held, looked)), default=0)
            looked = max(0, len(held) - 2)
            if cut:
                yield held[:cut]
                held, looked = held[cut:], 0
    held += decoder.decode(b"", True)
    if held:
        yield held


def _readable(text: str) -> bool:
    """Whether ``text`` is of (nearly) printable characters."""
    odd = sum(1 for c in text if not c.isprintable() and c not in "\t\r\n")
    return bool(text) and odd * 20 <= len(text)


def _legible(text: str) -> bool:
    """Whether ``text`` is readable or has a stretch in it that could be a secret."""
    return STRETCH.search(text) is not None or _readable(text)


def _base64_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, characters) of each base64 run, and of each block of such lines of one width."""
    block: list[re.Match] = []
    for m in BASE64.finditer(text):
        yield m.start(), m.end(), m.group()
        if block:
            width = len(block[0].group())
            if len(m.group()) <= width and LINE_END.fullmatch(text, block[-1].end(), m.start()):
                block.append(m)
                if len(m.group()) == width and not m.group().endswith("="):
                    continue
            yield from _block(text, block)
        block = [] if m.group().endswith("=") else [m]
    if block:
        yield from _block(text, block)


def _block(text: str, lines: list[re.Match]) -> Iterator[tuple[int, int, str]]:
    """The lines joined, with a shorter one after them; nothing for a single line."""
    run, hi = "".join([m.group() for m in lines]), lines[-1].end()
    width = len(lines[0].group())
    count = len(lines)
    if len(lines[-1].group()) == width and not run.endswith("="):
        tail = LAST_LINE.match(text, hi)
        if tail and len(tail.group(1)) < width:
            run, hi, count = run + tail.group(1), tail.end(), count + 1
    if count > 1:
        yield lines[0].start(), hi, run


def _decode_base64(run: str) -> bytes | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) // 4 * 4 + (len(body) % 4 if len(body) % 4 != 1 else 0)]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _unwrap(layer: Layer) -> Iterator[Layer]:
    """The layers directly inside ``layer``."""
    text = layer.text
    if PERCENT.search(text):
        yield _bytewise(layer)
        for m in RUN.finditer(text):
            if PERCENT.search(m.group()):
                yield from _packed_run(layer, m.start(), m.end())
    if "\\" in text or "&#" in text or "%u" in text:
        found = list(ESCAPES.finditer(text))
        if found:
            yield _escaped(layer, found)
    for start, end, run in _base64_runs(text):
        if run.isalpha() and (run.islower() or run[1:].islower()):
            continue  # a plain word
        hi = int(layer.ends[end - 1])
        # what stands before the encoded part (a path, a name) shifts it: one of four alignments reads it
        for shift in range(4):
            data = _decode_base64(run[shift:])
            if not data:
                continue
            lo = int(layer.starts[start + shift])
            for plain in _unpack(data):
                yield _coarse(plain, lo, hi)
            for m in MAGIC.finditer(data, 1):  # compressed data behind other bytes
                if _packed(data[m.start() : m.start() + PROBE]):
                    for plain in _unpack(data[m.start() :]):
                        yield _coarse(plain, lo, hi)


def _coarse(text: str, lo: int, hi: int) -> Layer:
    return Layer(text, np.broadcast_to(np.int64(lo), len(text)), np.broadcast_to(np.int64(hi), len(text)))


def _percent_bytes(layer: Layer) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The bytes of ``layer`` with its percent escapes decoded, and the span of each."""
    raw = np.frombuffer(layer.text.encode("utf-8", "surrogateescape"), dtype=np.uint8)
    size = _sizes(layer.text)
    starts, ends = np.repeat(layer.starts, size), np.repeat(layer.ends, size)
    at = np.flatnonzero(raw[:-2] == ord("%"))
    high, low = HEX_VALUE[raw[at + 1]], HEX_VALUE[raw[at + 2]]
    good = (high >= 0) & (low >= 0)
    at, value = at[good], (high * 16 + low)[good]
    raw = raw.copy()
    raw[at] = value
    ends[at] = ends[at + 2]
    kept = np.ones(len(raw), dtype=bool)
    kept[at + 1] = kept[at + 2] = False
    return raw[kept].tobytes(), starts[kept], ends[kept]


def _sizes(text: str) -> np.ndarray:
    """Bytes of each character; one for a byte that is no UTF-8 (a lone surrogate here)."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
    return np.where((code >= 0xDC80) & (code <= 0xDCFF), 1, size)


def _packed_run(layer: Layer, lo: int, hi: int) -> Iterator[Layer]:
    """The texts of compressed data that stands in a run as percent escapes."""
    raw, starts, ends = _percent_bytes(Layer(layer.text[lo:hi], layer.starts[lo:hi], layer.ends[lo:hi]))
    if not BINARY.search(raw):
        return
    for m in MAGIC.finditer(raw):
        if _packed(raw[m.start() : m.start() + PROBE]):
            for plain in _unpack(raw[m.start() :]):
                yield _coarse(plain, int(starts[m.start()]), int(ends[-1]))


def _bytewise(layer: Layer) -> Layer:
    """The whole layer with its percent escapes decoded (UTF-8, bytes that are none by themselves)."""
    raw, starts, ends = _percent_bytes(layer)
    text = raw.decode("utf-8", "surrogateescape")
    last = np.cumsum(_sizes(text))
    return Layer(text, starts[np.concatenate([[0], last[:-1]])], ends[last - 1])


def _escaped(layer: Layer, found: list[re.Match]) -> Layer:
    """The whole layer with its backslash and character-reference escapes decoded."""
    parts, starts, ends = [], [], []
    at = 0
    for m in found:
        parts.append(layer.text[at : m.start()])
        starts.append(layer.starts[at : m.start()])
        ends.append(layer.ends[at : m.start()])
        u, plain, x, hexa, dec = m.groups()
        code = int(dec) if dec else int(u or plain or x or hexa, 16)
        if code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF:
            parts.append(chr(code))
            starts.append(layer.starts[m.start() : m.start() + 1])
            ends.append(layer.ends[m.end() - 1 : m.end()])
        else:
            parts.append(m.group())
            starts.append(layer.starts[m.start() : m.end()])
            ends.append(layer.ends[m.start() : m.end()])
        at = m.end()
    parts.append(layer.text[at:])
    starts.append(layer.starts[at:])
    ends.append(layer.ends[at:])
    return Layer("".join(parts), np.concatenate(starts), np.concatenate(ends))


def scan(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]], int]:
    """Base spans, all spans, and the number of layers entered besides the text."""
    base = base_spans(text)
    spans = set(base)
    work: list[Layer] = []
    if "%" in text or "\\" in text or "&#" in text or BASE64.search(text):
        at = np.arange(len(text), dtype=np.int64)
        work.append(Layer(text, at, at + 1))
    seen = {hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()}
    entered = 0
    while work:
        for inner in _unwrap(work.pop()):
            # equal content at another place is another layer; at the same place it is a cycle
            mark = hashlib.blake2b(inner.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            mark += int(inner.starts[0]).to_bytes(8, "little") if len(inner.starts) else b""
            if mark in seen or mark[:16] in seen or not inner.text:
                continue
            seen.add(mark)
            entered += 1
            for lo, kind, hi in base_spans(inner.text):
                spans.add((int(inner.starts[lo:hi].min()), kind, int(inner.ends[lo:hi].max())))
            work.append(inner)
    return base, sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2])), entered


def _join(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{lo}:{hi}" for lo, k, hi in spans)


SCHEMA = {
    "doc_id": "long",
    "n_assign": "long",
    "n_access": "long",
    "n_hex": "long",
    "base_sha256": "string",
    "spans": "string",
    "n_layers": "long",
}


def find_secrets(docs: DataFrame) -> DataFrame:
    """Counts and spans of the secrets in each row of ``docs`` (``doc_id``, ``text``)."""

    def start():
        def work(cols):
            out = {n: [] for n in SCHEMA}
            out["doc_id"] = cols["doc_id"]
            for text in cols["text"]:
                base, spans, layers = scan(text or "")
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(s[1] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(_join(base).encode()).hexdigest())
                out["spans"].append(_join(spans))
                out["n_layers"].append(layers)
            return out

        return work

    return map_columns(pick(docs, doc_id="long", text="string"), SCHEMA, start)


def redact(text: str, mark: str = "[SECRET]") -> str:
    """``text`` with every span of :func:`scan` (overlapping ones merged) replaced."""
    parts, at = [], 0
    merged: list[list[int]] = []
    for lo, _, hi in scan(text)[1]:
        if merged and lo < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    for lo, hi in merged:
        parts += [text[at:lo], mark]
        at = hi
    return "".join([*parts, text[at:]]) if merged else text


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced and ``n_chars`` (if there) renewed."""

    def start():
        def work(texts):
            clean = [None if t is None else redact(t) for t in texts]
            return {"text": clean, "n_chars": [None if t is None else len(t) for t in clean]}

        return work

    return replace_rows(docs, "text", {"text": "string", "n_chars": "long"}, start)
