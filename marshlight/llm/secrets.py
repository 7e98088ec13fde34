"""Secret scans with a recursive decoding worklist.

A text is scanned, then all its escapes (URL, Unicode) are unwrapped together into one new layer, and every run of base64 in it, also one
broken into lines or standing behind a path or a name, into a layer of its own (unpacked where it is compressed, as are compressed bytes written with escapes). Layers are
scanned in turn until nothing new comes out. Every decoded character knows the
range of the original text it came from, so what is found in a layer is reported where it stands in the text.
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
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ASSIGN_HINT = re.compile(r"passw(?:or)?d|secret|token|api_?key", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_ESCAPE = re.compile(r"%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]+(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_BREAK = re.compile(r"[/_-]")
_PACKED = (b"\x1f\x8b", b"\x78", b"BZh", b"\xfd7zXZ")
_UNPACKERS = ((b"\x1f\x8b", 31), (b"\x78", 15))
_HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
_MAGIC = re.compile(  # first bytes of gzip, zlib, bzip2 and xz data, written with escapes
    r"(?:%|\\x|\\u00)1f(?:%|\\x|\\u00)8b|(?:x|(?:%|\\x|\\u00)78)(?:%|\\x|\\u00)(?:01|5e|9c|da)|(?:%|\\x|\\u00)fd7zXZ"
    r"|BZh[1-9]1AY(?:%|\\x|\\u00)26SY|BZh[1-9]1AY&SY", re.IGNORECASE)
_BYTE = re.compile(rb"%[0-9A-Fa-f]{2}|\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}|\\[abtnvfr0\\'\"]")
_BYTES = {rb"\a": b"\a", rb"\b": b"\b", rb"\t": b"\t", rb"\n": b"\n", rb"\v": b"\v", rb"\f": b"\f", rb"\r": b"\r", rb"\0": b"\0",
          rb"\\": b"\\", rb"\'": b"'", rb"\"": b'"'}
_QUOTED = {q: re.compile(rf"(?:[^\\{q}\n]|\\.)*") for q in "'\""}
_BARE = re.compile(r"[^\s&<>\"]*")
STEPS = 8  # layers of escapes in escapes that are looked at one by one; what is nested deeper is unwrapped in one pass
_PIECE = 1 << 18  # bytes unfolded at a time
_STRETCH = 1 << 22  # characters of unfolded text looked at together; longer ones come in stretches that overlap
_OVERLAP = 1 << 18
_MEMORY = 1 << 28  # what unfolding xz may take; its strongest preset needs a quarter
_LEVELS = 200  # compressions of one run; only data that unfold for ever have more


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain patterns, leftmost and not overlapping within a kind."""
    found = []
    if _ASSIGN_HINT.search(text):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _settle(run: str) -> tuple[str, np.ndarray, np.ndarray]:
    """`run` with its escapes replaced until none is left, in one pass over it: what has come out may complete a further escape.

    Each replacement takes more signs from the end of what has come out than it puts there, so the time is linear at any depth.
    """
    out: list[str] = []
    starts, ends = array("q"), array("q")
    raw: dict[int, int] = {}  # places in `out` that hold a byte of 0x80 or more of a URL escape

    def reduced() -> bool:
        """Whether an escape ended with the last sign and was replaced."""
        last, n = out[-1], len(out)
        if last == ";":
            at = next((k for k in range(n - 4, max(-1, n - 11), -1) if out[k] == "&" and out[k + 1] == "#"), None)
        elif last in _HEX_DIGITS:
            at = next((n - k for k, lead in ((3, "%"), (4, "\\x"), (6, "\\u")) if n >= k and "".join(out[n - k:n - k + len(lead)]) == lead), None)
        else:
            return False
        if at is None or not (m := _ESCAPE.fullmatch("".join(out[at:]))):
            return False
        char = _escaped(m[0])
        if char is None:
            return False
        start, end = starts[at], ends[-1]
        del out[at:], starts[at:], ends[at:]
        if m[0][0] == "%" and ord(char) > 127:
            raw[at] = ord(char)
        out.append(char)
        starts.append(start)
        ends.append(end)
        return True

    for k, c in enumerate(run):
        out.append(c)
        starts.append(k)
        ends.append(k + 1)
        while reduced():
            pass
    places = sorted(raw)
    if places:
        groups = np.split(np.array(places), np.flatnonzero(np.diff(places) != 1) + 1)
        for group in reversed(groups):  # neighbouring bytes are UTF-8
            first, last = int(group[0]), int(group[-1]) + 1
            try:
                chars = bytes(raw[int(k)] for k in group).decode("utf-8")
            except UnicodeDecodeError:
                continue
            edge = np.cumsum([0, *(len(c.encode("utf-8")) for c in chars)]) + first
            begins, stops = [starts[int(e)] for e in edge[:-1]], [ends[int(e) - 1] for e in edge[1:]]
            out[first:last], starts[first:last], ends[first:last] = list(chars), array("q", begins), array("q", stops)
    return "".join(out), np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)


def _escaped(sign: str) -> str | None:
    """The character an escape stands for (of a URL escape, its byte); None for a number that is no character."""
    if sign[0] == "%":
        return chr(int(sign[1:], 16))
    digits = sign[2:].rstrip(";")
    code = int(digits[1:], 16) if digits[0] in "xX" else int(digits, 10 if sign[0] == "&" else 16)
    return None if code > 0x10FFFF or 0xD800 <= code <= 0xDFFF else chr(code)


def _unescape(run: str) -> tuple[str, np.ndarray, np.ndarray]:
    """`run` with its escapes replaced once, and for every character where its source starts and ends."""
    out: list[str] = []
    starts, ends = array("q"), array("q")
    at = 0
    matches = list(_ESCAPE.finditer(run))
    k = 0
    while k < len(matches):
        m = matches[k]
        out.append(run[at:m.start()])
        starts.extend(range(at, m.start()))
        ends.extend(range(at + 1, m.start() + 1))
        last = k
        if m[0][0] == "%":  # neighbouring URL escapes are bytes of UTF-8
            while last + 1 < len(matches) and matches[last + 1][0][0] == "%" and matches[last + 1].start() == matches[last].end():
                last += 1
            raw = bytes(int(x[0][1:], 16) for x in matches[k:last + 1])
            try:
                chars = raw.decode("utf-8")
            except UnicodeDecodeError:
                chars = raw.decode("latin-1")
            byte = 0
            for c in chars:
                width = len(c.encode("utf-8")) if len(chars) != len(raw) else 1
                out.append(c)
                starts.append(matches[k + byte].start())
                ends.append(matches[k + byte + width - 1].end())
                byte += width
        elif (char := _escaped(m[0])) is None:
            out.append(m[0])
            starts.extend(range(m.start(), m.end()))
            ends.extend(range(m.start() + 1, m.end() + 1))
        else:
            out.append(char)
            starts.append(m.start())
            ends.append(m.end())
        at = matches[last].end()
        k = last + 1
    out.append(run[at:])
    starts.extend(range(at, len(run)))
    ends.extend(range(at + 1, len(run) + 1))
    return "".join(out), np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)


def _is_text(raw: bytes, more: bool = False) -> bool:
    """Whether `raw` is UTF-8; with `more` to come its last character may be cut."""
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError as error:
        return more and error.start >= len(raw) - 3
    return True


def _tool(raw: bytes) -> Any:
    """What unfolds data that begins like `raw`; None if these do not look compressed."""
    for magic, bits in _UNPACKERS:
        if raw.startswith(magic):
            return zlib.decompressobj(bits)
    if raw.startswith(b"BZh"):
        return bz2.BZ2Decompressor()
    if raw.startswith(b"\xfd7zXZ"):
        return lzma.LZMADecompressor(memlimit=_MEMORY)
    return None


def _inflated(source: Iterator[bytes]) -> Iterator[bytes]:
    """What compressed data unfold to, member after member, in pieces of _PIECE bytes at most; what follows or is broken is left out."""
    tool, left, pending, ended = None, b"", False, False
    while True:
        if not ended and (len(left) < 6 if tool is None else not left and not pending):
            piece = next(source, None)
            ended = piece is None
            left += piece or b""
            continue
        if tool is None and (not left or (tool := _tool(left)) is None):
            return
        if not left and not pending:
            return
        try:
            out = tool.decompress(left, _PIECE)
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            return
        if out:
            yield out
        if tool.eof:
            left, pending, tool = tool.unused_data, False, None
        elif hasattr(tool, "unconsumed_tail"):
            left, pending = tool.unconsumed_tail, len(out) == _PIECE
        else:
            left, pending = b"", not tool.needs_input


def _unpacked(raw: bytes) -> Iterator[bytes] | None:
    """The innermost data of compressed `raw` in pieces, however often it was compressed; None if it is not compressed.

    A layer is held up to _STRETCH bytes and read on as a stream beyond. One that begins like a layer outside of it ends the cycle.
    """
    head, rest, seen = raw, iter(()), set()
    while not _is_text(head, bool(seen)) and len(seen) < _LEVELS:
        if _tool(head) is None or (mark := hashlib.blake2b(head, digest_size=16).digest()) in seen:
            break
        inner, taken, size = _inflated(chain([head], rest)), [], 0
        for piece in inner:
            taken.append(piece)
            size += len(piece)
            if size >= _STRETCH:
                break
        if not taken:
            break
        seen.add(mark)
        head, rest = b"".join(taken), inner
    return chain([head], rest) if seen else None


def _stretches(source: Iterator[bytes]) -> Iterator[str]:
    """Unfolded data as text, in stretches of about _STRETCH characters that overlap by _OVERLAP; bytes that are no UTF-8 become U+FFFD."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    held, fresh = "", False
    for piece in source:
        for at in range(0, len(piece), _PIECE):
            held += decoder.decode(piece[at:at + _PIECE])
            fresh = True
            if len(held) > _STRETCH + _OVERLAP:
                yield held
                held, fresh = held[-_OVERLAP:], False
    held += decoder.decode(b"", True)
    if fresh and held:
        yield held


def _unpacked_layers(raw: bytes, width: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Texts in compressed bytes; each character comes from all of the `width` signs these were written with."""
    source = _unpacked(raw)
    for text in _stretches(source) if source is not None else ():
        yield text, np.broadcast_to(np.int64(0), len(text)), np.broadcast_to(np.int64(width), len(text))


def _decode64(run: str) -> list[tuple[str, np.ndarray, np.ndarray]] | Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """The texts in a base64 run, unpacked if it is compressed, and where each character's source starts and ends."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return []
    try:
        raw = base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return []
    if not raw or not _is_text(raw):
        return _unpacked_layers(raw, len(run))
    data = np.frombuffer(raw, dtype=np.uint8)
    first = np.flatnonzero((data & 0xC0) != 0x80)  # bytes that begin a character
    final = np.append(first[1:], len(data))
    return [(raw.decode("utf-8"), first * 4 // 3, np.minimum(len(run), (final * 4 + 2) // 3))]


def _written_bytes(layer: str) -> Iterator[tuple[int, int, bytes]]:
    """Stretches of `layer` that hold compressed data with its bytes escaped: start, end, bytes. One in quotes ends at the next, others at a blank."""
    at = 0
    for m in _MAGIC.finditer(layer):
        if m.start() < at:
            continue
        end = _QUOTED[layer[m.start() - 1:m.start()]] if layer[m.start() - 1:m.start()] in _QUOTED else _BARE
        at = end.match(layer, m.start()).end()
        signs = layer[m.start():at].encode("utf-8")
        yield m.start(), at, _BYTE.sub(lambda b: _BYTES.get(b[0]) or bytes([int(b[0][-2:], 16)]), signs)


def _hopeful(run: str) -> bool:
    """Whether the first bytes of a base64 run may begin a text or compressed data; most others are told by them."""
    body = run[:24].rstrip("=").replace("-", "+").replace("_", "/")
    try:
        raw = base64.b64decode(body[:len(body) // 4 * 4], validate=True)
    except (binascii.Error, ValueError):
        return False
    if raw.startswith(_PACKED):
        return True
    return _is_text(raw, more=True)


def _parts(run: str) -> Iterator[tuple[int, int]]:
    """Where base64 may stand in a run besides the whole of it: after a `/`, `-` or `_`, to the end or to the next of one of these."""
    cuts = [m.start() for m in _BREAK.finditer(run)]
    if not cuts:
        return
    following = {c: len(run) for c in "/_-"}
    ends: list[tuple[int, ...]] = []
    for at in reversed([-1, *cuts]):
        ends.append(tuple(sorted({len(run), *following.values()}, reverse=True)))
        if at >= 0:
            following[run[at]] = at
    for at, stops in zip([-1, *cuts], reversed(ends)):
        start = at + 1
        if len(run) - start < 16 or not _hopeful(run[start:start + 24]):
            continue
        for stop in stops:
            if stop - start >= 16 and (start, stop) != (0, len(run)):
                yield start, stop


def _blocks(lines: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Ranges of two lines or more that may be one run: lines of one length, with a shorter one before or after or without them."""
    size = [e - s for s, e in lines]
    i = 0
    while i < len(lines):
        j = i
        while j + 1 < len(lines) and size[j + 1] == size[i]:
            j += 1
        if size[i] >= 16:
            for first in {i, i - 1 if i and size[i - 1] < size[i] else i}:
                for last in {j, j + 1 if j + 1 < len(lines) and size[j + 1] < size[i] else j}:
                    if last > first:
                        yield first, last + 1
        i = j + 1


def _decoded(layer: str, steps: int) -> Iterator[tuple[str, np.ndarray, np.ndarray, int]]:
    """What comes out of `layer` in one step: its text, where in `layer` each character's source starts and ends, and how many
    steps of escapes lie behind it. `steps` is that number for `layer`; after STEPS of them its escapes go in one pass."""
    if steps <= STEPS and _ESCAPE.search(layer):
        yield *(_settle if steps == STEPS else _unescape)(layer), steps + 1
        for at, end, raw in _written_bytes(layer):
            for text, begins, stops in _unpacked_layers(raw, end - at):
                yield text, at + begins, at + stops, 0
    for m in _BASE64.finditer(layer):
        at, run, done = m.start(), m[0], []
        for text, begins, stops in _decode64(run):
            done = [(0, len(run))]
            yield text, at + begins, at + stops, 0
        for start, stop in _parts(run):
            if any(a <= start and stop <= b and (start - a) % 4 == 0 for a, b in done[-4:]):
                continue  # a part of what has come out
            came = False
            for text, begins, stops in _decode64(run[start:stop]):
                came = True
                yield text, at + start + begins, at + start + stops, 0
            if came:
                done.append((start, stop))
    for m in _LINES.finditer(layer):
        lines = [(m.start() + x.start(), m.start() + x.end()) for x in _LINE.finditer(m[0])]
        for first, last in _blocks(lines):
            place = np.concatenate([np.arange(s, e) for s, e in lines[first:last]])
            joined = "".join(layer[s:e] for s, e in lines[first:last])
            for start, stop in [(0, len(joined)), *((a, b) for a, b in _parts(joined) if b == len(joined))]:
                came = False
                if _hopeful(joined[start:start + 24]):
                    for text, begins, stops in _decode64(joined[start:stop]):
                        came = True
                        yield text, place[start + begins], place[start + stops - 1] + 1, 0
                if came:
                    break


def layers(text: str) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Every decoded layer of `text` with the original start and end of each of its characters."""
    work: list[tuple[str, np.ndarray | None, np.ndarray | None, int]] = [(text, None, None, 0)]
    seen: set[tuple[bytes, int, int]] = set()
    while work:
        layer, starts, ends, steps = work.pop()
        for inner, begins, stops, behind in _decoded(layer, steps):
            if not inner or inner == layer:  # nothing but signs that are no escapes
                continue
            first = begins if starts is None else starts[begins]
            final = stops if ends is None else ends[stops - 1]
            mark = (hashlib.blake2b(inner.encode("utf-8", "surrogatepass"), digest_size=16).digest(), int(first[0]), int(final[-1]))
            if mark not in seen:  # a layer met before at this place ends the cycle
                seen.add(mark)
                yield inner, first, final
                work.append((inner, first, final, behind))


def all_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Plain spans of `text`, and these with what the decoded layers add, sorted by start, kind and end."""
    base = base_spans(text)
    spans = set(base)
    for inner, first, final in layers(text):
        spans |= {(int(first[s]), kind, int(final[e - 1])) for s, kind, e in base_spans(inner)}
    return base, sorted(spans)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base (plain spans), spans (all spans) and n_assign, n_access, n_hex (plain ones) of every row of `docs`.

    A span is written kind:start:end in code points of the text, end exclusive; spans are in order of start, then kind, and joined by
    commas. A span found in a decoded layer covers the encoded characters it came from (all of them, if they were
    compressed). Escapes in escapes are looked at layer by layer for STEPS layers and unwrapped in one pass beyond, compressed data
    unfold as a stream, member after member, so neither depth nor size loses anything. A null text counts as empty and has no span. Repeated rows are scanned each, a null doc_id stays,
    other columns are ignored; an empty table gives an empty table. A text is scanned whole, however long.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {"base": [], "spans": []} | {f"n_{k}": [] for k in KINDS}
            for text in batch["text"]:
                base, spans = all_spans(text) if text else ([], [])
                out["base"].append(_written(base))
                out["spans"].append(_written(spans))
                for i, k in enumerate(KINDS):
                    out[f"n_{k}"].append(sum(kind == i for _, kind, _ in base))
            yield pd.DataFrame({"doc_id": batch["doc_id"], **out})

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(scan, f"doc_id {kind}, base string, spans string, {counts}")
