"""Secret scan through nested encodings.

A worklist starts with the text itself. Each layer is scanned with all patterns; then its URL and Unicode escapes are
undone in place (one new layer, and one with plus signs as spaces where a text is URL-encoded), and what each run of
base64 decodes to, wrapped in lines or not and from any of its first four characters on, as something may be glued to it,
becomes layers of its own, as do gzip, zlib, bz2, xz and raw deflate streams in it, and gzip and zlib ones in escaped bytes.
Bytes are read as UTF-8, or UTF-16 or 32 if they look like it, or else as Latin-1. That repeats until
nothing new comes up; layers already seen are left out, so cycles end. Every layer has a map from its characters to the
code points of the text, so each find is told as a span of the text.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import per_row

#: Fixed patterns and least lengths, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 and more
KINDS = ("assign", "access", "hex")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

ESCAPE = re.compile(
    r"(?:%[0-9A-Fa-f]{2})+|(?:%u[0-9A-Fa-f]{4})+|\\u[0-9A-Fa-f]{4}(?:\\u[0-9A-Fa-f]{4})*|\\x[0-9A-Fa-f]{2}(?:\\x[0-9A-Fa-f]{2})*|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\[0-3][0-7]{2})+|\\[/\"]"
    r"|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});?|&[A-Za-z][A-Za-z0-9]{1,30};"
)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Lines of base64 that follow each other.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
RUN = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
LEAST_BASE64 = 16
#: Bytes written with escapes, from the header of a gzip or zlib stream on; bytes that are printable may stand for themselves.
PERCENT = re.compile(r"(?:%1[fF]%8[bB]|(?:x|%78)%(?:01|5[eE]|9[cC]|[dD][aA]))(?:%[0-9A-Fa-f]{2}|[!#$&-~])*+")
QUOTED = re.compile(r"(?:\\x1[fF]\\x8[bB]|(?:x|\\x78)(?:\\x01|\^|\\x5[eE]|\\x9[cC]|\\x[dD][aA]))(?:\\x[0-9A-Fa-f]{2}|\\[\\'\"nrtabfv0]|[\x20-\[\]-~])*+")
PERCENT_BYTE = re.compile(r"%([0-9A-Fa-f]{2})()")
QUOTED_BYTE = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|([\\'\"nrtabfv0]))")
PLAIN = dict(zip("nrtabfv0", "\n\r\t\a\b\f\v\0", strict=True))
GZIP, BZIP, XZ = b"\x1f\x8b", b"BZh", b"\xfd7zXZ\0"
HEADER = re.compile(rb"\x1f\x8b|BZh|\xfd7zXZ\x00|\x78[\x01\x5e\x9c\xda]")
#: Bytes that are unpacked at a time; they give about a thousand times as many at most.
STEP = 1 << 10
#: What a compressed stream unpacks to beyond so many bytes is scanned in pieces, each with the last OVERLAP bytes of the one before;
#: all finds of a stream have one span, so a find that lies whole in a piece is enough.
LAYER_CHARS = 1 << 26
OVERLAP = 1 << 20


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of all finds in one layer."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return found


def undone(match: str) -> str | None:
    """The characters of a run of escapes; None if it stands for none."""
    try:
        if match[:2] == "%u":
            return bytes.fromhex(match.replace("%u", "")).decode("utf-16-be", "surrogatepass")
        if match[0] == "%":
            return as_text(bytes.fromhex(match.replace("%", "")))
        if match[0] == "&" and match[1] != "#":
            return new if (new := html.unescape(match)) != match else None
        if match[0] == "&" or match[1] in "U{" or match[:3] == "\\u{":
            digits = match.strip("&#;\\uU{}")
            n = int(digits.lstrip("xX"), 16) if match[0] != "&" or digits[0] in "xX" else int(digits)
            return chr(n) if n and n < 0x110000 and not 0xD800 <= n < 0xE000 else None
        if match[1] == "x":
            return as_text(bytes.fromhex(match.replace("\\x", "")))
        if match[1] in '/"':
            return match[1]
        if match[1].isdigit():
            return as_text(bytes(int(x, 8) for x in match[1:].split("\\")))
        units = bytes.fromhex(match.replace("\\u", ""))
        return units.decode("utf-16-be", "surrogatepass")
    except (UnicodeDecodeError, ValueError):
        return None


def is_utf8(data: bytes) -> bool:
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def wide_encoding(data: bytes) -> str | None:
    """UTF-16 or UTF-32 if bytes begin with its mark or have their zeros where it has them."""
    for mark, name in ((b"\xff\xfe\0\0", "utf-32"), (b"\0\0\xfe\xff", "utf-32"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if data.startswith(mark):
            return name
    if len(data) < 8 or 0 not in data:
        return None
    zeros = [data[k::4].count(0) * 4 / len(data) for k in range(4)]
    for name, places in (("utf-32-le", (1, 2, 3)), ("utf-32-be", (0, 1, 2)), ("utf-16-le", (1, 3)), ("utf-16-be", (0, 2))):
        if all((zeros[k] > 0.7) == (k in places) for k in range(4)):
            return name
    return None


def as_text(data: bytes) -> str:
    if wide := wide_encoding(data):
        return data[: len(data) // 4 * 4 if "32" in wide else len(data) // 2 * 2].decode(wide, "replace")
    return data.decode("utf-8" if is_utf8(data) else "latin-1")


def has_header(data: bytes, at: int) -> bool:
    return data.startswith((GZIP, BZIP, XZ), at) or (len(data) > at + 2 and data[at] == 0x78 and (0x7800 + data[at + 1]) % 31 == 0)


def next_header(data: bytes, at: int) -> int:
    """Where the next header of a stream is from a place on, or the end."""
    return next((m.start() for m in HEADER.finditer(data, at) if has_header(data, m.start())), len(data))


def reader_at(data: bytes, at: int):
    if data.startswith(BZIP, at):
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if data.startswith(XZ, at) else zlib.decompressobj(47)


def inflated(data: bytes, most: int) -> bytes | None:
    """What bytes without a header stand for as a raw deflate stream, if they are one to the end and give text."""
    stream, held = zlib.decompressobj(-15), bytearray()
    try:
        for at in range(0, len(data), STEP):
            held += stream.decompress(data[at : at + STEP])
            if stream.eof or len(held) > most:
                break
            if at == 0 and held and not is_utf8(bytes(held[: max(1, len(held) - 4)])):
                return None
    except zlib.error:
        return None
    return bytes(held) if stream.eof and not stream.unused_data and len(held) > 8 and is_utf8(bytes(held)) else None


def unpacked(data: bytes, most: int, tally: Counter, rest: bool = True) -> Iterator[tuple[bytes, int]]:
    """Contents of the compressed streams in data, those that follow each other together, and the bytes around them; and where each ends.

    rest: whether bytes that are in no stream count. What is longer than `most` comes in overlapping pieces and is counted in tally.
    """
    at = 0
    while at < len(data):
        begin, held, large = at, bytearray(), False
        while has_header(data, at):
            stream, to = reader_at(data, at), at
            try:
                while to < len(data) and not stream.eof:
                    held += stream.decompress(data[to : to + STEP])
                    to = min(to + STEP, len(data))
                    if len(held) > most:
                        tally["large"] += not large
                        large = True
                        yield bytes(held), to
                        del held[: -min(OVERLAP, most // 2)]
                if hasattr(stream, "flush"):
                    held += stream.flush()
            except (zlib.error, OSError, EOFError, lzma.LZMAError):
                break
            at = to - len(stream.unused_data)
        if held:
            yield bytes(held), at
        if at == begin or at < len(data):  # what is no stream, up to the next one
            to = next_header(data, at + 1)
            if rest and data[at:to].strip(b"\0"):
                yield data[at:to], to
            at = to


def unquoted(run: str, escape: re.Pattern, plus: str = "+") -> tuple[bytes, list[int]]:
    """The bytes of a run of escapes and characters that stand for themselves, and where in the run each ends."""
    out, ends, at = bytearray(), [], 0
    for m in escape.finditer(run):
        out += run[at : m.start()].replace("+", plus).encode("latin-1")
        ends += range(at + 1, m.start() + 1)
        out.append(int(m[1], 16) if m[1] else ord(PLAIN.get(m[2], m[2])))
        ends.append(m.end())
        at = m.end()
    return bytes(out + run[at:].replace("+", plus).encode("latin-1")), [*ends, *range(at + 1, len(run) + 1)]


def line_blocks(lengths: list[int]) -> list[tuple[int, int]]:
    """Which of these lines to join: all of them, and each sequence of equally long ones with a shorter last one."""
    out, n = {(0, len(lengths))}, len(lengths)
    for i in range(n):
        if i and lengths[i] == lengths[i - 1]:
            continue
        j = i + 1
        while j < n and lengths[j] == lengths[i]:
            j += 1
        if j < n and lengths[j] < lengths[i]:
            j += 1
        if j > i + 1:
            out.add((i, j))
    return sorted(x for x in out if sum(lengths[slice(*x)]) >= LEAST_BASE64)


def from_base64(run: str) -> bytes | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        body = body[:-1]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


class Layer:
    """Text and where its characters come from in the root text: as they stand (the root), all from one span (within), or
    a start and an end for each of them."""

    __slots__ = ("text", "starts", "ends", "within", "odd")

    def __init__(self, text: str | bytes, starts: np.ndarray | None = None, ends: np.ndarray | None = None, within: tuple[int, int] | None = None):
        self.odd = isinstance(text, bytes) and not is_utf8(text)  # such bytes count as a layer if something is found in them
        self.text, self.starts, self.ends, self.within = as_text(text) if isinstance(text, bytes) else text, starts, ends, within

    def root(self) -> bool:
        return self.starts is None and self.within is None

    def span(self, a: int, b: int) -> tuple[int, int]:
        if self.within is not None:
            return self.within
        return (a, b) if self.starts is None else (int(self.starts[a]), int(self.ends[b - 1]))

    def unescaped(self, plus: str = "+") -> Layer | None:
        """With the escapes undone; plus: what a plus sign stands for."""
        pieces, starts, ends, at = [], [], [], 0

        def plain(a: int, b: int) -> None:
            pieces.append(self.text[a:b].replace("+", plus))
            if self.within is None:
                starts.append(np.arange(a, b) if self.starts is None else self.starts[a:b])
                ends.append(np.arange(a + 1, b + 1) if self.ends is None else self.ends[a:b])

        for m in ESCAPE.finditer(self.text):
            if (new := undone(m[0])) is None:
                continue
            plain(at, m.start())
            pieces.append(new)
            if self.within is None:
                a, b = self.span(m.start(), m.end())
                starts.append(np.full(len(new), a))
                ends.append(np.full(len(new), b))
            at = m.end()
        if not at:
            return None
        plain(at, len(self.text))
        if self.within is not None:
            return Layer("".join(pieces), within=self.within)
        return Layer("".join(pieces), np.concatenate(starts), np.concatenate(ends))

    def inner(self, most: int, tally: Counter) -> Iterator[Layer]:
        """The layers in this one; streams that come in pieces are counted in tally."""
        if (new := self.unescaped()) is not None and new.text:
            yield new
            if "+" in self.text and "%" in self.text and (spaced := self.unescaped(" ")) is not None:
                yield spaced
        for m in BASE64.finditer(self.text):
            for skip in range(min(4, len(m[0]) - LEAST_BASE64 + 4)):
                if data := from_base64(m[0][skip:]):
                    span = self.span(m.start() + skip, m.end())
                    for t, _ in unpacked(data, most, tally):
                        layer = Layer(t, within=span)
                        layer.odd |= skip > 0  # most runs start where they stand
                        yield layer
                    if not has_header(data, 0) and not is_utf8(data) and (plain := inflated(data, most)):
                        yield Layer(plain, within=span)
        for m in WRAPPED.finditer(self.text):
            if m.end() - m.start() >= LEAST_BASE64:
                lines = [(m.start() + x.start(), m.start() + x.end()) for x in RUN.finditer(m[0])]
                for i, j in line_blocks([b - a for a, b in lines]):
                    yield from self.joined(lines[i:j], most, tally)
        for sign, pattern, escape in (("%", PERCENT, PERCENT_BYTE), ("\\x", QUOTED, QUOTED_BYTE)):
            for m in pattern.finditer(self.text) if sign in self.text else ():
                for plus in "+ " if sign == "%" and "+" in m[0] else "+":  # a plus sign may stand for a space
                    data, ends = unquoted(m[0], escape, plus)
                    yield from (Layer(t, within=self.span(m.start(), m.start() + ends[to - 1])) for t, to in unpacked(data, most, tally, rest=False))

    def joined(self, lines: list[tuple[int, int]], most: int, tally: Counter) -> Iterator[Layer]:
        """The layers of base64 wrapped in lines. Without a stream in it, each character comes from the lines that hold its bits."""
        data = from_base64("".join(self.text[a:b] for a, b in lines))
        if not data:
            return
        if next_header(data, 0) < len(data) or wide_encoding(data):
            yield from (Layer(t, within=self.span(lines[0][0], lines[-1][1])) for t, _ in unpacked(data, most, tally))
            return
        text = as_text(data)
        first = np.frombuffer(data, np.uint8)
        first = np.flatnonzero((first & 0xC0) != 0x80) if len(text) < len(data) else np.arange(len(data))
        last = np.r_[first[1:], len(data)] - 1
        ends = np.cumsum([b - a for a, b in lines])
        spans = np.array([self.span(a, b) for a, b in lines])
        yield Layer(data, spans[np.searchsorted(ends, first * 8 // 6, "right"), 0], spans[np.searchsorted(ends, (last * 8 + 7) // 6, "right"), 1])


def find(text: str, most: int = LAYER_CHARS) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """Finds in the text itself, finds in all layers as spans of the text, number of layers, streams scanned in pieces."""
    base = sorted(scan(text))
    every, seen, layers, tally = set(base), set(), 0, Counter()
    work: list[Iterator[Layer]] = [iter((Layer(text),))]
    while work:  # layers are made as they are taken, so few are in memory at once
        if (layer := next(work[-1], None)) is None:
            work.pop()
            continue
        if not layer.text:
            continue
        mark = (hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), None if layer.root() else (*layer.span(0, 1), *layer.span(len(layer.text) - 1, len(layer.text))))
        if mark in seen:
            continue
        seen.add(mark)
        finds = base if layer.root() else [(*layer.span(a, b), k) for a, b, k in scan(layer.text)]
        every.update(finds)
        layers += bool(finds) or not layer.odd
        work.append(layer.inner(most, tally))
    return base, sorted(every), max(1, layers), tally["large"]


def written(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end, by start and then kind as listed."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))


def scan_documents(docs: DataFrame) -> DataFrame:
    """A row for each row of docs (doc_id, text): counts and spans, texts taken whole."""
    names = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "n_oversize")
    kinds = ("long", "long", "long", "long", "string", "string", "long", "long")
    schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in zip(names, kinds, strict=True)])

    def row(doc_id, text):
        base, every, layers, large = find(text or "")
        counts = [sum(k == kind for _, _, k in base) for kind in range(len(KINDS))]
        return (doc_id, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every), layers, large)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(per_row(row, schema), ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document, in its text and in what is encoded in it.

    n_assign, n_access and n_hex count the finds in the text as it stands; spans has those and the decoded ones. A null
    text counts as empty: no finds, the digest of an empty list. Repeated rows, and those without a doc_id, each give a
    row; finds that tie in their start are listed by kind and end. Very long texts are scanned whole, one at a time. An
    empty table gives none. Other columns are never read. A stream that unpacks to more than LAYER_CHARS is scanned in pieces and counted in n_oversize.
    """
    return scan_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
