r"""Secret scans: what is hidden under URL, Unicode, base64 and compressed layers too.

Each text is the first entry of a worklist. An entry is scanned for secrets, then unwrapped:

- every ``%xx`` run is decoded, which gives one entry for the whole text;
- every ``\uXXXX``, ``\u{X}``, ``\UXXXXXXXX``, ``\xXX`` or ``&#N;`` is decoded, likewise;
- every base64 run gives an entry for each of the four digits it can be read from, as a payload
  may stand behind other digits (a path, a name), and so do runs on successive lines as one, as
  encoders break lines;
- bytes that hold gzip, zlib, bzip2, xz or zstd data anywhere, or are raw deflate data, give an
  entry: what stands before, all streams, and what follows them. One that decompresses to more than
  ``MOST_BYTES`` is read as a stream and gives an entry for each of its overlapping blocks.

Bytes that are no readable UTF-8 are taken as Latin-1, as all patterns are ASCII. They give no
entry where nothing in them could be a secret or a layer: most are words that look like base64.

The new entries join the worklist until nothing unwraps any more. An entry that was seen at
the same place before (a cycle, as in data that decompress to themselves) is not taken up
again. Every character of an entry knows the stretch of the original text it came from, so
the spans found in it are spans of the original; all characters of a compressed layer come
from the whole run that held it.

Texts in which nothing could be a secret or a layer are told by a few byte searches.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import byte_set, mapped, other_columns, parts, table, with_row, words

KINDS = ("assign", "access", "hex")

#: A layer that decompresses to more than this is scanned in blocks of this size.
MOST_BYTES = 1 << 26

#: Bytes that successive blocks share.
OVERLAP = 1 << 16

#: Raw deflate data have no header; they are looked for in so many bytes at least.
_LEAST_RAW = 16

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}"
    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
)
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_LINES = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
#: What is in any bytes that hold a secret or a layer.
_HOLDS = re.compile(
    rb"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}|%[0-9A-Fa-f]{2}"
    rb"|\\[ux][0-9A-Fa-f]{2}|&#|[A-Za-z0-9+/_-]{16}")
_BASE64_BYTES = byte_set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_HEX_BYTES = byte_set(b"0123456789abcdef")

#: How packed data begin; of two bytes that could be a zlib header, only those whose check holds do.
_PACKED = re.compile(
    rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|[\x08\x18\x28\x38\x48\x58\x68\x78](?s:.)")

Span = tuple[int, int, str]


@dataclass
class Layer:
    """A text, and for each of its characters the stretch of the original it stands for."""

    text: str
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None or self.ends is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Of every character; made once."""
        if self.starts is None or self.ends is None:
            self.starts = np.arange(len(self.text))
            self.ends = self.starts + 1
        return self.starts, self.ends


def scan(text: str) -> Iterator[Span]:
    """Secrets in one layer, as start, end (code points, end exclusive) and kind."""
    low = text.lower()
    if any(name in low for name in _NAMES):
        for found in _ASSIGN.finditer(text):
            if len(found[2]) >= 6:
                yield found.start(), found.end(), "assign"
    if "AKIA" in text:
        for found in _ACCESS.finditer(text):
            if len(found[0]) >= 20:
                yield found.start(), found.end(), "access"
    for found in _HEX.finditer(text):
        yield found.start(), found.end(), "hex"


_BROKEN = (OSError, EOFError, ValueError, zlib.error, lzma.LZMAError, zstandard.ZstdError)


class TooLarge(Exception):
    """Packed data that hold more than the limit, from byte ``at`` on."""

    def __init__(self, at: int):
        super().__init__(at)
        self.at = at


def _opened(data: bytes, raw: bool = False):
    """A decompressor for what the bytes begin with: zstd's, or one with a limited output."""
    if data.startswith(b"BZh"):
        return bz2.BZ2Decompressor()
    if data.startswith(b"\xfd7zXZ"):
        return lzma.LZMADecompressor()
    return zlib.decompressobj(-15 if raw else 47)


def _stream(data: bytes, most: int, raw: bool = False) -> tuple[bytes, bytes]:
    """What the first stream of compressed bytes holds, up to a limit, and what follows it."""
    if not raw and data.startswith(b"\x28\xb5\x2f\xfd"):
        opened = zstandard.ZstdDecompressor().decompressobj()
        with zstandard.ZstdDecompressor().stream_reader(data) as reader:
            out = reader.read(most + 1)
        if len(out) <= most:
            opened.decompress(data)
        return out, opened.unused_data
    opened = _opened(data, raw)
    out = opened.decompress(data, most + 1)
    if raw and not opened.eof:
        raise ValueError
    return out, opened.unused_data


def _begins(data: bytes) -> Iterator[int]:
    """Where packed data could begin."""
    at = 0
    while found := _PACKED.search(data, at):
        start, at = found.start(), found.start() + 1
        if len(found[0]) > 2 or (data[start] << 8 | data[start + 1]) % 31 == 0:
            yield start


def _unpacked(data: bytes, most: int) -> bytes | None:
    """The bytes with all packed streams in them opened; None where there are none.

    Something that only begins like one, and yields nothing, stays as it is.
    """
    held, size, done = [], 0, 0
    for start in _begins(data):
        if start < done:
            continue
        try:
            out, rest = _stream(data[start:], most - size)
        except _BROKEN:
            continue
        if not out:
            continue
        size += len(out)
        if size > most:
            raise TooLarge(start)
        held += [data[done:start].lstrip(b"\0") if held else data[:start], out]
        done = len(data) - len(rest)
    if held:
        return b"".join([*held, data[done:].lstrip(b"\0")])
    if len(data) >= _LEAST_RAW:
        try:
            out, rest = _stream(data, most, raw=True)
        except _BROKEN:
            return None
        if len(out) > most:
            raise TooLarge(0)
        if len(out) >= len(data) - len(rest) and not rest:
            return out
    return None


def _blocks(data: bytes, most: int) -> Iterator[bytes]:
    """What the first stream of the bytes holds, in blocks that share some bytes."""
    step, tail = max(most, 2 * OVERLAP), b""
    if data.startswith(b"\x28\xb5\x2f\xfd"):
        with zstandard.ZstdDecompressor().stream_reader(data) as reader:
            while block := reader.read(step):
                yield tail + block
                tail = block[-OVERLAP:]
        return
    try:
        opened = _opened(data)
        block = opened.decompress(data, step)
    except _BROKEN:
        opened = _opened(data, raw=True)
        block = opened.decompress(data, step)
    while block:
        yield tail + block
        tail = block[-OVERLAP:]
        left = getattr(opened, "unconsumed_tail", b"")
        block = b"" if opened.eof else opened.decompress(left, step)


def _readable(data: bytes) -> str | None:
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    odd = sum(not (c.isprintable() or c in "\t\n\r") for c in text)
    return text if text and odd * 10 <= len(text) else None


def _characters(text: str, starts: np.ndarray, ends: np.ndarray) -> Layer:
    """A layer of decoded text whose bytes have the given places."""
    widths = np.array([len(c.encode()) for c in text], np.int64)
    last = np.cumsum(widths)
    first = last - widths
    return Layer(text, starts[first], ends[last - 1])


def _whole(text: str, start: int, end: int) -> Layer:
    return Layer(text, np.full(len(text), start), np.full(len(text), end))


def _of_bytes(data: bytes, starts: np.ndarray, ends: np.ndarray, most: int) -> Iterator[Layer | None]:
    """What decoded bytes hold: a text, or a compressed layer with a text in it.

    None tells that a layer was too large to be opened at once, and follows its blocks.
    """
    held, seen = data, set()
    try:
        while (digest := hashlib.sha256(held).digest()) not in seen:
            seen.add(digest)
            opened = _unpacked(held, most)
            if opened is None:
                break
            held = opened
    except TooLarge as large:
        try:
            for block in _blocks(held[large.at:], most):
                text = _readable(block) or (
                    block.decode("latin-1") if _HOLDS.search(block) else None)
                if text:
                    yield _whole(text, int(starts.min()), int(ends.max()))
        except _BROKEN:
            pass  # what could be read of it was
        yield None
        held = held[: large.at]
        if not held:
            return
    text = _readable(held)
    plain = text is None  # a character for each byte
    if plain:
        if not _HOLDS.search(held):
            return
        text = held.decode("latin-1")
    if held is data:
        yield Layer(text, starts, ends) if plain else _characters(text, starts, ends)
    else:
        yield _whole(text, int(starts.min()), int(ends.max()))


def _character(escape: str) -> str | None:
    if escape.startswith("\\"):
        code = int(escape[2:].strip("{}"), 16)
    elif escape[2] in "xX":
        code = int(escape[3:-1], 16)
    else:
        code = int(escape[2:-1])
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def _replaced(layer: Layer, stretches: list[tuple[int, int, str]]) -> Layer:
    """The layer with some stretches replaced; what is new stands for the whole stretch."""
    starts, ends = layer.places()
    text, first, last, at = [], [], [], 0
    for start, end, new in stretches:
        text += [layer.text[at:start], new]
        begin, stop = layer.origin(start, end)
        first += [starts[at:start], np.full(len(new), begin)]
        last += [ends[at:start], np.full(len(new), stop)]
        at = end
    text.append(layer.text[at:])
    return Layer("".join(text), np.concatenate([*first, starts[at:]]),
                 np.concatenate([*last, ends[at:]]))


def unwrapped(layer: Layer, most: int = MOST_BYTES) -> Iterator[Layer | None]:
    """The layers right under this one; None for each that was too large to open at once."""
    text = layer.text
    if "%" in text:
        stretches = []
        starts, ends = layer.places()
        for found in _URL.finditer(text):
            data = bytes.fromhex(found[0].replace("%", ""))
            at = np.arange(found.start(), found.end(), 3)
            try:
                packed = _unpacked(data, most) is not None
            except TooLarge:
                packed = True
            if packed:
                yield from _of_bytes(data, starts[at], ends[at + 2], most)
            new = data.decode("utf-8", "replace")
            if len(new) == len(data):  # one character each: exact places
                stretches += [
                    (a, a + 3, c) for a, c in zip(at.tolist(), new, strict=True)
                ]
            else:
                stretches.append((found.start(), found.end(), new))
        if stretches:
            yield _replaced(layer, stretches)
    if "\\" in text or "&#" in text:
        stretches = [
            (m.start(), m.end(), c)
            for m in _ESCAPE.finditer(text) if (c := _character(m[0])) is not None
        ]
        if stretches:
            yield _replaced(layer, stretches)
    for found in _BASE64.finditer(text):
        run = found[0].rstrip("=")
        for first in range(4):
            digits = run[first:]
            if len(digits) % 4 == 1:
                digits = digits[:-1]
            if len(digits) >= 12:
                at = np.arange(found.start() + first, found.end())
                yield from _of_base64(layer, digits, at, most)
    for found in _LINES.finditer(text):
        lines = [m.span() for m in _RUN.finditer(text, found.start(), found.end())]
        for first, last in _wrapped([stop - start for start, stop in lines]):
            run = "".join(text[start:stop] for start, stop in lines[first:last])
            at = np.concatenate([np.arange(start, stop) for start, stop in lines[first:last]])
            if len(run) % 4 == 1:
                run = run[:-1]
            yield from _of_base64(layer, run, at, most)


def _wrapped(widths: list[int]) -> Iterator[tuple[int, int]]:
    """Which lines, the last exclusive, could be one payload: some of one width, the one
    behind them, and the one before them, as a payload may begin within its line."""
    cuts = [i for i in range(len(widths)) if not i or widths[i] != widths[i - 1]]
    cuts += [len(widths), len(widths)]
    for first, second, third in zip(cuts, cuts[1:], cuts[2:]):
        last = min((second if second - first > 1 else third) + 1, len(widths))
        if last - first > 1:
            yield first, last


def _of_base64(layer: Layer, run: str, at: np.ndarray, most: int) -> Iterator[Layer | None]:
    """What base64 digits hold that stand at places ``at`` of a layer.

    Most words that look like base64 are noise when read so, and end here.
    """
    plain = run.replace("-", "+").replace("_", "/")
    data = base64.b64decode(plain + "=" * (-len(plain) % 4))
    if not _HOLDS.search(data) and _readable(data) is None:
        try:
            if _unpacked(data, most) is None:
                return
        except TooLarge:
            pass
    byte = np.arange(len(data))
    starts, ends = layer.places()
    yield from _of_bytes(
        data, starts[at[byte * 8 // 6]], ends[at[(byte * 8 + 7) // 6]], most)


def find_secrets(text: str, most: int = MOST_BYTES) -> tuple[list[Span], list[Span], int, int]:
    """Spans of the text itself, spans of all its layers, layers opened, layers read in blocks."""
    base = sorted(scan(text), key=_order)
    found, work, seen, closed = set(base), [Layer(text)], set(), 0
    while work:
        for layer in unwrapped(work.pop(), most):
            if layer is None:
                closed += 1
                continue
            mark = (hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest(),
                    layer.origin(0, len(layer.text)))
            if mark in seen:
                continue
            seen.add(mark)
            found.update((*layer.origin(s, e), kind) for s, e, kind in scan(layer.text))
            work.append(layer)
    return base, sorted(found, key=_order), len(seen), closed


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with a long run of hexadecimal or base64 digits, or with an escape."""
    marked = np.zeros(len(offsets) - 1, bool)
    for digits, least in ((_HEX_BYTES, 24), (_BASE64_BYTES, 16)):
        starts, ends, owner = words(data, offsets, ~digits)
        marked[owner[ends - starts >= least]] = True
    return marked


def secret_rows(batches, most):
    for batch, data, offsets in parts(batches):
        marked = _suspects(data, offsets)
        out = []
        for text, suspect in zip(batch["text"].to_pylist(), marked.tolist(), strict=True):
            text = text or ""
            if not suspect and not any(c in text for c in ("%", "\\", "&#", "AKIA")):
                low = text.lower()
                if not any(name in low for name in _NAMES):
                    out.append(([], [], 0, 0))
                    continue
            out.append(find_secrets(text, most))
        spans = pa.array(
            [[{"kind": k, "start": s, "stop": e} for s, e, k in o[1]] for o in out],
            pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                ("stop", pa.int64())])),
        )
        base = pa.array(
            [[{"kind": k, "start": s, "stop": e} for s, e, k in o[0]] for o in out], spans.type
        )
        yield pa.RecordBatch.from_arrays(
            [batch["row"], base, spans, pa.array([o[2] for o in out], pa.int64()),
             pa.array([o[3] for o in out], pa.int64())],
            names=["row", "base", "spans", "n_layers", "n_closed"],
        )


def scan_secrets(docs: DataFrame, most: int = MOST_BYTES) -> DataFrame:
    """One row per document: ``row`` (its columns but the text), its spans, its layers.

    ``base`` has the spans of the text itself, ``spans`` those and all that its layers add,
    each with kind, start and stop in code points of the text, in order. ``n_layers`` counts
    the layers opened and ``n_closed`` those that decompress to more than ``most`` bytes,
    which are read in overlapping blocks. A null text is empty; repeated rows give repeated rows;
    an empty table gives none. A text is scanned whole, however long.
    """
    rows = docs.select(
        other_columns(docs, "text"),
        F.col("text").cast("string").alias("text"),
    )
    span = "array<struct<kind:string,start:long,stop:long>>"
    return mapped(
        rows, secret_rows,
        with_row(rows, f"base {span}, spans {span}, n_layers long, n_closed long"), most=most,
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def counted(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return scan_secrets(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        *[counted(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        "n_layers", "n_closed",
    )
