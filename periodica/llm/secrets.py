"""Secret scan with a recursive decoding worklist.

A text is scanned as it is (the base spans) and then unwrapped: percent escapes, Unicode escapes and
character references of a layer give one decoded layer, every base64 token gives a layer of its own
(lines that may belong together give one as a block, one without the last line and one for each line;
one that isn't plain text is read at all four alignments, in its parts between `/`, `-` and `_`, and
from where a compressed stream may begin),
and bytes that begin as gzip, zlib, bzip2, xz or zstandard data are expanded first. New layers join
the worklist until none is left. A layer whose text was seen before from the same place, code point by
code point, is not followed again: that joins layers reached by several ways and ends data which
unwraps to itself, as such data is expanded and all of it comes from the place of its stream. Equal
layers at other places are each followed.

Decoded bytes are read without loss: UTF-8 as code points, every other byte as a separator, and runs of
ASCII in UTF-16 (either byte order) as one more layer. Of bytes that aren't plain text, the fragments
between control characters and separators are layers, if they hold a finding or anything coded.

Every layer carries, per code point, the start and end in the original text it came from; a finding
in a layer is reported at the original code points that made it, under its kind. All code points of
an expanded stream map to the whole stream.

Defined results: null and empty texts have no spans. Nothing is skipped for length. A stream that
expands beyond `max_layer_bytes` (64 MiB) is counted in `oversize` and followed in windows of that
size, each half over the one before, so that memory stays bounded; only an escape or token of more
than half a window may be cut. There is no bound on what is expanded: a decompression bomb costs the
time to read it. Streams that follow each other are one content, whatever their formats; bytes behind
them are read as they are. A broken or truncated stream is followed as far as it is sound, and read as
plain bytes too. Ids, ties and repeated rows play no part: each row has its own result, and other columns
are not read.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import table, texts

# The kinds in their order, with the least length of what counts.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20

MAX_LAYER_BYTES = 64 << 20
REWRITING = ("url", "unicode", "utf16")
#: how much a decompressor is given and gives at a time
CHUNK = 1 << 16
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+"
    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
)
# shorter tokens can't hold a finding; long lines may go on after a line break
BASE64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:(?:[A-Za-z0-9+/_-]{60,}\r?\n)+[A-Za-z0-9+/_-]+|[A-Za-z0-9+/_-]{16,})={0,2}"
)
LEAST_TOKEN = 16
LOOK = 4096
NO_BREAKS = str.maketrans("-_", "+/", "\r\n")
# parts of a run that other characters of either alphabet join; base64 of what streams begin with
BETWEEN = [re.compile(x) for x in (r"[A-Za-z0-9+/\r\n]+={0,2}", r"[A-Za-z0-9_\r\n-]+={0,2}", r"[A-Za-z0-9+\r\n]+={0,2}")]
PACKED = re.compile(r"H4sI|KLUv[/_]|Qlpo|[/_]Td6WFoA|e(?=A[E-H]|F[4-7]|J[w-z]|N[o-r])")
# ASCII in UTF-16 of either byte order, long enough for a finding
WIDE = re.compile(r"\x00?(?:[\t\n\r\x20-\x7e]\x00){6,}[\t\n\r\x20-\x7e]?")
CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f�\ud800-\udfff]")
# the least finding has twelve characters; zeros are left in for UTF-16
FRAGMENT = re.compile(r"[^\x01-\x08\x0e-\x1f\x7f\ud800-\udfff]{12,}")
CODED = re.compile("|".join(x.pattern for x in (PERCENT, UNICODE, BASE64, WIDE)))

SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "findings array<struct<kind:string,start:int,end:int,layers:string>>, n_layers int, oversize int"
)


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the findings of one layer."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_VALUE:
                found.append(("assign", m.start(), m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                found.append(("access", m.start(), m.end()))
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


@dataclass
class Layer:
    text: str
    #: of each code point, where its source begins and ends in the original; None: the text itself
    start: np.ndarray | None = None
    end: np.ndarray | None = None
    path: str = ""
    #: where the text begins in the decoded bytes
    at: int = 0

    def origin(self, a: int, b: int) -> tuple[int, int]:
        if self.start is None:
            return a, b
        return int(self.start[a]), int(self.end[b - 1])

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        if self.start is None:
            at = np.arange(len(self.text))
            return at, at + 1
        return self.start, self.end

    def key(self) -> bytes:
        """The same for equal texts from the same place."""
        one = hashlib.sha256(self.text.encode("utf-8", "surrogatepass"))
        for x in self.spans():
            one.update(np.ascontiguousarray(x, np.int64))
        return one.digest()

    def below(self, step: str) -> str:
        return f"{self.path}>{step}" if self.path else step


@dataclass
class Tally:
    #: streams followed, with their places: layers of several ways lead to the same one
    streams: set = field(default_factory=set)
    oversize: int = 0


class Feed:
    """Bytes that come in pieces."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held, self.broken, self.unended = pieces, b"", False, False
        #: how many bytes were taken, and behind how many of them no sound stream is left
        self.at = self.tail = 0

    def take(self, n: int) -> bytes:
        parts, size = [self.held], len(self.held)
        while size < n and (more := next(self.pieces, None)) is not None:
            parts.append(more)
            size += len(more)
        data = b"".join(parts)
        self.held = data[n:]
        self.at += min(n, size)
        return data[:n]

    def back(self, data: bytes) -> None:
        self.held = data + self.held
        self.at -= len(data)

    def peek(self, n: int) -> bytes:
        data = self.take(n)
        self.back(data)
        return data

    def rest(self, skip: int = 0) -> Iterator[bytes]:
        while skip and (data := self.take(min(skip, CHUNK))):
            skip -= len(data)
        yield from iter(lambda: self.take(CHUNK), b"")


def cut(data: bytes) -> Iterator[bytes]:
    return (data[i : i + CHUNK] for i in range(0, len(data), CHUNK))


def windows(pieces: Iterator[bytes], most: int) -> Iterator[bytes]:
    """Windows of `most` bytes; each begins with the second half of the one before."""
    feed, half = Feed(pieces), most // 2
    window = feed.take(most)
    yield window
    while more := feed.take(most - half):
        window = window[len(window) - half :] + more
        yield window


def skippable(data: bytes) -> int:
    """The length of the zstandard frame without content that data begins with."""
    if len(data) < 8 or data[0] >> 4 != 5 or data[1:4] != b"\x2a\x4d\x18":
        return 0
    return 8 + int.from_bytes(data[4:8], "little")


def form_of(data: bytes) -> str | None:
    """The format that compressed data begins as."""
    if data[:2] == b"\x1f\x8b":
        return "gzip"
    if data[:4] == b"\x28\xb5\x2f\xfd" or skippable(data):
        return "zstd"
    if data[:3] == b"BZh":
        return "bzip2"
    if data[:6] == b"\xfd7zXZ\x00":
        return "xz"
    if len(data) > 2 and data[0] == 0x78 and (data[0] * 256 + data[1]) % 31 == 0:
        return "zlib"
    return None


DECOMPRESSORS = {
    "gzip": lambda: zlib.decompressobj(31),
    "zstd": lambda: zstandard.ZstdDecompressor().decompressobj(),
    "bzip2": bz2.BZ2Decompressor,
    "xz": lzma.LZMADecompressor,
    "zlib": zlib.decompressobj,
}
UNSOUND = (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError)


def portions(name: str, one, data: bytes) -> Iterator[bytes]:
    """What a decompressor makes of `data`, some CHUNK bytes at a time."""
    if name == "zstd":
        yield one.decompress(data)
    elif name in ("gzip", "zlib"):
        while data and not one.eof:
            yield one.decompress(data, CHUNK)
            data = one.unconsumed_tail
        while not one.eof and (more := one.decompress(b"", CHUNK)):
            yield more
    else:
        yield one.decompress(data, CHUNK)
        while not one.eof and not one.needs_input:
            yield one.decompress(b"", CHUNK)


def expanded(feed: Feed) -> Iterator[bytes]:
    """The content of the streams that follow each other from where `feed` begins, as far as it is sound."""
    while name := form_of(head := feed.peek(8)):
        feed.tail = feed.at
        if skip := skippable(head):
            while skip and (data := feed.take(min(skip, CHUNK))):
                skip -= len(data)
            continue
        one = DECOMPRESSORS[name]()
        # zstandard gives all at once: 32 MiB at most for this much
        step = CHUNK // 64 if name == "zstd" else CHUNK
        try:
            while not one.eof and (data := feed.take(step)):
                yield from (x for x in portions(name, one, data) if x)
        except UNSOUND:
            feed.broken = True
            return
        if not one.eof:
            feed.unended = True
            return
        feed.back(one.unused_data)
    feed.tail = feed.at


def is_stream(data: bytes) -> bool:
    return form_of(data) is not None and any(expanded(Feed(cut(data))))


def lossless(data: bytes) -> str:
    """UTF-8 as code points; each other byte as a lone surrogate, which no pattern takes."""
    return data.decode("utf-8", "surrogateescape")


def plain(text: str) -> bool:
    return not CONTROL.search(text)


def fragments(text: str) -> list[tuple[int, int]]:
    """What lies between separators and has something to find in it or below it."""
    found = (m.span() for m in FRAGMENT.finditer(text))
    return [(a, b) for a, b in found if CODED.search(text, a, b) or scan(text[a:b])]


def worth(text: str) -> bool:
    return bool(text) and (plain(text) or bool(fragments(text)))


def decoded(data: bytes, start: np.ndarray, end: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """Decoded bytes as text, with the source of each code point."""
    text = lossless(data)
    if len(text) < len(data):
        # first and last byte of each code point
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        size[(code >= 0xDC80) & (code <= 0xDCFF)] = 1
        last = np.cumsum(size) - 1
        start, end = start[last - size + 1], end[last]
    return text, start, end


def text_layers(data: bytes, start: np.ndarray, end: np.ndarray, path: str) -> Iterator[Layer]:
    """Decoded bytes as one layer; where they aren't plain text, their fragments."""
    text = lossless(data)
    parts = [(0, len(text))] if plain(text) else fragments(text)
    if text and parts:
        text, start, end = decoded(data, start, end)
        for a, b in parts:
            yield Layer(text[a:b], start[a:b], end[a:b], path, a)


def bytes_layers(
    data: bytes, start: np.ndarray, end: np.ndarray, path: str, most: int, tally: Tally
) -> Iterator[Layer]:
    """The layers of decoded bytes with their sources; expands compressed streams on the way."""
    if not is_stream(data):
        yield from text_layers(data, start, end, path)
        return
    source, known = None, set()
    pieces: Callable[[], Iterator[bytes]] = partial(cut, data)
    while True:
        # a stream of any size is read anew for each use, so that only windows of it are held
        feed = Feed(pieces())
        name, content = form_of(feed.peek(8)), Feed(expanded(feed))
        head = content.take(most + 1)
        while content.take(CHUNK):
            pass
        # what follows the streams, or a stream that is broken or doesn't end, is read as it is
        if source is None:
            source = start[0], end[-1 if feed.broken or feed.unended else feed.tail - 1]
            if (key := (*source, hashlib.sha256(data).digest())) in tally.streams:
                return
            tally.streams.add(key)
            yield from text_layers(data[feed.tail :], start[feed.tail :], end[feed.tail :], path)
        else:
            for window in windows(Feed(pieces()).rest(feed.tail), most):
                yield from text_layers(window, *(np.full(len(window), x) for x in source), path)
        path = f"{path}>{name}"
        pieces = partial(lambda outer: expanded(Feed(outer())), pieces)
        if len(head) <= most:
            if (key := hashlib.sha256(head).digest()) in known:
                return
            known.add(key)
            pieces = partial(cut, head)
        else:
            tally.oversize += 1
        if not any(expanded(Feed(pieces()))):
            break
    for window in windows(pieces(), most):
        places = (np.full(len(window), x) for x in source)
        yield from text_layers(window, *places, path)


def percent_piece(token: str) -> bytes:
    return bytes.fromhex(token.replace("%", ""))


def unicode_piece(token: str) -> tuple[str, int] | bytes | None:
    """The text of an escape and how many source characters make one code unit; bytes for \\x."""
    try:
        if token.startswith("\\x"):
            return bytes.fromhex(token.replace("\\x", ""))
        if token.startswith("\\u{"):
            return chr(int(token[3:-1], 16)), len(token)
        if token.startswith("\\u"):
            units = bytes.fromhex(token.replace("\\u", "")).decode("utf-16-be", "surrogatepass")
            # lone surrogates separate, as they do in `lossless`
            return None if all("\ud800" <= c <= "\udfff" for c in units) else (units, 6)
        if token.startswith("\\U"):
            return chr(int(token[2:], 16)), len(token)
        number = int(token[3:-1], 16) if token[2] in "xX" else int(token[2:-1])
        return chr(number), len(token)
    except (ValueError, OverflowError):
        return None


def wide_piece(token: str, at: int | None) -> tuple[str, np.ndarray, np.ndarray]:
    """The characters of a UTF-16 run of either byte order, and where each begins and ends.

    A run between two zeros or two characters is of either order: its place `at` in the decoded bytes
    tells; where that isn't known, both neighbours count to a character."""
    skip = int(token[0] == "\x00")
    first = np.arange(skip, len(token), 2)
    sure = skip != (token[-1] == "\x00")
    big = skip if sure else None if at is None else (at + skip) % 2
    before, after = first - (big != 0), first + 1 + (big != 1)
    return token[skip::2], np.maximum(before, 0), np.minimum(after, len(token))


def rewritten(layer: Layer, pattern: re.Pattern, step: str) -> tuple[Layer | None, list]:
    """The layer with all escapes of `pattern` decoded, and the streams inside them: (data, start, end)."""
    if pattern is PERCENT and "%" not in layer.text:
        return None, []
    if pattern is UNICODE and "\\" not in layer.text and "&#" not in layer.text:
        return None, []
    if pattern is WIDE and "\x00" not in layer.text:
        return None, []
    start, end = layer.spans()
    parts, starts, ends, streams, at, changed = [], [], [], [], 0, False
    for m in pattern.finditer(layer.text):
        if pattern is WIDE:
            piece = wide_piece(m[0], None if layer.path.endswith(REWRITING) else layer.at + m.start())
        else:
            piece = percent_piece(m[0]) if pattern is PERCENT else unicode_piece(m[0])
        if piece is None:
            continue
        if isinstance(piece, bytes):
            width = (m.end() - m.start()) // len(piece)
            first = m.start() + width * np.arange(len(piece))
            if is_stream(piece):
                streams.append((piece, start[first], end[first + width - 1]))
                continue
            text, s, e = decoded(piece, start[first], end[first + width - 1])
        elif pattern is WIDE:
            text, s, e = piece[0], start[m.start() + piece[1]], end[m.start() + piece[2] - 1]
        else:
            text, width = piece
            units = np.array([1 + (ord(c) > 0xFFFF and width == 6) for c in text])
            first = m.start() + width * (np.cumsum(units) - units)
            last = np.minimum(first + width * units, m.end()) - 1
            s, e = start[first], end[last]
        parts += [layer.text[at : m.start()], text]
        starts += [start[at : m.start()], s]
        ends += [end[at : m.start()], e]
        at, changed = m.end(), True
    if not changed:
        return None, streams
    parts.append(layer.text[at:])
    starts.append(start[at:])
    ends.append(end[at:])
    whole = Layer("".join(parts), np.concatenate(starts), np.concatenate(ends), layer.below(step))
    return whole, streams


def block_parts(block: str) -> list[tuple[int, int]]:
    """Where the readings of a base64 match lie: all of it, all but its last line, each line."""
    parts = [(0, len(block))]
    if "\n" in block:
        lines = [(m.start(), m.end()) for m in re.finditer(r"[^\r\n]+", block)]
        parts += [(0, lines[-2][1]), *lines]
    return list(dict.fromkeys(parts))


def inner_parts(block: str, a: int, b: int) -> list[tuple[int, int]]:
    """Readings of a token that isn't plain as it stands: the other alignments, the parts between
    separators, and from where a stream may begin."""
    parts = [(a + i, b) for i in (1, 2, 3)]
    for pattern in BETWEEN:
        parts += [m.span() for m in pattern.finditer(block, a, b)]
    parts += [(m.start(), b) for m in PACKED.finditer(block, a, b) if may_unpack(block[m.start() : min(b, m.start() + LOOK)])]
    return [(i, k) for i, k in parts if k - i >= LEAST_TOKEN]


def may_unpack(code: str) -> bool:
    """Whether the short mark of zlib, which occurs by chance, is followed by sound data; other streams
    begin with longer marks."""
    if not code.startswith("e"):
        return True
    feed = Feed(cut(code_bytes(code)))
    return sum(map(len, expanded(feed))) > 0 and not feed.broken


def code_bytes(token: str) -> bytes:
    code = token.translate(NO_BREAKS).rstrip("=")
    code = code[: len(code) - (len(code) % 4 == 1)]
    return base64.b64decode(code + "=" * (-len(code) % 4))


def base64_layers(layer: Layer, most: int, tally: Tally) -> Iterator[Layer]:
    start, end = layer.spans()
    for m in BASE64.finditer(layer.text):
        block = m[0]
        todo = block_parts(block)
        outer, seen, i = len(todo), set(), 0
        while i < len(todo):
            (a, b), i = todo[i], i + 1
            if (a, b) in seen:
                continue
            seen.add((a, b))
            data = code_bytes(block[a:b])
            if i <= outer and not plain(lossless(data)) and not is_stream(data):
                todo += inner_parts(block, a, b)
            if form_of(data) is None and not worth(lossless(data)):
                continue
            # where the characters stand, line breaks left out
            signs = np.frombuffer(block[a:b].encode(), np.uint8)
            at = m.start() + a + np.flatnonzero((signs != 13) & (signs != 10) & (signs != 61))
            k = np.arange(len(data))
            first, last = at[k * 8 // 6], at[np.minimum((k * 8 + 7) // 6, len(at) - (len(at) % 4 == 1) - 1)]
            yield from bytes_layers(data, start[first], end[last], layer.below("base64"), most, tally)


def layers_below(layer: Layer, most: int, tally: Tally) -> Iterator[Layer]:
    for pattern, step in ((PERCENT, "url"), (UNICODE, "unicode"), (WIDE, "utf16")):
        whole, streams = rewritten(layer, pattern, step)
        for data, start, end in streams:
            yield from bytes_layers(data, start, end, layer.below(step), most, tally)
        if whole is not None:
            yield whole
    yield from base64_layers(layer, most, tally)


def unwrapped(text: str, most: int = MAX_LAYER_BYTES) -> tuple[list, int, int]:
    """All (kind, start, end, path) below the base layer; number of layers; streams read in windows."""
    found: dict[tuple, None] = {}
    base, tally, layers = Layer(text), Tally(), 0
    # hashed only where there is a layer below
    seen: set[bytes] = set()
    # depth first, so that only one layer of each depth is held
    work = [layers_below(base, most, tally)]
    while work:
        one = next(work[-1], None)
        if one is None:
            work.pop()
            continue
        found |= dict.fromkeys((k, *one.origin(a, b), one.path) for k, a, b in scan(one.text))
        seen = seen or {base.key()}
        # one that came from the same place by another way is not followed again
        if (key := one.key()) not in seen:
            seen.add(key)
            layers += 1
            work.append(layers_below(one, most, tally))
    return list(found), layers, tally.oversize


def in_order(spans: set) -> list:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def joined(spans: list) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def secrets_of(text: str, most: int = MAX_LAYER_BYTES) -> tuple:
    """One row of SCHEMA without its id."""
    base = scan(text)
    deeper, layers, oversize = unwrapped(text, most)
    spans = in_order(set(base) | {x[:3] for x in deeper})
    path: dict = {}
    for kind, a, b, way in deeper:
        path.setdefault((kind, a, b), way)
    path |= dict.fromkeys(base, "")
    counts = [sum(x[0] == kind for x in base) for kind in KINDS]
    sha = hashlib.sha256(joined(in_order(set(base))).encode()).hexdigest()
    findings = [{"kind": k, "start": a, "end": b, "layers": path[k, a, b]} for k, a, b in spans]
    return *counts, sha, joined(spans), findings, layers, oversize


def secret_spans(docs: DataFrame, max_layer_bytes: int = MAX_LAYER_BYTES) -> DataFrame:
    """Per row of `docs` (doc_id, text) the columns of SCHEMA; one map over the texts, no shuffle."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "findings", "n_layers", "oversize"]
        for batch in batches:
            out = pd.DataFrame(
                [secrets_of(t, max_layer_bytes) for t in batch["text"]], columns=names
            )
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
            yield out

    return texts(docs).mapInPandas(rows, SCHEMA)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))
    ways = F.concat_ws(",", F.transform("findings", lambda x: x["layers"])).alias("layer_paths")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "oversize", ways
    )


QUERIES = {"op1_secrets": op1_secrets}
ORACLE: dict[str, str] = {}
