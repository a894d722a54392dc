"""Secret scans with a recursive decoding worklist.

The whole text is searched for three kinds of secret (the base), and then for encoded layers: URL escapes, Unicode and
byte escapes, base64 runs, and compressed data inside base64. Each decoded layer is searched and unwrapped again until
nothing new comes up; a layer that was seen before, in the same place, ends its branch, so cycles stop. Escapes of the sign
that begins an escape ('%252541' and so on), and of its digits ('%4%31'), are undone to their end in one layer, so a text's layers are
few however deep they nest. Compressed data is tried from each place that looks like its beginning, and base64, where a whole run is
neither text nor compressed, from behind each sign that may also part a path.
A layer's characters carry the span of the original text they come from, so what is found in it is reported as a span of
the original, in code points.

Defined cases: null and empty texts hold nothing; rows that repeat get the same answer each; a null id is passed on; an
empty table gives an empty result. Other columns are passed on by scan_secrets(). Texts are read whole; a layer that
unpacks to more than EXPANDED bytes is read to its end in pieces of about that size, each counted as a layer.
"""

import base64
import bz2
import hashlib
import itertools
import lzma
import re
import urllib.parse
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_names, table

KINDS = ("assign", "access", "hex")
EXPANDED = 8 << 20
LEAST_BASE64 = 16

_ASSIGN = re.compile(r"(?ai:(?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX_RUN = re.compile(r"[0-9a-f]{32,}")
_WORDS = ("passw", "secret", "token", "apikey", "api_key")
#: What stands behind a backslash and makes a backslash, or a percent sign, of the two; and anything that may stand there.
_TO_SLASH, _TO_PERCENT = (rf"(?:x{c}|u00{c}|U000000{c}|u\{{0{{0,4}}{c}\}})" for c in ("5[cC]", "25"))
_CODE = r"(?:u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))"
#: A sign, the codes that make it a sign again and again, and a last code.
_URL = re.compile(rf"(?:%|\\{_TO_SLASH}*{_TO_PERCENT})(?:25|5[cC]{_TO_SLASH}*{_TO_PERCENT})*([0-9A-Fa-f]{{2}})")
_ESCAPE = re.compile(rf"(?:\\|%(?:25)*5[cC])(?:{_TO_SLASH}|{_TO_PERCENT}(?:25)*5[cC])*{_CODE}")
#: Runs of either alphabet, on one line and going on over whole lines.
_BASE64 = [re.compile(p.replace("A", a)) for a in ("[A-Za-z0-9+/]", "[A-Za-z0-9_-]") for p in (r"A{%d,}={0,2}" % LEAST_BASE64, r"(?<!A)A{%d,}+(?:[\x20\t]*+\r?\n[\x20\t]*+A++)++={0,2}" % LEAST_BASE64)]
#: How compressed bytes start, written with URL or byte escapes and plain characters, and what may follow.
_URL_MAGIC = re.compile(r"(?i:%1f%8b|(?:x|%78)(?:%01|%5e|\^|%9c|%da)|BZh|%42%5a%68|%fd(?:7zXZ|%37%7a%58%5a)%00)")
_URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2}|[!-$&-~])*")
_BYTE_MAGIC = re.compile(r"(?i:\\x1f\\x8b|(?:x|\\x78)(?:\\x01|\\x5e|\^|\\x9c|\\xda)|BZh|\\x42\\x5a\\x68|\\xfd(?:7zXZ|\\x37\\x7a\\x58\\x5a)\\x00)")
_BYTE_RUN = re.compile(r"(?:\\x[0-9A-Fa-f]{2}|\\[abfnrtv\\'\"]|[\x20-\[\]-~])*")
#: Characters from which a beginning is told, before more is decoded.
_HEADS = (64, 4096)
#: An escape among whose digits another one begins.
_NESTED = re.compile(r"(?:%[0-9A-Fa-f]?|\\(?:x[0-9A-Fa-f]?|u[0-9A-Fa-f]{0,3}|U[0-9A-Fa-f]{0,7}|u\{[0-9A-Fa-f]{0,5}))(?:%[0-9A-Fa-f%\\]|\\[xuU])")
_SIGN = re.compile(r"[+/_-]+")
_BYTE = re.compile(r"\\x([0-9A-Fa-f]{2})|\\([abfnrtv\\'\"])")
_BYTE_NAMES = dict(zip("abfnrtv\\'\"", "\a\b\f\n\r\t\v\\'\"", strict=True))
_IS_CUT = bytes(ord("c") if chr(i) in "\0,;()<>[]!?*#&@|~$^`" else ord(".") for i in range(256))
#: Marks hex digits h, and other characters of base64 runs b, so that runs can be found by substring search.
_IS_HEX = bytes(ord("h") if chr(i) in "0123456789abcdef" else ord(".") for i in range(256))
_IS_BASE64 = bytes(ord("b") if i < 128 and (chr(i).isalnum() or chr(i) in "+/_-") else ord(".") for i in range(256))


class Layer(NamedTuple):
    """A text and, for each of its characters, where in the original it starts and ends; None: it is the original. Both
    only grow from character to character."""

    text: str
    starts: np.ndarray | None
    ends: np.ndarray | None

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start]), int(self.ends[end - 1])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for arrays of starts and ends."""
        if self.starts is None:
            return starts.astype(np.int32), ends.astype(np.int32)
        return self.starts[starts], self.ends[ends - 1]


def base_spans(text: str, raw: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base secrets; raw: the text's bytes. Cheap substring searches tell first whether an
    expression can match at all."""
    out = []
    lower = text.lower()
    if any(w in lower for w in _WORDS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if b"h" * 32 in raw.translate(_IS_HEX):
        out += [("hex", m.start(), m.end()) for m in _HEX_RUN.finditer(text)]  # whole runs, as matching is greedy
    return out


def _decoder(head: bytes):
    """A decompressor for data that starts so; None if it is not compressed."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and head[1:2] and head[1:2] in b"\x01\x5e\x9c\xda":
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _inflated(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """What compressed data holds, all members of it, in pieces of at most EXPANDED bytes; up to the first fault in it."""
    decoder = None
    for piece in pieces:
        while True:
            decoder = decoder or _decoder(piece)
            if decoder is None:
                return
            try:
                out = decoder.decompress(piece, EXPANDED)
            except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                return
            if out:
                yield out
            if decoder.eof:  # a further member may follow, in xz after zero bytes
                piece, decoder = decoder.unused_data.lstrip(b"\0"), None
                if len(piece) < 6:
                    piece += b"".join(itertools.islice(pieces, 1))
                    piece = piece.lstrip(b"\0")
                if not piece:
                    break
            elif hasattr(decoder, "unconsumed_tail"):
                piece = decoder.unconsumed_tail
                if not piece and len(out) < EXPANDED:
                    break
            else:
                piece = b""
                if decoder.needs_input:
                    break


def _unpacked(data: bytes) -> Iterator[bytes] | None:
    """Pieces of what compressed data holds, compression inside compression undone too; None if it is not compressed."""
    pieces, inside = iter([data]), set()
    first = data
    while _decoder(first) is not None and (digest := hashlib.blake2b(first).digest()) not in inside:  # an archive may hold itself
        inside.add(digest)
        inner = _inflated(pieces)
        head = b""
        while len(head) < 6 and (more := next(inner, None)) is not None:
            head += more
        if not head:
            return None if len(inside) == 1 else iter([first])
        first, pieces = head, itertools.chain([head], inner)
    return pieces if inside else None


def _texts(pieces: Iterator[bytes]) -> Iterator[str]:
    """The pieces as texts of about EXPANDED bytes, parted only at characters that no secret and no code goes across."""
    held = b""
    for piece in pieces:
        held += piece
        if len(held) < EXPANDED:
            continue
        cut = held.translate(_IS_CUT).rfind(b"c") + 1
        if cut:
            yield held[:cut].decode("utf-8", "replace")
            held = held[cut:]
        else:
            held = re.sub(rb"\x20{2,}", b" ", held)
    if held:
        yield held.decode("utf-8", "replace")


def _packed_layers(data: bytes, start: int, end: int) -> Iterator["Layer"] | None:
    pieces = _unpacked(data)
    return None if pieces is None else (Layer(t, *(np.broadcast_to(np.int32(x), len(t)) for x in (start, end))) for t in _texts(pieces))


def _readable(data: bytes) -> str | None:
    try:
        return data.decode("utf-8") or None
    except UnicodeDecodeError:
        return None


def _replaced(layer: Layer, matches: list[tuple[int, int, str]], starts: np.ndarray, ends: np.ndarray) -> Layer:
    """The layer with matches (start, end, new text); starts and ends: the part of the layer that each new character stands for."""
    text, at = [], 0
    for a, b, new in matches:
        text += [layer.text[at:a], new]
        at = b
    text.append(layer.text[at:])
    # places of the old characters that stay and of the new ones, merged by where they start
    gone = np.zeros(len(layer.text) + 1, np.int32)
    np.add.at(gone, [a for a, _, _ in matches], 1)
    np.add.at(gone, [b for _, b, _ in matches], -1)
    stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    first, last = np.concatenate([stay, starts]), np.concatenate([stay + 1, ends])
    order = np.argsort(first, kind="stable")
    return Layer("".join(text), *layer.spans(first[order], last[order]))


def _unescaped_url(layer: Layer) -> Layer | None:
    """Runs of escaped bytes are read as UTF-8."""
    found, starts, ends, run = [], [], [], []

    def close() -> None:
        new = bytes(int(m[1], 16) for m in run).decode("utf-8", "replace")
        at = 0
        for c in new:
            n = 1 if c == "\ufffd" else len(c.encode())  # a bad byte, or the bytes of a character
            starts.append(run[min(at, len(run) - 1)].start())
            at += n
            ends.append(run[min(at, len(run)) - 1].end())
        found.append((run[0].start(), run[-1].end(), new))
        run.clear()

    for m in _URL.finditer(layer.text):
        if run and run[-1].end() != m.start():
            close()
        run.append(m)
    if run:
        close()
    return _replaced(layer, found, np.array(starts, np.int64), np.array(ends, np.int64)) if found else None


def _unescaped_unicode(layer: Layer) -> Layer | None:
    found = []
    for m in _ESCAPE.finditer(layer.text):
        code = int(m[1] or m[2] or m[3] or m[4], 16)
        if code < 0x110000:
            found.append((m.start(), m.end(), chr(code)))
    return _replaced(layer, found, *(np.array([x[i] for x in found], np.int64) for i in (0, 1))) if found else None


def _code_at(out: list, i: int) -> tuple[int, int] | None:
    """The code and the number of characters of an escape that begins with out[-1] and goes on towards the list's front; i: its sign."""
    text = lambda n: "".join(x[0] if isinstance(x[0], str) else "\xff" for x in out[-1 : -1 - n : -1])
    found = _ESCAPE_AT.match(text(11)) if i else _URL_AT.match(text(3))
    if not found:
        return None
    code = int(next(g for g in found.groups() if g), 16)
    return (code, found.end()) if code < 0x110000 else None


_URL_AT, _ESCAPE_AT = re.compile(r"%([0-9A-Fa-f]{2})"), re.compile(r"\\" + _CODE)


def _collapsed(layer: Layer) -> Layer:
    """The layer with all its URL, Unicode and byte escapes undone, also those whose signs or digits are escapes, in one pass from its
    end to its start. A character of the result is kept with its first and last place; bytes beyond ASCII are read as UTF-8."""
    out: list[tuple[str | int, int, int]] = []
    for at in range(len(layer.text) - 1, -1, -1):
        out.append((layer.text[at], at, at))
        while out[-1][0] in ("%", "\\") and (met := _code_at(out, "%\\".index(out[-1][0]))):
            url, (code, size) = out[-1][0] == "%", met
            made = (code if url and code > 0x7F else chr(code), out[-1][1], out[-size][2])
            del out[-size:]
            out.append(made)
    chars, starts, ends, run = [], [], [], []

    def close() -> None:
        at = 0
        for c in bytes(x[0] for x in run).decode("utf-8", "replace"):
            n = 1 if c == "\ufffd" else len(c.encode())
            chars.append(c)
            starts.append(run[min(at, len(run) - 1)][1])
            at += n
            ends.append(run[min(at, len(run)) - 1][2] + 1)
        run.clear()

    for x in reversed(out):
        if isinstance(x[0], int):
            run.append(x)
            continue
        if run:
            close()
        chars.append(x[0])
        starts.append(x[1])
        ends.append(x[2] + 1)
    if run:
        close()
    return Layer("".join(chars), *layer.spans(np.array(starts, np.int64), np.array(ends, np.int64)))


def _may_be_packed(data: bytes) -> bool:
    """Whether data begins like compressed data and goes on without a fault."""
    decoder = _decoder(data)
    try:
        return decoder is not None and (decoder.decompress(data, 1 << 16), True)[1]
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return False


def _byte_data(text: str) -> bytes:
    return _BYTE.sub(lambda b: chr(int(b[1], 16)) if b[1] else _BYTE_NAMES[b[2]], text).encode("latin-1")


def _escaped_packed(layer: Layer) -> Iterator[Layer]:
    """Compressed data behind escapes, from each of its beginnings."""
    for sign, magic, run, data in (("%", _URL_MAGIC, _URL_RUN, urllib.parse.unquote_to_bytes), ("\\x", _BYTE_MAGIC, _BYTE_RUN, _byte_data)):
        if sign not in layer.text:
            continue
        for m in magic.finditer(layer.text):
            if all(_may_be_packed(data(run.match(layer.text, m.start(), m.start() + n)[0])) for n in _HEADS):
                whole = run.match(layer.text, m.start())
                yield from _packed_layers(data(whole[0]), *layer.span(whole.start(), whole.end())) or ()


def _decoded(body: str) -> bytes:
    body = body[: len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _base64_layers(layer: Layer) -> Iterator[Layer]:
    done = set()
    for m in itertools.chain.from_iterable(p.finditer(layer.text) for p in _BASE64):
        if m.span() in done:
            continue
        done.add(m.span())
        wrapped = "\n" in m[0]
        written = re.sub(r"[\x20\t\r\n]", "", m[0]).rstrip("=")
        body = written.replace("-", "+").replace("_", "/")
        at = None
        for start in itertools.chain([0], (x.end() for x in _SIGN.finditer(written))):
            if start:  # behind a sign: only what begins like text or compressed data is read whole
                head = _decoded(body[start : start + 64])
                if len(body) - start < LEAST_BASE64 or not (_may_be_packed(head) or _begins_like_text(head)):
                    continue
            some = body[start:]
            if len(some) % 4 == 1:
                if not wrapped and not start:
                    continue
                some = some[:-1]  # a word of the next line was taken for a part
            data = _decoded(some)
            packed = _packed_layers(data, *layer.span(m.start(), m.end()))
            if packed is not None:
                yield from packed
                if start == 0 or _may_be_packed(data):
                    break
                continue
            text = _readable(data)
            if text is None:
                continue
            # byte n comes from characters 4n/3 to 4(n+1)/3 of the run
            if at is None:
                at = np.flatnonzero(~np.isin(np.frombuffer(m[0].encode(), np.uint8), list(b" \t\r\n="))) + m.start()
            code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            size = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
            over = np.cumsum(size)
            yield Layer(text, *layer.spans(at[start + (over - size) * 4 // 3], at[start + np.minimum(len(some), -(-over * 4 // 3)) - 1] + 1))
            break


def _begins_like_text(head: bytes) -> bool:
    """Whether these bytes are UTF-8, but for a character that is cut at the end."""
    try:
        head.decode("utf-8")
    except UnicodeDecodeError as e:
        return e.start >= max(1, len(head) - 3) and e.reason == "unexpected end of data"
    return bool(head)


def scan(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """Base spans, all spans (both by start, then kind, then end), and the number of decoded layers."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    base = base_spans(text, raw)
    spans, todo, seen, layers = set(base), [iter([Layer(text, None, None)])], set(), 0
    while todo:  # one layer at a time, so large archives are never held whole
        layer = next(todo[-1], None)
        if layer is None:
            todo.pop()
            continue
        raw = raw if layer.starts is None else layer.text.encode("utf-8", "surrogatepass")
        if layer.starts is not None:
            key = (hashlib.blake2b(raw, digest_size=16).digest(), *(layer.span(0, len(layer.text)) if layer.text else (0, 0)))
            if key in seen:
                continue
            seen.add(key)
            layers += 1
            spans.update((kind, *layer.span(a, b)) for kind, a, b in base_spans(layer.text, raw))
        found = []
        if "%" in layer.text or "\\" in layer.text:
            found += [_collapsed(layer)] if _NESTED.search(layer.text) else [_unescaped_url(layer), _unescaped_unicode(layer)]
        todo += [iter([x for x in found if x is not None]), _escaped_packed(layer)]
        if b"b" * LEAST_BASE64 in raw.translate(_IS_BASE64):
            todo.append(_base64_layers(layer))
    order = lambda x: (x[1], KINDS.index(x[0]), x[2])
    return sorted(base, key=order), sorted(spans, key=order), layers


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_SCHEMA = "struct<n_assign:long,n_access:long,n_hex:long,base:string,spans:string,n_layers:long>"


def scan_secrets(docs: DataFrame) -> DataFrame:
    """The documents with all their columns and a struct secrets (with a _ behind it, if they have such a column)."""

    @F.pandas_udf(_SCHEMA)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                base, spans, layers = scan(t)
                rows.append((*(sum(k == kind for k, _, _ in base) for kind in KINDS), _joined(base), _joined(spans), layers))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans", "n_layers"])

    return docs.withColumn(own_names(docs, "secrets")["secrets"], found(F.col("text").cast("string")))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("secrets")
    out = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", s["n_assign"].alias("n_assign"), s["n_access"].alias("n_access"), s["n_hex"].alias("n_hex"), F.sha2(s["base"], 256).alias("base_sha256"), s["spans"].alias("spans"), s["n_layers"].alias("n_layers"))


QUERIES = {"op6_secret_scan": op6_secret_scan}
