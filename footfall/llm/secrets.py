"""Secret scan: fixed patterns and a token-efficiency test.

Base kinds, leftmost and not overlapping per kind, positions in code points:
``assign`` (a value of 8+ characters given to a password-like name),
``access`` (``AKIA`` keys of 16+ characters), ``hex`` (32+ hex digits).

The added kind ``random``: a run of 20+ key characters that holds a letter and
reads like noise. A vocabulary of frequent strings spends few tokens on words
and many on noise, so a run is taken as random when it has fewer than
``RATIO`` characters per token; a number between separators counts as one
token with the separator before it. Pieces between separators and windows of
20 characters are tested like the whole run, and the low stretch is the span. Known digests (hex of a digest's length,
also named, as ``sha256-``) and UUIDs are identifiers and are left out, as are
runs that a base span covers already. Words are left to the ratio.

Rows: one result per input row; null and empty texts have no spans; repeated
rows repeat. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import bisect
import functools
import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
RATIO = 2.0
LENGTH = 20

#: The base patterns. Letters of the names are spelt in both cases.
_NAMES = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name) for name in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{32,}")
RUN = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LENGTH},}}")
#: Hex lengths of common digests (md5, sha1, sha224, sha256, sha384, sha512).
DIGESTS = {32, 40, 56, 64, 96, 128}
_DIGESTS = "|".join(f"[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}}" for n in sorted(DIGESTS, reverse=True))
_IDENTIFIER = re.compile(
    "(?<![A-Za-z0-9])(?:[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"  # UUID
    "|" + "|".join(f"sha{bits}[-_][A-Za-z0-9+/]{{{n}}}{pad}(?!=)" for bits, n, pad in ((1, 27, "="), (224, 38, "=="), (256, 43, "="), (384, 64, ""), (512, 86, "==")))
    + f"|{_DIGESTS})(?![A-Za-z0-9])")
_LETTER = re.compile("[A-Za-z]")
_PIECE = re.compile(f"[A-Za-z0-9+]{{{LENGTH},}}")
_NUMBER = re.compile("(?:^|[+/_=-])[0-9]+(?![A-Za-z0-9])")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _noise(run: str, encoding, ratio: float) -> list[tuple[int, int]]:
    """The random stretches of a run, without the identifiers in it."""
    out, start = [], 0
    for s, e in [m.span() for m in _IDENTIFIER.finditer(run)] + [(len(run), len(run))]:
        if s - start >= LENGTH:
            out += [(start + x, start + y) for x, y in _low(run[start:s], encoding, ratio)]
        start = e
    return out


def _low(part: str, encoding, ratio: float) -> list[tuple[int, int]]:
    """The stretches of ``part`` with a low ratio of characters to tokens."""
    if not _LETTER.search(part):
        return []
    at = [0]
    for token in encoding.encode_ordinary(part):
        at.append(at[-1] + len(encoding.decode_single_token_bytes(token)))
    cost = [1] * (len(at) - 1)
    for m in _NUMBER.finditer(part):
        i, j = bisect.bisect_left(at, m.start()), bisect.bisect_left(at, m.end())
        cost[i + 1:j] = [0] * (j - i - 1)
    spent = list(itertools.accumulate(cost, initial=0))
    return _stretches(part, at, spent, ratio)


def _stretches(part: str, at: list[int], spent: list[int], ratio: float) -> list[tuple[int, int]]:
    """The whole part, its windows of ``LENGTH`` characters, and its pieces between separators, where the ratio is low."""
    def low(s: int, e: int) -> bool:
        return e - s < ratio * (spent[bisect.bisect_left(at, e)] - spent[bisect.bisect_left(at, s)])

    pieces = [m.span() for m in _PIECE.finditer(part) if _LETTER.search(m[0]) and low(*m.span())]
    found: list[list[int]] = []
    if low(0, at[-1]):
        found.append([0, len(at) - 1])
    j = 0
    for i in range(len(at) - 1 if not found else 0):
        while j < len(at) and at[j] - at[i] < LENGTH:
            j += 1
        if j == len(at):
            break
        if at[j] - at[i] < ratio * (spent[j] - spent[i]) and _LETTER.search(part, at[i], at[j]):
            if found and i < found[-1][1]:
                found[-1][1] = j
            else:
                found.append([i, j])
    whole = len(found) == 1 and found[0] == [0, len(at) - 1]
    out: list[tuple[int, int]] = []
    for i, j in found:
        while not whole and at[i + 1] - at[i] > ratio and at[j] - at[i + 1] >= LENGTH:  # words at the ends stand around the key
            i += 1
        while not whole and at[j] - at[j - 1] > ratio and at[j - 1] - at[i] >= LENGTH:
            j -= 1
        s, e = at[i], at[j]
        within = pieces[bisect.bisect_right(pieces, s, key=lambda x: x[1]):bisect.bisect_left(pieces, e, key=lambda x: x[0])]
        if within:  # up to the piece's ends, and beyond them only where that is noise too
            s = within[0][0] if within[0][0] < s or not low(s, within[0][0]) else s
            e = within[-1][1] if within[-1][1] > e or not low(within[-1][1], e) else e
        out.append((s, e))
    starts, reach = _reach(out)
    out += [x for x in pieces if reach[bisect.bisect_left(starts, x[1])] <= x[0]]
    merged: list[tuple[int, int]] = []
    for s, e in sorted(out):
        if merged and s < merged[-1][1]:
            first, last = merged.pop()
            s, e = first, max(e, last)
        merged.append((s, e))
    return merged


def _reach(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """The sorted starts of spans, and the largest end among the first 0, 1, 2, ... of them."""
    spans = sorted(spans)
    return [s for s, _ in spans], list(itertools.accumulate((e for _, e in spans), max, initial=-1))


def scan(text: str, encoding, ratio: float = RATIO) -> list[tuple[str, int, int]]:
    """Spans ``(kind, start, end)`` of one text, by start, then kind as listed."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    starts, reach = _reach([(s, e) for _, s, e in found])
    for m in RUN.finditer(text):
        if reach[bisect.bisect_right(starts, m.start())] >= m.end():
            continue
        for x, y in _noise(m[0], encoding, ratio):
            x, y = m.start() + x, m.start() + y
            if reach[bisect.bisect_right(starts, x)] < y:
                found.append(("random", x, y))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _scan(path: str, ratio: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path)
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(x.as_py() or "", encoding, ratio)] for x in batch.column(1)]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])
    return run


def find_secrets(docs: DataFrame, vocabulary: str | None = None, ratio: float = RATIO) -> DataFrame:
    """``doc_id, spans``: an array of ``(kind, start, end)`` per row, ends exclusive."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _scan(vocabulary or default_vocabulary(), ratio), "doc_id bigint, spans array<struct<kind:string,start:int,end:int>>")
