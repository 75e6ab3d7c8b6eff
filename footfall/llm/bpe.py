"""BPE encoding and decoding by a bounded-lookahead streaming transducer.

A merge list in which every rule joins tokens that earlier rules (or single
bytes) make lets a change at the end of the input reach back only so far:
through a chain of rules of rising rank, each of which takes the left part of
the one before as the beginning of its right part. ``lookahead`` computes the
longest such chain for the list, in bytes. A token border further than that
from the end of what has been read is final, so the transducer reads a
pre-token symbol by symbol, emits tokens once stable, and holds a buffer of
constant size however long the pre-token is. Pre-tokens shorter than the buffer
are read to their end at once; their ids are remembered in a cache of bounded
size.

Decoding runs the ids through a byte-to-text state machine in chunks.

Ids are those of the tokenizer file (``tokenizers`` JSON): its normalizer (NFC,
white space, lower case), its split pattern, byte-level symbols, word-end
suffix and added tokens. Other components raise ValueError.

Rows: one result per input row, null texts are empty (0 tokens, empty text),
repeated rows repeat. Extra columns are ignored.
"""

from __future__ import annotations

import codecs
import functools
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import normalizers

from footfall.llm.textkit import blocks

_NFC = normalizers.NFC()

CACHE = 1 << 17  # pre-tokens remembered per worker; idle workers keep them
_CHUNK = 1 << 16  # ids decoded at once


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return [out[b] for b in range(256)]


#: Code points that the tokenizer's tables (Unicode 16) do not class as letters or numbers.
LATER = (r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
         r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
         r"\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3"
         r"\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191"
         r"\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96"
         r"\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
         r"\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f")
#: Lower case of letters that Python's tables lack, and sigma, which has no final form here.
LOWER_CASE = ({0x3A3: 0x3C3, 0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
              | {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)})
#: The same classes for texts below U+0250.
LATIN = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ɏ", r"\p{N}": "0-9²³¹¼-¾", r"\s": "\t-\r \x85\xa0"}
_BEYOND = re.compile("[^\x00-ɏ]")
_NONE = np.iinfo(np.int32).max


class Merges:
    """A merge list over token ids, its sufficient lookahead, and the transducer over it."""

    def __init__(self, pairs: list[tuple[str, str]], ids: dict[str, int], suffix: str = ""):
        self.pairs, self.suffix = pairs, suffix
        self.longest = max([1, *(self._size(a + b) for a, b in pairs)])
        self.lookahead = self._lookahead()
        self.window = 2 * (self.lookahead + self.longest) + 2
        self.size = np.zeros(max(ids.values()) + 1, dtype=np.int64)
        for token, k in ids.items():
            self.size[k] = self._size(token)
        # Pairs of ids in an open table: key, rank, id of the joined token.
        self._bits = max(8, (4 * len(pairs)).bit_length())
        self._key = np.full(1 << self._bits, -1, dtype=np.int64)
        self._rank = np.full(1 << self._bits, _NONE, dtype=np.int32)
        self._joined = np.zeros(1 << self._bits, dtype=np.int32)
        for rank, (a, b) in enumerate(pairs):
            key = ids[a] << 32 | ids[b]
            slot = int(self._slots(np.array([key]))[0])
            while self._key[slot] >= 0:
                slot = (slot + 1) % len(self._key)
            self._key[slot], self._rank[slot], self._joined[slot] = key, rank, ids[a + b]

    def _size(self, token: str) -> int:
        return len(token.removesuffix(self.suffix)) if self.suffix else len(token)

    def _lookahead(self) -> int:
        """The longest way, in symbols, that a change at the end of the input reaches back."""
        made, reach, furthest = set(), {}, 0
        for left, right in self.pairs:
            for part in (left, right):
                if self._size(part) > 1 and part not in made:
                    raise ValueError(f"no earlier rule makes {part!r}: its lookahead is not bounded")
            made.add(left + right)
            chain = max((reach.get(right[:k], 0) for k in range(1, len(right) + 1)), default=0)
            far = self._size(left) + max(self._size(right), chain)
            reach[left] = max(reach.get(left, 0), far)
            furthest = max(furthest, far)
        return furthest

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or ``_NONE``) and joined id of each pair."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slots(keys)
        open_ = np.flatnonzero((self._key[slot] != keys) & (self._key[slot] >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self._bits) - 1)
            there = self._key[slot[open_]]
            open_ = open_[(there != keys[open_]) & (there >= 0)]
        return self._rank[slot], self._joined[slot]

    def merged(self, symbols: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge many sequences at once: ids in a row and the length of each; lowest rank first, leftmost first."""
        n = len(count)
        done_ids, done_of = [], []
        of = np.repeat(np.arange(n), count)
        while len(symbols):
            rank = np.full(len(symbols), _NONE, dtype=np.int32)
            joined = np.zeros(len(symbols), dtype=np.int32)
            within = np.flatnonzero(of[1:] == of[:-1])
            rank[within], joined[within] = self._find(symbols[within], symbols[within + 1])
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            size = np.diff(np.concatenate([first, [len(symbols)]]))
            least = np.repeat(np.minimum.reduceat(rank, first), size)
            over = least == _NONE
            done_ids.append(symbols[over])
            done_of.append(of[over])
            chosen = (rank == least) & ~over
            # A run of equal symbols pairs up from its left end.
            twin = chosen[1:] & chosen[:-1]
            if twin.any():
                at = np.arange(len(symbols))
                begin = np.maximum.accumulate(np.where(chosen & ~np.concatenate([[False], twin]), at, 0))
                chosen &= (at - begin) % 2 == 0
            symbols = np.where(chosen, joined, symbols)
            keep = ~over
            keep[1:] &= ~chosen[:-1]
            symbols, of = symbols[keep], of[keep]
        ids, of = np.concatenate([*done_ids, np.zeros(0, np.int32)]), np.concatenate([*done_of, np.zeros(0, np.int64)])
        return ids[np.argsort(of, kind="stable")], np.bincount(of, minlength=n)

    def tokens(self, symbols: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of one sequence of any length, read in steps; holds ``window`` symbols at most."""
        held = symbols[:0]
        step = self.window - self.lookahead
        for at in range(0, len(symbols), step):
            held = np.concatenate([held, symbols[at:at + step]])
            ids, _ = self.merged(held, np.array([len(held)]))
            if at + step >= len(symbols):
                yield ids
                return
            ends = np.cumsum(self.size[ids])
            stable = int(np.searchsorted(ends, len(held) - self.lookahead, side="left"))  # borders before it are final
            yield ids[:stable]
            held = held[int(ends[stable - 1]) if stable else 0:]


class Tokenizer:
    """The pieces of a tokenizer file that the transducer needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self._check(spec, model)
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.merges = Merges([tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]], ids, suffix)
        self.plain = np.array([ids[s] for s in byte_symbols()], dtype=np.int32)
        self.last = np.array([ids[s + suffix] for s in byte_symbols()], dtype=np.int32)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = {k: np.array([v], dtype="<u4").tobytes() for k, v in added.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        latin = wide = pattern.replace("[\\p{L}]", "\\p{L}").replace("[\\p{N}]", "\\p{N}").replace("[^\\s\\p{L}\\p{N}]", "\\0")
        for name in (r"\p{L}", r"\p{N}"):
            latin = latin.replace(name, f"[{LATIN[name]}]")
            wide = wide.replace(name, f"[{name}--[{LATER}]]")
        self.latin = re.compile(latin.replace("\\0", f"[^{''.join(LATIN.values())}]"))
        self.wide = regex.compile("(?V1)" + wide.replace("\\0", f"[[^\\p{{White_Space}}\\p{{L}}\\p{{N}}][{LATER}]]"))
        names = ids | added
        self.bytes = [b""] * (max(names.values()) + 1)
        for name, k in names.items():
            self.bytes[k] = b" " + name.encode("utf-8")  # without a decoder, tokens stand between blanks
        self._known: dict[str, bytes] = {}

    @staticmethod
    def _check(spec: dict, model: dict) -> None:
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = [p["type"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
        if (model["type"], kinds, pre, spec["decoder"], plain) != ("BPE", ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], None, True):
            raise ValueError("this tokenizer file has components that the transducer does not know")

    def split(self, text: str) -> list[str]:
        """Pre-tokens in order; strings of added tokens stand for themselves."""
        out: list[str] = []
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                out.append(part)
                continue
            if not unicodedata.is_normalized("NFC", part):
                part = _NFC.normalize_str(part)  # its tables are older: marks that came later keep their place
            if _BEYOND.search(part):
                out += self.wide.findall(part.translate(LOWER_CASE).lower())
            else:
                part = part.lower()  # may leave the range: of one letter only, which stays a letter
                out += self.latin.findall(part) if not _BEYOND.search(part) else self.wide.findall(part)
        return out

    def _learn(self, words: list[str]) -> None:
        """Ids of pre-tokens not seen before, all at once; very long ones go through the stream."""
        raw = [w.encode("utf-8") for w in words]
        short = [k for k, r in enumerate(raw) if len(r) <= 64]
        count = np.array([len(raw[k]) for k in short], dtype=np.int64)
        data = np.frombuffer(b"".join([raw[k] for k in short]), dtype=np.uint8)
        symbols = self.plain[data]
        ends = np.cumsum(count) - 1
        symbols[ends] = self.last[data[ends]]
        ids, size = self.merges.merged(symbols, count)
        flat, at = ids.astype("<u4").tobytes(), [0, *(np.cumsum(size) * 4).tolist()]
        for k, word in enumerate(short):
            self._known[words[word]] = flat[at[k]:at[k + 1]]
        for k, r in enumerate(raw):
            if len(r) > 64:
                symbols = self.plain[np.frombuffer(r, dtype=np.uint8)]
                symbols[-1] = self.last[r[-1]]
                self._known[words[k]] = b"".join(ids.astype("<u4").tobytes() for ids in self.merges.tokens(symbols))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self._known) > CACHE:
            self._known.clear()
        self._known |= self.added
        split = [self.split(t) for t in texts]
        fresh = [w for w in set().union(*split) if w not in self._known]
        if fresh:
            self._learn(fresh)
        get = self._known.__getitem__
        out = [b"".join(map(get, s)) for s in split]
        for word in fresh:
            if len(word) > 64:
                del self._known[word]
        return out

    def decode(self, ids: bytes) -> str:
        state, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        every, table = np.frombuffer(ids, dtype="<u4"), self.bytes
        for at in range(0, len(every), _CHUNK):
            out.append(state.decode(b"".join(map(table.__getitem__, every[at:at + _CHUNK].tolist()))))
        out.append(state.decode(b"", final=True))
        return "".join(out)[1:]


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary(), "decoded": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for c, n in zip(columns, names, strict=True)], names=names)


def _encode(path: str, back: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            for block in blocks(batch.column(1)):
                size = block.hi - block.lo
                ids = t.encode([x or "" for x in batch.column(1).slice(block.lo, size).to_pylist()])
                columns = [batch.column(0).slice(block.lo, size), [len(x) // 4 for x in ids], ids]
                if back:
                    columns.append([t.decode(x) for x in ids])
                yield _batch(columns, ["doc_id", "n_tokens", "ids", "decoded"][:3 + back])
    return run


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit integers) for every row."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _encode(vocabulary or default_vocabulary(), False), "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, decoded`` for every row of ``(doc_id, ids)``; null ids give an empty text."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            yield _batch([batch.column(0), [t.decode(i or b"") for i in batch.column(1).to_pylist()]], ["doc_id", "decoded"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded string")


def encode_and_decode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: both directions in one pass over the texts."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _encode(vocabulary or default_vocabulary(), True), "doc_id bigint, n_tokens bigint, ids binary, decoded string")
