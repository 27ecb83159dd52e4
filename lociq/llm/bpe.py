"""BPE encoding and decoding over contiguous arrays of adjacent ranks.

A word is a row of part ids, one between each two boundaries, beside a row of the merge ranks
of adjacent parts. Encoding scans each row of ranks for its minimum, deletes the boundary
there and refreshes the two neighbouring ranks, until no row has a pair left to merge. The
rows of many new words are worked together as matrices. Words over ``LONG`` symbols, for which
repeated scans would be quadratic, take the same merges from a heap. Both choose the lowest
rank, and of equal ranks the leftmost.

Words repeat, so each Python worker keeps a bounded table of words already encoded.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import regex

#: Symbols up to which the ranks are scanned; longer words use the heap.
LONG = 96
#: Characters of texts that are encoded together.
TOGETHER = 1_000_000
#: Words that a worker remembers, in two halves: when the newer is full it becomes the older, whose words come back when they are met.
MEMORY = 1_000_000
_NONE = np.int32(1 << 30)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in keep else next(spare)) for b in range(256)]


#: Widths of the matrices that words are sorted into, and their most rows.
_WIDTHS, _ROWS = (6, 10, 16, 32, LONG), 4096


class PairRanks:
    """Ranks of pairs of ids: an open-addressed table that is asked for many pairs at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.bits = max(4, int(len(left)).bit_length() + 2)
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, dtype=np.int32)
        key = (left.astype(np.int64) << 32) | right
        spot, rank = self.spots(key), np.arange(len(key), dtype=np.int32)
        while len(key):
            self.keys[spot] = np.where(self.keys[spot] == -1, key, self.keys[spot])
            done = self.keys[spot] == key
            self.ranks[spot[done]] = np.minimum(self.ranks[spot[done]], rank[done])
            key, rank, spot = key[~done], rank[~done], (spot[~done] + 1) & ((1 << self.bits) - 1)

    def spots(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        spot = self.spots(key)
        held = self.keys[spot]
        out = np.where(held == key, self.ranks[spot], _NONE)
        seek = np.flatnonzero((held != key) & (held != -1))
        while len(seek):
            spot[seek] = (spot[seek] + 1) & ((1 << self.bits) - 1)
            held = self.keys[spot[seek]]
            hit = held == key[seek]
            out[seek[hit]] = self.ranks[spot[seek[hit]]]
            seek = seek[~hit & (held != -1)]
        return out


class WordBpe:
    """Encoder and decoder for a byte-level BPE file with word ends and lower-casing.

    ``encode(text)`` gives the ids as ``array('I')``; ``decode(ids)`` joins the tokens by
    blanks, as for a tokenizer file without a decoder. Special tokens in a text are taken
    as such. Null and empty texts have no ids.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.tokens = [""] * (max([*self.vocab.values(), *special.values()]) + 1)
        for token, i in [*self.vocab.items(), *special.items()]:
            self.tokens[i] = token
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = self.vocab
        left, right = (np.array([ids[m[k]] for m in merges], dtype=np.int32) for k in (0, 1))
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int32)
        self.pairs = PairRanks(left, right)
        symbols = byte_symbols()
        self.first = np.array([ids[c] for c in symbols], dtype=np.int32)
        self.last = np.array([ids[c + self.end] for c in symbols], dtype=np.int32)
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(steps[0]["pattern"]["Regex"]).findall
        letters = "".join(re.escape(chr(c)) for c in range(0x80, 0x250) if unicodedata.category(chr(c))[0] == "L")
        numbers = "".join(chr(c) for c in range(0x80, 0x250) if unicodedata.category(chr(c))[0] == "N")
        self.plain_words = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{letters}]+|[0-9{numbers}]|[^\sa-z0-9{letters}{numbers}]+").findall
        self.is_plain = re.compile("[\t\n\r -~\xa1-ɏ–-‟]*").fullmatch
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")").split if special else None
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def normalise(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # character by character: a final sigma is not special
                return "".join(map(str.lower, text))
        return text.lower()

    @functools.cached_property
    def ranks(self) -> dict[tuple[int, int], int]:
        """Ranks by pair, for single words."""
        held = self.pairs.keys[self.pairs.keys >= 0]
        return {(int(k) >> 32, int(k) & 0xFFFFFFFF): int(r) for k, r in zip(held, self.pairs.of(held >> 32, held & 0xFFFFFFFF), strict=True)}

    def merge_rows(self, parts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Merge the rows of part ids in place; ``sizes`` parts of each hold, and the new sizes are returned."""
        n, width = parts.shape
        sizes = sizes.copy()
        if width < 2:
            return sizes
        inside = np.arange(1, width)[None, :] < sizes[:, None]
        ranks = np.full((n, width), _NONE, dtype=np.int32)
        ranks[:, :-1][inside] = self.pairs.of(parts[:, :-1][inside], parts[:, 1:][inside])
        rows, at = np.arange(n), np.arange(width)[None, :]
        work, size = parts, sizes  # the rows that still merge
        while True:
            i = ranks.argmin(axis=1)
            low = ranks[np.arange(len(rows)), i]
            live = low < _NONE
            if not live.all():
                if rows is not None and len(rows):
                    parts[rows[~live]], sizes[rows[~live]] = work[~live], size[~live]
                rows, work, ranks, size, i, low = rows[live], work[live], ranks[live], size[live], i[live], low[live]
            if not len(rows):
                return sizes
            k = np.arange(len(rows))
            work[k, i] = self.merged[low]
            # delete the boundary behind i: what follows moves up
            np.copyto(work[:, :-1], work[:, 1:].copy(), where=at[:, :-1] > i[:, None])
            np.copyto(ranks[:, :-1], ranks[:, 1:].copy(), where=at[:, :-1] >= i[:, None])
            ranks[:, -1] = _NONE
            size -= 1
            # refresh the ranks on either side of the new part
            right = i + 1 < size
            ranks[k[~right], i[~right]] = _NONE
            ranks[k[right], i[right]] = self.pairs.of(work[k[right], i[right]], work[k[right], i[right] + 1])
            left = i > 0
            ranks[k[left], i[left] - 1] = self.pairs.of(work[k[left], i[left] - 1], work[k[left], i[left]])

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges from a heap over linked parts, for very long words."""
        get, n = self.ranks.get, len(parts)
        before, after = [*range(-1, n - 1)], [*range(1, n), -1]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j < 0 or parts[i] != left or parts[j] != right:
                continue
            parts[i] = int(self.merged[rank])
            gone[j] = 1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (r, a, parts[a], parts[b]))
        return [p for p, g in zip(parts, gone, strict=True) if not g]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        raw = [w.encode("utf-8", "replace") for w in words]
        out: list[bytes] = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for k, b in enumerate(raw):
            if len(b) > LONG:
                ids = self.first[np.frombuffer(b, dtype=np.uint8)]
                ids[-1] = self.last[b[-1]]
                out[k] = np.array(self.merge_long(ids.tolist()), dtype="<u4").tobytes()
            else:
                by_width.setdefault(next(w for w in _WIDTHS if len(b) <= w), []).append(k)
        for width, members in by_width.items():
            for lo in range(0, len(members), _ROWS):
                some = members[lo : lo + _ROWS]
                sizes = np.array([len(raw[k]) for k in some])
                held = np.arange(width)[None, :] < sizes[:, None]
                parts = np.zeros((len(some), width), dtype=np.int32)
                parts[held] = self.first[np.frombuffer(b"".join([raw[k] for k in some]), dtype=np.uint8)]
                parts[np.arange(len(some)), sizes - 1] = self.last[[raw[k][-1] for k in some]]
                left = self.merge_rows(parts, sizes)
                data = parts[np.arange(width)[None, :] < left[:, None]].astype("<u4").tobytes()
                ends = (4 * np.cumsum(left)).tolist()
                for k, a, b in zip(some, [0, *ends], ends, strict=False):
                    out[k] = data[a:b]
        return out

    def cut_words(self, text: str | None) -> list:
        """The words of a text; special tokens come as their ids in bytes."""
        if not text:
            return []
        if self.cut and "<|" in text and len(pieces := self.cut(text)) > 1:
            out: list = []
            for piece in pieces:
                out += [self.special[piece].to_bytes(4, "little")] if piece in self.special else self.words_of(piece)
            return out
        return self.words_of(text)

    def words_of(self, text: str) -> list[str]:
        text = self.normalise(text)
        return (self.plain_words if self.is_plain(text) else self.words)(text)

    def encode_many(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers. New words of up to TOGETHER characters of texts are encoded together."""
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end] or "") <= TOGETHER):
                chars += len(texts[end] or "")
                end += 1
            get = self.memory.get
            cut = [self.cut_words(t) for t in texts[at:end]]
            found = [list(map(get, words)) for words in cut]
            lacking = [[k for k, g in enumerate(got) if g is None] if None in got else () for got in found]
            fresh = self.recalled(dict.fromkeys(words[k] for words, ks in zip(cut, lacking, strict=True) for k in ks))
            for words, got, ks in zip(cut, found, lacking, strict=True):
                for k in ks:
                    got[k] = fresh[words[k]]
                yield b"".join(got)
            at = end

    def recalled(self, words: dict) -> dict:
        """ids by word, from the older half of the table or encoded anew; bytes stand for themselves."""
        older = self.older
        out = {w: w if type(w) is bytes else older.get(w) for w in words}
        new = [w for w, ids in out.items() if ids is None]
        out.update(zip(new, self.encode_words(new), strict=True))
        if len(self.memory) + len(out) > MEMORY // 2:
            self.older, self.memory = self.memory, {}
        self.memory.update((w, ids) for w, ids in out.items() if len(w) <= 64 and type(w) is str)
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(next(self.encode_many([text])), dtype="<u4")

    def decode(self, ids) -> str:
        """The tokens joined by blanks; unknown ids are skipped."""
        tokens = self.tokens
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        try:
            return " ".join([tokens[i] for i in ids])
        except IndexError:
            return " ".join([tokens[i] for i in ids if i < len(tokens)])


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The encoder for a file, read once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
