"""Secret scans: base patterns, and password guess costs of values in credential contexts.

The guess cost of a value is the least over all its segmentations into dictionary words,
dates, repeats, keyboard walks (and runs of the alphabet or of digits) and brute-force
characters, by dynamic programming over its positions. Pronounceable strings of letters, such
as names, are segments too, whose cost is that of their letter pairs in the dictionary, and
a sign between segments costs a choice among signs.

Length alone makes no secret: prose, urls, addresses and placeholders cost many guesses, but
all of them for words. A value that follows a credential word and takes ``GUESSES`` powers of ten
or more is a secret if the characters that its cheapest segmentation leaves to brute force alone
take so many, or if each of its characters takes ``DENSE`` in the mean.
A pass phrase, a few words with blanks after a word for passwords, is one if all of it does.

Dictionary words are ranked: common passwords and placeholders first, then the whole words of
a tokenizer's vocabulary, in the order in which that learnt them.
"""

from __future__ import annotations

import functools
import json
import math
import re
import unicodedata
from typing import NamedTuple

from pyspark.sql import DataFrame

from lociq.llm.frames import map_columns, rewrite_texts

#: Powers of ten of guesses from which a value counts as a secret, and its least length.
GUESSES, SHORTEST = 8.0, 6
#: Words of a pass phrase.
PHRASE = range(3, 9)
#: Letters that a name has at least, and powers of ten that one of them may cost in the mean.
NAME_LETTERS, NAME_COST = 4, 1.15
#: Powers of ten a character from which a value without blanks is no sequence of words.
DENSE = 1.3
KINDS = ("assign", "access", "hex", "guess")

# Letters are spelt in both cases: only ASCII letters are meant.
_BOTH = lambda s: re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", s)
_ASSIGN = re.compile(_BOTH("(password|passwd|secret|token|api_?key)") + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
_HEX = re.compile("[0-9a-f]{16,}")
_CONTEXT = re.compile(
    _BOTH(r"(passwords?|passwd|passphrase|pwd|secrets?|tokens?|api[_-]?keys?|(?:access|private|client|signing)[_-]?(?:key|secret)|authorization|auth|bearer|credentials?)")
    + r"[\"']?[ \t]*(?:=>|[:=])[ \t]*(?:[Bb]earer +|[Bb]asic +)?([\"']?)"
)
#: What a quoted value holds: all before its own quote, blank lines excepted. A quote after a backslash or before a word sign, as in don't, is part of it.
_INSIDE = {q: re.compile(rf"(?:\\(?s:.)|[^{q}\\\n]|\n(?![ \t]*\n)|{q}(?=\w))*+") for q in "\"'"}
_UNQUOTED = re.compile(r"\S*")

#: Common passwords and placeholders, in the order in which they are guessed. Fixed values.
WORDS = """password 123456 qwerty admin welcome secret letmein monkey dragon master login
abc123 iloveyou princess football baseball sunshine shadow superman michael jordan hunter test
guest root user default changeme change example sample placeholder dummy fake your my the token
key api apikey pass passwd private public access client server database demo temp temporary
hello world love god money computer internet service system account company office home house
summer winter spring autumn monday friday january february march april june july august
september october november december red blue green black white orange yellow none null true
false undefined value string here insert replace enter todo fixme redacted hidden xxx foo bar baz
alpha beta gamma delta prod production staging develop development local localhost mail email
name first last data file code auth bearer basic session cookie web app site config""".split()


class Words(NamedTuple):
    """Ranks of words from 1, the length of the longest, and what each letter costs after another (a blank begins a word)."""

    ranks: dict[str, int]
    longest: int
    pairs: dict[str, float]


def ranked(words: list[str]) -> Words:
    ranks: dict[str, int] = {}
    for w in words:
        ranks.setdefault(w, len(ranks) + 1)
    seen: dict[str, int] = {}
    for w in ranks:
        if w.isascii() and w.isalpha():
            for a, b in zip(" " + w, w, strict=False):
                seen[a + b] = seen.get(a + b, 0) + 1
                seen[a] = seen.get(a, 0) + 1
    pairs = {a + b: -math.log10((seen.get(a + b, 0) + 1) / (seen.get(a, 0) + 26)) for a in " " + _LETTERS for b in _LETTERS}
    return Words(ranks, max(map(len, ranks)), pairs)


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


#: The built-in words alone.
COMMON = ranked(WORDS)


@functools.lru_cache(4)
def load_words(path: str | None) -> Words:
    """WORDS, then the words of three letters or more that are whole tokens of the vocabulary file, by their ids."""
    if path is None:
        return COMMON
    with open(path, encoding="utf-8") as f:
        ids = json.load(f)["model"]["vocab"]
    whole = [t.removesuffix("</w>") for t in sorted(ids, key=ids.get) if t.endswith("</w>")]
    return ranked(WORDS + [w for w in whole if len(w) >= 3 and w.isalpha()])


_LEET = str.maketrans("4@301!5$7", "aaeoiisst")
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_SHIFTED = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./", strict=True))


def _neighbours() -> dict[str, str]:
    """Keys beside each other on a keyboard whose rows are set half a key apart."""
    place = {c: (r, i + r / 2) for r, row in enumerate(_ROWS) for i, c in enumerate(row)}
    return {c: "".join(d for d, (s, y) in place.items() if d != c and abs(r - s) <= 1 and abs(x - y) <= 1) for c, (r, x) in place.items()}


_NEAR = _neighbours()
_DATES = [re.compile(p) for p in (r"(?:19|20)\d\d", r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])", r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1(?:19|20)?\d\d", r"(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\1(?:19|20)?\d\d", r"(?:19|20)\d\d-?\d\d-?\d\d[T ]\d\d:?\d\d(?::?\d\d)?(?:\.\d+)?(?:Z|[+-]\d\d:?\d\d)?", r"(?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d)?")]
_DATE_COST = (2.0, 4.6, 4.6, 4.6, 9.5, 4.9)
#: Letters of one case, or with a capital first; signs of the keyboard, which cost a choice of one of them.
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SIGN, _SIGN_COST = re.compile(r"[!-/:-@\[-`{-~\s]"), math.log10(34)
#: What each further segment adds: the guesser doesn't know where segments end.
_JOIN = 0.3
#: The longest unit that is looked for said again and again; a longer one costs what its own segments cost each time, which is more.
LONGEST_UNIT = 32


def alphabet_size(value: str) -> int:
    size = 0
    for test, n in (("[a-z]", 26), ("[A-Z]", 26), ("[0-9]", 10), (r"[^\sa-zA-Z0-9\x80-\U0010ffff]", 33), (r"[\x80-\U0010ffff]", 100)):
        size += n if re.search(test, value) else 0
    return max(size, 10)


@functools.lru_cache(4096)
def _unit_cost(unit: str, path: str | None) -> float:
    return guess_cost(unit, path)


def segments(value: str, path: str | None = None):
    """(start, end, cost) of every word, date, repeat and walk in the value; the spans are linear in its length."""
    words = load_words(path)
    n, low = len(value), "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = low.translate(_LEET)
    for i in range(n):
        for j in range(i + 2, min(n, i + words.longest) + 1):
            raw = low[i:j]
            rank = words.ranks.get(raw) or words.ranks.get(plain[i:j])
            if rank:
                yield i, j, math.log10(rank + 1) + (0.3 if value[i:j] != raw else 0) + (0.3 if raw not in words.ranks else 0)
        if _SIGN.match(value, i):
            yield i, i + 1, _SIGN_COST
        if "0" <= value[i] <= "9":
            for pattern, cost in zip(_DATES, _DATE_COST, strict=True):
                if m := pattern.match(value, i):
                    yield i, m.end(), cost
    bare = "".join(unicodedata.normalize("NFD", c)[0] for c in value) if not value.isascii() else value
    for m in _NAME.finditer(bare):
        name = m[0].lower()
        if len(name) >= NAME_LETTERS:
            cost = sum(words.pairs[a + b] for a, b in zip(" " + name, name, strict=False))
            if cost <= NAME_COST * len(name):
                yield m.start(), m.end(), cost + 0.3
    for unit in range(1, min(LONGEST_UNIT, n // 2) + 1):  # a unit said again and again
        i = 0
        while i + 2 * unit <= n:
            j = i + unit
            while j < n and value[j] == value[j - unit]:
                j += 1
            if j - i >= max(3, 2 * unit):
                yield i, j, _unit_cost(value[i : i + unit], path) + math.log10((j - i) / unit)
                i = j - unit + 1
            else:
                i += 1
    keys = "".join(_SHIFTED.get(c, c) for c in low)
    for beside, turns in ((lambda a, b: b in _NEAR.get(a, ""), 0.6), (lambda a, b: a.isalnum() and ord(b) - ord(a) == 1, 0.0), (lambda a, b: a.isalnum() and ord(a) - ord(b) == 1, 0.0)):
        i = 0
        while i < n - 2:
            j = i + 1
            while j < n and beside(keys[j - 1], keys[j]):
                j += 1
            if j - i >= 3:
                yield i, j, math.log10(47) + math.log10(j - i) + turns * (j - i - 1) * 0.5
            i = max(j, i + 1)


def cheapest(value: str, path: str | None = None) -> tuple[float, list[tuple[int, int, float]]]:
    """log10 of the guesses for the cheapest segmentation, and its parts (start, end, cost); a part of brute force is one character."""
    n, brute = len(value), math.log10(alphabet_size(value)) if value else 0.0
    ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for i, j, cost in segments(value, path):
        ending[j].append((i, cost))
    best, before = [0.0] * (n + 1), [0] * (n + 1)
    for j in range(1, n + 1):
        low, at = best[j - 1] + brute, j - 1
        for i, cost in ending[j]:
            if (new := best[i] + cost + (_JOIN if i else 0.0)) < low:
                low, at = new, i
        best[j], before[j] = low, at
    parts, j = [], n
    while j:
        parts.append((before[j], j, best[j] - best[before[j]]))
        j = before[j]
    return best[n], parts[::-1]


def guess_cost(value: str, path: str | None = None) -> float:
    """log10 of the guesses for the cheapest segmentation. An empty value costs 0."""
    return cheapest(value, path)[0]


def hard_cost(value: str, parts: list[tuple[int, int, float]]) -> float:
    """What of a segmentation's cost falls on runs of single characters that aren't all signs: signs alone only part its words. The most of any stretch between blanks."""
    most = total = held = 0.0
    odd = False
    for i, j, cost in [*parts, (len(value), len(value) + 2, 0.0)]:
        blank = value[i:j].isspace()
        if j - i == 1 and not blank:
            held, odd = held + cost, odd or not _SIGN.match(value, i)
        else:
            total, held, odd = total + (held if odd else 0.0), 0.0, False
        most = max(most, total)
        total = 0.0 if blank else total
    return most


def is_secret(value: str, key: str, cost: float, parts: list[tuple[int, int, float]]) -> bool:
    """Whether a value after a credential word ``key`` is a secret, by its cheapest segmentation."""
    if cost < GUESSES or len(value) < SHORTEST:
        return False
    phrase = key.lower().startswith("p") and len(value.split()) in PHRASE and not value.startswith(("<", "{", "["))
    dense = len(value.split()) == 1 and cost >= DENSE * len(value)
    return phrase or dense or hard_cost(value, parts) >= GUESSES


def values(text: str):
    """(start, end, credential word) of every value after one.

    A quoted value ends at its own quote; one without quotes, or whose quote isn't closed
    before a blank line, at white space, less the punctuation at its end.
    """
    at, unclosed = 0, dict.fromkeys(_INSIDE, 0)
    while m := _CONTEXT.search(text, at):
        lo, quote = m.end(), m[2]
        if quote and lo >= unclosed[quote]:
            at = _INSIDE[quote].match(text, lo).end()
            if text[at : at + 1] == quote:
                yield lo, at, m[1]
                continue
            unclosed[quote] = at  # nor is any that opens before
        at = _UNQUOTED.match(text, lo).end()
        yield lo, lo + len(text[lo:at].rstrip(".,;)]}>\"'")), m[1]


def scan(text: str | None, path: str | None = None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, cost) by start, then kind as in KINDS; code points, end exclusive.

    cost is the guess cost of the value after a credential word, else -1. A base span covers
    its whole match; a guess span covers a whole value, unless an assign span covers it.
    """
    if not text:
        return []
    found: list[tuple[str, int, int, float]] = []
    if "=" in text or ":" in text:
        taken = {}
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 12:
                taken[m.start(2)] = m.end()
                found.append(("assign", m.start(), m.end(), guess_cost(m[2], path)))
        for lo, hi, key in values(text):
            if hi - lo >= SHORTEST and taken.get(lo, 0) < hi:
                cost, parts = cheapest(text[lo:hi], path)
                if is_secret(text[lo:hi], key, cost, parts):
                    found.append(("guess", lo, hi, cost))
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), -1.0) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), -1.0) for m in _HEX.finditer(text)]
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


def redact(text: str | None, path: str | None = None) -> str | None:
    """The text with every span replaced by its first kind in brackets; overlapping spans go as one."""
    if not text or not (spans := scan(text, path)):
        return text
    out, at, k = [], 0, 0
    while k < len(spans):
        kind, lo, hi, _ = spans[k]
        k += 1
        while k < len(spans) and spans[k][1] < hi:
            hi = max(hi, spans[k][2])
            k += 1
        out += [text[at:lo], f"[{kind}]"]
        at = hi
    return "".join([*out, text[at:]])


def scan_texts(docs: DataFrame, words: str | None = None) -> DataFrame:
    """(doc_id, spans) for every row, with spans an array of (kind, start, end, cost).

    ``words`` is the path of a vocabulary file whose words the guesser knows. A null or empty
    text has no span; rows with the same doc_id, or a null one, each have theirs.
    """

    def run(cols: dict) -> dict:
        return {"doc_id": cols["doc_id"], "spans": [[{"kind": k, "start": a, "end": b, "cost": c} for k, a, b, c in scan(t, words)] for t in cols["text"]]}

    return map_columns(docs.select("doc_id", "text"), run, "doc_id long, spans array<struct<kind:string,start:long,end:long,cost:double>>")


def redact_texts(docs: DataFrame, words: str | None = None) -> DataFrame:
    """Every row, with the secrets in its text replaced; null and empty texts stay as they are."""
    return rewrite_texts(docs, lambda text: redact(text, words))
