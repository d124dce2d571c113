"""Vectorised pre-tokenisation for byte-level BPE vocabularies.

The pattern that such vocabularies use is

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Every alternative is a run of one character class, so the cuts of a whole batch
of texts follow from the classes of neighbouring characters and need no regular
expression engine.  ``cuts`` finds them with array operations; ``distinct``
groups pre-tokens by a 64-bit hash and compares the characters of those that share
one, so each distinct pre-token becomes a Python string once per batch.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from dataclasses import dataclass

import numpy as np
import regex
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: Stands between texts in a joined batch; not a character.
GAP = 4
_BASE = 0x9E3779B97F4A7C15


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point; the entry after the last is ``GAP``."""
    table = np.full(0x110001, OTHER, np.uint8)
    points = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, points):
            for a, b in ((m.start(), min(m.end(), 0xD800)), (max(m.start(), 0xD800) + 0x800, m.end() + 0x800)):
                if a < b and (b <= 0xD800 or a >= 0xE000):
                    table[a:b] = kind
    # Code points that one Unicode version has and another lacks: ask the library.
    library = ByteLevel(add_prefix_space=False, use_regex=True)
    for x in np.flatnonzero(table[:0x110000] != OTHER).tolist():
        if x > 127 and unicodedata.category(chr(x)) == "Cn":
            ends = {b for _, (_, b) in library.pre_tokenize_str(f"a{chr(x)}1{chr(x)}!")}
            table[x] = LETTER if 1 not in ends else NUMBER if 3 not in ends else OTHER
    table[0x110000] = GAP
    return table


@dataclass
class Pieces:
    """Pre-tokens of a batch: ``points`` holds all texts' code points with a gap
    after each text; piece i is points[start[i]:end[i]] of text ``owner[i]``."""

    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray


def cuts(texts: list[str]) -> Pieces:
    """Pre-tokens of all ``texts``."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lengths + 1) - lengths - 1
    points = np.full(int(lengths.sum()) + len(texts), 0x110000, np.uint32)
    inside = np.ones(len(points), bool)
    inside[starts + lengths] = False
    points[inside] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = classes()[points]
    n = len(kind)
    before = np.empty_like(kind)
    before[:1] = GAP
    before[1:] = kind[:-1]
    after = np.empty_like(kind)
    after[-1:] = GAP
    after[:-1] = kind[1:]
    blank = points == 32
    led = np.zeros(n, bool)  # the character before is a blank
    led[1:] = blank[:-1]
    first = kind != before
    space = kind == SPACE
    # A run starts a piece, unless a blank before it does; within white space the
    # last character before other text stands apart from those before it.
    cut = first & ~(led & ~space & (kind != GAP))
    cut |= space & ~first & (after != SPACE) & (after != GAP)
    # Contractions: an apostrophe that starts a piece, and the letters it takes.
    marks = np.flatnonzero((points == 39) & first & ~led & (after == LETTER))
    if len(marks):
        a = points[np.minimum(marks + 1, n - 1)]
        b = points[np.minimum(marks + 2, n - 1)]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        taken = np.where(one, 2, np.where(two, 3, 0))
        hit = taken > 0
        cut[marks[hit] + 1] = False
        stop = marks[hit] + taken[hit]
        cut[stop] = True
        # The rest of the word after a contraction may be cut again only where
        # its class changes, which ``first`` has already marked.
    cut[~inside] = True
    at = np.flatnonzero(cut)
    keep = inside[at]
    start = at[keep]
    end = np.append(at[1:], n)[keep]
    owner = np.searchsorted(starts, start, side="right") - 1
    return Pieces(points, start, end, owner)


@functools.cache
def _mixed() -> np.ndarray:
    """A fixed odd 64-bit number for each code point."""
    with np.errstate(over="ignore"):
        x = (np.arange(0x110001, dtype=np.uint64) + np.uint64(1)) * np.uint64(_BASE)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return x | np.uint64(1)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(n, _BASE, np.uint64)
        up[0] = 1
        np.multiply.accumulate(up, out=up)
        down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        down[0] = 1
        np.multiply.accumulate(down, out=down)
    return up, down


def hashes(p: Pieces) -> np.ndarray:
    """A 64-bit polynomial hash of each piece.  Different pieces may share one (some always
    do, such as a long Thue-Morse word and its complement), so it only groups."""
    n = 1 << max(10, (len(p.points) - 1).bit_length()) if len(p.points) else 1
    up, down = _powers(n)
    with np.errstate(over="ignore"):
        total = np.zeros(len(p.points) + 1, np.uint64)
        np.cumsum(_mixed()[p.points] * up[: len(p.points)], out=total[1:])
        h = (total[p.end] - total[p.start]) * down[p.start]
        h ^= h >> np.uint64(31)
        return h * np.uint64(0x94D049BB133111EB) + (p.end - p.start).astype(np.uint64)


def distinct(p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Index of one piece of each kind, and the kind of every piece.  Pieces of one hash are
    compared character by character; those that differ get kinds of their own."""
    _, first, kind = np.unique(hashes(p), return_index=True, return_inverse=True)
    kind = kind.ravel()
    odd = np.flatnonzero(_differs(p, first[kind]))
    if not len(odd):
        return first, kind
    more: dict[tuple[int, str], int] = {}
    extra = []
    for i, k, s in zip(odd.tolist(), kind[odd].tolist(), strings(p, odd), strict=True):
        if (k, s) not in more:
            more[k, s] = len(first) + len(extra)
            extra.append(i)
        kind[i] = more[k, s]
    return np.append(first, np.array(extra, first.dtype)), kind


def _differs(p: Pieces, other: np.ndarray) -> np.ndarray:
    """Whether each piece differs from the piece at ``other``."""
    size = p.end - p.start
    out = size != (p.end - p.start)[other]
    left = np.flatnonzero(~out & (other != np.arange(len(other))))
    # The first characters of all pieces, then the next of those that have more.
    for at in range(16):
        left = left[size[left] > at]
        if not len(left):
            return out
        unlike = p.points[p.start[left] + at] != p.points[p.start[other[left]] + at]
        out[left[unlike]] = True
    for i in left[size[left] > 16].tolist():
        if not out[i]:
            a, b, n = p.start[i], p.start[other[i]], size[i]
            out[i] = not np.array_equal(p.points[a + 16 : a + n], p.points[b + 16 : b + n])
    return out


def digests(pretokens: list[str]) -> np.ndarray:
    """The 128-bit BLAKE2b digest of each pre-token, as two 64-bit columns."""
    joined = b"".join(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest() for s in pretokens)
    return np.frombuffer(joined, "<u8").reshape(-1, 2)


def strings(p: Pieces, which: np.ndarray) -> list[str]:
    """The pieces at ``which`` as strings."""
    if not len(which):
        return []
    start, size = p.start[which], p.end[which] - p.start[which]
    at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    joined = p.points[at].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    stop = np.cumsum(size).tolist()
    return [joined[a:b] for a, b in zip([0, *stop[:-1]], stop, strict=True)]


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE file, used one pre-token at a time."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex"):
            raise ValueError("only byte-level BPE without a normaliser is split here")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError("added tokens that reach beyond their own text aren't split here")
        self._letters = _byte_letters()
        self._at = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def ids(self, pretoken: str) -> list[int]:
        spelt = pretoken.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._letters)
        return [t.id for t in self.tokenizer.model.tokenize(spelt)]

    def count(self, pretoken: str) -> int:
        return len(self.ids(pretoken))

    def parts(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[tuple[int, int]]]:
        """Texts cut at special strings, which the library takes out before it
        splits: the parts, the text of each part, and (part before it, id) of each
        special string."""
        if self._at is None or not any(s in t for s in self.special for t in texts):
            return texts, np.arange(len(texts)), []
        out, owner, found = [], [], []
        for i, text in enumerate(texts):
            last = 0
            for m in self._at.finditer(text):
                out.append(text[last : m.start()])
                owner.append(i)
                found.append((len(out) - 1, self.special[m[0]]))
                last = m.end()
            out.append(text[last:])
            owner.append(i)
        return out, np.array(owner, np.int64), found


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each Python worker."""
    return Vocabulary(path)
