"""Word-level measurements of whole texts, vectorised over batches of documents.

A word is a maximal run of characters other than space, tab, LF, VT, FF and CR.  All functions
take whole texts; nulls count as texts without words.
"""

from __future__ import annotations

import functools
import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
#: Odd multipliers of the 64-bit mixes (any odd numbers with scattered bits would do).
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SHORT = 48
_SPACE, _SYMBOL, _UPPER, _ALPHA = 1, 2, 4, 8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars_upper", "n_chars_alpha", "n_end_lines", "n_unique_words")


def words(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = x + M1
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]`` for each run, whatever its length."""
    sizes = ends - starts
    h = np.zeros(len(starts), np.uint64)
    live = np.arange(len(starts))
    for k in range(_SHORT):
        live = live[sizes[live] > k]
        if not len(live):
            break
        h[live] = (h[live] ^ data[starts[live] + k]) * M1 + np.uint64(k + 1)
    for i in live[sizes[live] > _SHORT] if len(live) else ():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(h)


@functools.cache
def _kinds() -> np.ndarray:
    """Flags of every code point."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    for code in range(sys.maxunicode + 1):
        category = unicodedata.category(chr(code))
        out[code] = (_UPPER if category == "Lu" else 0) | (_ALPHA if category[0] == "L" else 0)
    out[[32, *range(9, 14)]] = _SPACE
    out[[ord(c) for c in SYMBOLS]] |= _SYMBOL
    return out


def _runs(space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of other things than white space begin and end."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    return edge[::2], edge[1::2]


def _repeated(keys: np.ndarray, at: np.ndarray, n: int, width: int) -> np.ndarray:
    """Per word, whether it lies in a window that occurs twice or more in its text.

    ``keys`` are hashes of windows with the text's number mixed in, ``at`` their first words.
    """
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n + 1, np.int64)
    hit = at[twice]
    np.add.at(covered, hit, 1)
    np.add.at(covered, hit + width, -1)
    return np.cumsum(covered[:n]) > 0


def measure(texts: list[str | None], width: int = 3) -> np.ndarray:
    """(texts, ``MEASURES``) measurements of whole texts.

    Words and windows are compared by 64-bit hashes within one text.
    """
    parts = [t or "" for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    out = np.zeros((len(parts), len(MEASURES)), np.int64)
    if not sizes.sum():
        return out
    data = np.frombuffer((" ".join(parts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    kinds = _kinds()[data]

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[ends] - total[begins]

    space = kinds == _SPACE
    out[:, 1] = per_text(~space)
    out[:, 2], out[:, 6], out[:, 7] = (per_text(kinds & flag > 0) for flag in (_SYMBOL, _UPPER, _ALPHA))
    start, end = _runs(space)
    bounds = np.searchsorted(start, np.append(begins, len(data)))
    out[:, 0] = np.diff(bounds)
    text = np.repeat(np.arange(len(parts)), out[:, 0])
    salted = hash_runs(data, start, end) ^ mix(text.astype(np.uint64))
    order = np.argsort(salted)
    fresh = np.ones(len(order), bool)
    fresh[1:] = salted[order[1:]] != salted[order[:-1]]
    out[:, 9] = np.bincount(text[order[fresh]], minlength=len(parts))
    last = len(start) - width + 1
    if last > 0:
        keys = np.zeros(last, np.uint64)
        for k in range(width):
            keys = keys * M3 + salted[k : k + last]
        inside = text[:last] == text[width - 1 :]
        at = np.flatnonzero(inside)
        marked = _repeated(mix(keys[at]), at, len(start), width)
        out[:, 4] = np.bincount(text[marked], minlength=len(parts))
    for i, part in enumerate(parts):
        if part:
            lines = part.split("\n")
            full = [x for x in lines if WORD.search(x)]
            out[i, 5], out[i, 3] = len(full), len(full) - len(set(full))
            out[i, 8] = sum(1 for x in full if x.rstrip()[-1:] in (".", "!", "?", '"'))
    return out


def in_chunks(texts: list, max_chars: int = 2_000_000) -> Iterator[slice]:
    """Slices of a batch whose texts hold about ``max_chars`` characters; at least one text each."""
    start = size = 0
    for i, text in enumerate(texts):
        n = 0 if text is None else len(text)
        if i > start and size + n > max_chars:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield slice(start, len(texts))
