"""Hashed word shingles of whole texts, in numpy over batches of documents."""

from __future__ import annotations

import numpy as np

from weftline.llm.wordstats import M2, M3, hash_runs, mix


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, offsets of each text's words: one more than texts)."""
    parts = [(t or "").encode("utf-8") for t in texts]
    data = np.frombuffer(b" ".join([*parts, b""]) or b" ", np.uint8)
    begins = np.cumsum([0, *[len(p) + 1 for p in parts]])[:-1]
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    return hash_runs(data, starts, ends), np.append(np.searchsorted(starts, begins), len(starts))


def shingles(texts: list[str | None], width: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct shingle hashes, ascending; occurrences) per text.

    A text with fewer than ``width`` words has one shingle, all its words; one without words has none.
    """
    words, at = word_hashes(texts)
    run = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        run = run * M3 + words[k : k + len(run)]
    run = mix(run)
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(run[a : b - width + 1], return_counts=True))
        elif b > a:
            one = np.uint64(b - a)
            for w in words[a:b]:
                one = np.uint64((int(one) * int(M2) + int(w)) & 0xFFFFFFFFFFFFFFFF)
            out.append((mix(np.array([one], np.uint64)), np.ones(1, np.int64)))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    return out
