"""Words and shingles of a column of texts as numpy arrays of 64-bit hashes, a batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 2 << 20  # bytes hashed at once
_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # fixed values: odd constants with well spread bits
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def combined(*columns: np.ndarray) -> np.ndarray:
    """One hash of several columns, in order."""
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = mixed(out * _FACTOR + c)
    return out


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _FACTOR)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins (one more at the end); null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the number of words per text. ASCII white space parts words."""
    data, offsets = text_bytes(texts)
    hashes, starts_at = [], []
    begin = 0
    while begin < len(data):
        end = min(begin + PIECE, len(data))
        while end < len(data):  # up to the next white space or text
            space = np.flatnonzero(_SPACE[data[end : end + PIECE]])
            border = int(offsets[np.searchsorted(offsets, end)])
            if len(space) or border <= end + PIECE:
                end = min(border, end + int(space[0]) if len(space) else border)
                break
            end = min(end + PIECE, len(data))
        part = data[begin:end]
        word = ~_SPACE[part]
        first = word.copy()
        first[1:] &= ~word[:-1]
        borders = offsets[np.searchsorted(offsets, begin) : np.searchsorted(offsets, end)] - begin
        first[borders] = word[borders]
        starts = np.flatnonzero(first)
        if len(starts):
            # spaces add nothing; a word's bytes count by their place in it
            place = np.arange(starts[0], len(part)) - np.repeat(starts, np.diff(starts, append=len(part)))
            part, word = part[starts[0] :], word[starts[0] :]
            powers = np.ones(int(place.max()) + 1, np.uint64)
            powers[1:] = _FACTOR
            powers = np.cumprod(powers)
            hashes.append(mixed(np.add.reduceat(np.where(word, _BYTE[part] * powers[place], np.uint64(0)), starts - starts[0])))
            starts_at.append(starts + begin)
        begin = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    at = np.concatenate(starts_at)
    return np.concatenate(hashes), np.diff(np.searchsorted(at, offsets))


def shingle_hashes(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` words, and its text's number; a shorter text has one run, all its words."""
    words, counts = word_hashes(texts)
    text = np.repeat(np.arange(len(counts)), counts)
    short = (counts > 0) & (counts < n)
    last = np.cumsum(counts)
    runs = max(0, len(words) - n + 1)
    whole = (text[:runs] == text[n - 1 :]) if runs else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    hashes = [combined(*[words[at + i] for i in range(n)])]
    owners = [text[at]]
    for size in range(1, n):
        few = np.flatnonzero(short & (counts == size))
        if len(few):
            begin = last[few] - size
            hashes.append(combined(*[words[begin + i] for i in range(size)]))
            owners.append(few)
    owner, shingle = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(owner, kind="stable")
    return owner[order], shingle[order]


def counted(owner: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, item) with the number of times they occur."""
    key = combined(owner.astype(np.uint64), item)
    _, at, times = np.unique(key, return_index=True, return_counts=True)
    return owner[at], item[at], times
