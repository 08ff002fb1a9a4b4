"""Words, shingles and their 64-bit hashes, a batch of texts at a time.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return. All of these are ASCII, so words of UTF-8 bytes are words of characters.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _draws(seed: int, n: int) -> np.ndarray:
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed))


_BYTES = _draws(11, 256)
FACTOR = 0xD6E8FEB86659FD93
_FACTOR = np.uint64(FACTOR)
_powers: dict[int, np.ndarray] = {}


def powers(n: int, of: int = FACTOR) -> np.ndarray:
    """The first ``n`` powers of a number, in 64 bits."""
    if len(_powers.get(of, ())) < n:
        factors = np.full(max(n, 1024), of, np.uint64)
        factors[0] = 1
        _powers[of] = np.cumprod(factors, dtype=np.uint64)
    return _powers[of][:n]


def _hash_chunk(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    kept = data[inside]
    at = np.flatnonzero(first[inside])
    place = np.arange(len(kept)) - np.repeat(at, np.diff(at, append=len(kept)))
    values = _BYTES[kept] * powers(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(values, at)), starts


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word and the byte it starts at; works through chunks cut at spaces."""
    whole = np.frombuffer(data, np.uint8)
    hashes, starts, begin = [], [], 0
    while begin < len(whole):
        end = min(begin + _CHUNK, len(whole))
        step = _CHUNK
        while end < len(whole):
            spaces = np.flatnonzero(_SPACE[whole[max(begin, end - step) : end]])
            if len(spaces):
                end = max(begin, end - step) + int(spaces[-1]) + 1
                break
            end = min(end + _CHUNK, len(whole))  # a word longer than the chunk
        h, s = _hash_chunk(whole[begin:end])
        hashes.append(h)
        starts.append(s + begin)
        begin = end
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and where each text's words begin and end."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    edges = np.concatenate(([0], np.cumsum(lengths)))
    hashes, starts = word_hashes(b"\n".join(texts))
    return hashes, np.searchsorted(starts, edges)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` words; of all of them together if there are fewer."""
    if not len(hashes):
        return hashes
    k = min(k, len(hashes))
    n = len(hashes) - k + 1
    total = np.full(n, np.uint64(k), np.uint64)
    for j in range(k):
        total = total * _FACTOR + hashes[j : j + n]
    return mix(total)


def runs_in_texts(hashes: np.ndarray, edges: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words that stay within a text, and the text of each."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    whole = text[:n] == text[k - 1 :]
    return shingles(hashes, k)[whole], text[:n][whole]
