"""Hashes of words and word shingles, for many texts at once (numpy, inside tasks).

Words are runs of letters and digits in lower case. A word's hash is a
Karp-Rabin polynomial modulo 2^64, taken from prefix sums over a block of
texts, mixed with its length; a shingle's hash is the same over word hashes.
Long texts are cut at word borders into blocks, so the memory needed beside
the hashes themselves does not grow with a text.
"""

from __future__ import annotations

import functools

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD_BASE = np.uint64(0xD1342543DE82EF95)
#: Characters hashed at once.
BLOCK = 1 << 20
#: Words in a shingle.
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _word_chars() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), dtype=bool, count=0x110000)


@functools.lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _powers_of(base: np.uint64, n: int) -> np.ndarray:
    return _powers(int(base), 1 << max(10, (n - 1).bit_length()))[:n]


def _blocks(text: str) -> list[str]:
    """Cut between words into pieces of about BLOCK characters."""
    cut, at = [], 0
    while len(text) - at > BLOCK:
        end = at + BLOCK
        while end < len(text) and text[end].isalnum():
            end += 1
        cut.append(text[at:end])
        at = end
    return [*cut, text[at:]]


def _hash_block(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of ``texts`` in order, and the number of words of each."""
    joined = " ".join(texts) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = _word_chars()[codes]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes + np.uint32(1)) * _powers_of(_BASE, len(codes)), out=sums[1:])
    lengths = ends - starts
    hashes = mix((sums[ends] - sums[starts]) * _powers_of(_BASE_INVERSE, len(codes))[starts] + lengths.astype(np.uint64))
    borders = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, borders), prepend=0)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts (null: none) in one array, and each text's number of words."""
    pieces = [(i, piece) for i, t in enumerate(texts) for piece in _blocks((t or "").lower())]
    hashes, counts = [np.empty(0, np.uint64)], np.zeros(len(texts), dtype=np.int64)
    at = 0
    while at < len(pieces):
        end, size = at, 0
        while end < len(pieces) and (end == at or size + len(pieces[end][1]) <= BLOCK):
            size += len(pieces[end][1])
            end += 1
        found, words = _hash_block([p for _, p in pieces[at:end]])
        hashes.append(found)
        np.add.at(counts, [i for i, _ in pieces[at:end]], words)
        at = end
    return np.concatenate(hashes), counts


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` words in a row."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total = total * _WORD_BASE + words[k : k + n]
    return mix(total)


def shingles(words: np.ndarray, counts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts and the text of each. A text of fewer words, but some, has one shingle of all of them."""
    starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    text = np.repeat(np.arange(len(counts)), counts)
    windows = window_hashes(words, size)
    whole = text[: len(windows)] == text[size - 1 : size - 1 + len(windows)] if len(windows) else np.empty(0, bool)
    short = np.flatnonzero((counts > 0) & (counts < size))
    extra = np.array([mix(np.bitwise_xor.reduce(words[starts[i] : starts[i] + counts[i]] * np.arange(3, 3 + 2 * counts[i], 2, dtype=np.uint64), keepdims=True))[0] for i in short], dtype=np.uint64)
    hashes = np.concatenate([windows[whole], extra])
    owner = np.concatenate([text[: len(windows)][whole], short])
    order = np.argsort(owner, kind="stable")
    return hashes[order], owner[order]
