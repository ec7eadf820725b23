"""Words and word shingles as 64-bit hashes, a whole batch of texts at a time."""
from __future__ import annotations

import numpy as np

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SEED = np.uint64(0x9E3779B97F4A7C15)
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_APART = _WHITE.copy()
_APART[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text that are hashed in one go; the arrays beside them take some 40 times as much.
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _SEED)


def _blocks(texts):
    """Slices of ``texts`` of about BLOCK_BYTES together, as encoded bytes."""
    block, size = [], 0
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        block.append(raw)
        size += len(raw)
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _hash_block(raws: list[bytes], white: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the block, and the number of words of each text."""
    data = _LOWER[np.frombuffer(b"\n".join(raws), np.uint8)]
    ends = np.cumsum([len(r) + 1 for r in raws])
    white = white[data]
    word = ~white
    starts = np.flatnonzero(word & np.concatenate(([True], white[:-1]))) if len(data) else np.zeros(0, int)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(raws), np.int64)
    at = np.flatnonzero(word)
    lengths = np.diff(np.append(np.searchsorted(at, starts), len(at)))
    # sum of byte * base^position, with the position counted inside the word
    place = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    if lengths.max() > len(_POWERS):
        _grow_powers(int(lengths.max()))
    terms = _BYTE[data[at]] * _POWERS[place]
    sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
    hashes = mix(sums + lengths.astype(np.uint64) * _SEED)
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, ends))))
    return hashes, counts


_POWERS = np.ones(1, np.uint64)


def _grow_powers(n: int) -> None:
    global _POWERS
    n = 1 << (n - 1).bit_length()
    base = np.full(n, _MIX[0] | np.uint64(1), np.uint64)
    base[0] = 1
    _POWERS = mix(np.multiply.accumulate(base)) | np.uint64(1)


_grow_powers(64)


def words(texts, punctuation: bool = True):
    """For each text, the hashes of its words in order.

    A-Z count as a-z; words end at space, tab, line feed, vertical tab, form feed and carriage
    return, and without ``punctuation`` at every ASCII punctuation mark.  A null text has none.
    """
    for raws in _blocks(texts):
        hashes, counts = _hash_block(raws, _WHITE if punctuation else _APART)
        yield from np.split(hashes, np.cumsum(counts)[:-1])


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; with fewer words the whole sequence is one run."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(width, n)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        out = mix(out * _SEED + hashes[k:n - width + 1 + k])
    return out


def shingle_sets(texts, width: int):
    """For each text, its distinct shingles as a sorted array of unsigned 64-bit hashes."""
    for hashes in words(texts):
        yield np.unique(shingles(hashes, width))
