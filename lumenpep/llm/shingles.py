"""Sets of word shingles as 64-bit hashes, for a block of texts at once in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that makes every bit depend on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_PLACE = mix(np.arange(1001, 1065, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = _powers(256)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the text, A-Z in lower case, and where the words start."""
    raw = np.frombuffer(data, dtype=np.uint8)
    word = ~_SPACE[raw]
    edge = np.diff(word.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, lengths = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = lengths - starts
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    most = int(lengths.max())
    powers = _POWERS if most <= len(_POWERS) else _powers(most)
    sums = np.add.reduceat(_BYTE[_LOWER[raw[word]]] * powers[place], first)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)), starts


def _sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    hashes, starts = word_hashes(b"\n".join(parts))
    offsets = np.cumsum([0] + [len(p) + 1 for p in parts])
    cut = np.searchsorted(starts, offsets)
    n = len(hashes) - size + 1
    grams = mix(sum(hashes[i : i + n] * _PLACE[i] for i in range(size))) if n > 0 else hashes[:0]
    for low, high in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if high - low >= size:
            yield np.unique(grams[low : high - size + 1])
        elif high > low:
            yield mix((hashes[low:high] * _PLACE[: high - low]).sum(keepdims=True) + np.uint64(high - low))
        else:
            yield hashes[:0]


def shingle_sets(texts: Iterable[str | None], size: int = 5, block: int = 1_000_000) -> Iterator[np.ndarray]:
    """The sorted set of each text: hashes of its runs of `size` words; of all its words where it has fewer; empty where
    it has none. Texts are hashed in blocks of about `block` characters; a text is never cut."""
    held, length = [], 0
    for text in texts:
        held.append(text or "")
        length += len(held[-1])
        if length >= block:
            yield from _sets(held, size)
            held, length = [], 0
    if held:
        yield from _sets(held, size)
