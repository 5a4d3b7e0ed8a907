"""md5 of many short strings at once, each of one block."""

from __future__ import annotations

import numpy as np

_K = [int(abs(np.sin(np.longdouble(i + 1))) * 2**32) for i in range(64)]
_S = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_G = [*range(16), *((5 * i + 1) % 16 for i in range(16)), *((3 * i + 5) % 16 for i in range(16)), *(7 * i % 16 for i in range(16))]


def md5_first(words: list[np.ndarray | int], size: int) -> np.ndarray:
    """The first 8 bytes of md5, as numbers in the order of its hexadecimal form, for strings of `size` bytes, 55 at most: their bytes as little-endian
    words, with the byte 0x80 after the end."""
    words = [*words, *[0] * (14 - len(words)), 8 * size, 0]
    of = np.broadcast_arrays(*(np.asarray(w, dtype=np.uint32) for w in words if not isinstance(w, int)))[0]
    start = [0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476]
    a, b, c, d = (np.full(of.shape, x, dtype=np.uint32) for x in start)
    t, u = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=t)
            np.bitwise_and(t, b, out=t)
            np.bitwise_xor(t, d, out=t)
        elif i < 32:
            np.bitwise_xor(b, c, out=t)
            np.bitwise_and(t, d, out=t)
            np.bitwise_xor(t, c, out=t)
        elif i < 48:
            np.bitwise_xor(b, c, out=t)
            np.bitwise_xor(t, d, out=t)
        else:
            np.invert(d, out=t)
            np.bitwise_or(t, b, out=t)
            np.bitwise_xor(t, c, out=t)
        word = words[_G[i]]
        known = isinstance(word, int)
        np.add(t, a, out=t)
        np.add(t, np.uint32((_K[i] + (word if known else 0)) & 0xFFFFFFFF), out=t)
        if not known:
            np.add(t, word, out=t)
        np.left_shift(t, np.uint32(_S[i]), out=u)
        np.right_shift(t, np.uint32(32 - _S[i]), out=t)
        np.bitwise_or(t, u, out=t)
        np.add(t, b, out=t)
        a, d, c, b, t = d, c, b, t, a
    a, b = a + np.uint32(start[0]), b + np.uint32(start[1])
    return (a.byteswap().astype(np.uint64) << np.uint64(32)) | b.byteswap()
