"""The seeded draws of ``draws.draw`` over whole arrays, for functions that run inside tasks."""

from __future__ import annotations

import hashlib
import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_TEXT = 55  # bytes of a text whose MD5 is one block
AT_ONCE = 16384
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
# By the bytes of the text left for a word, -1 for a word behind its end: what is kept of four bytes, and the mark behind the text.
KEPT = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF, 0], np.uint32)
MARK = np.array([0x80, 0x8000, 0x800000, 0x80000000, 0, 0], np.uint32)
TURNS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]


def first_words(words: np.ndarray) -> np.ndarray:
    """First four bytes, as a big-endian integer, of the MD5 of one-block messages in columns."""
    n, used = words.shape[1], words.any(axis=1)
    a, b, c, d = (np.full(n, v, np.uint32) for v in START)
    for i in range(64):
        kind = i // 16
        if kind == 0:
            mix, word = c ^ d, i
            mix &= b
            mix ^= d
        elif kind == 1:
            mix, word = b ^ c, (5 * i + 1) % 16
            mix &= d
            mix ^= c
        elif kind == 2:
            mix, word = b ^ c, (3 * i + 5) % 16
            mix ^= d
        else:
            mix, word = ~d, 7 * i % 16
            mix |= b
            mix ^= c
        mix += a
        mix += SINES[i]
        if used[word]:
            mix += words[word]
        turn = TURNS[kind][i % 4]
        high = mix << np.uint32(turn)
        mix >>= np.uint32(32 - turn)
        high |= mix
        high += b
        a, d, c, b = d, c, b, high
    a += np.uint32(START[0])
    return a.byteswap().astype(np.int64)


def words_of(text: pa.Array) -> np.ndarray | None:
    """Messages of the texts in columns; None where a text takes more than one block."""
    sizes = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    widest = int(sizes.max())
    if widest > BLOCK_TEXT:
        return None
    _, offsets, data = text.buffers()
    starts = np.frombuffer(offsets, np.int32, len(text), text.offset * 4)
    held = np.zeros(int(sizes.sum()) + 64, np.uint8)
    held[: len(held) - 64] = np.frombuffer(data, np.uint8)[starts[0] : starts[0] + len(held) - 64] if widest else 0
    here = starts - starts[0]
    fours = np.ndarray(len(held) - 3, "<u4", held, strides=(1,)).copy()  # the four bytes from every place on
    words = np.zeros((16, len(text)), np.uint32)
    for k in range(widest // 4 + 1):
        left = np.clip(sizes - 4 * k, -1, 4)
        np.bitwise_and(fours[here + 4 * k], KEPT[left], out=words[k])
        words[k] |= MARK[left]
    words[14] = sizes * 8
    return words


def _digests(text: pa.Array) -> np.ndarray:
    words = words_of(text)
    if words is None:
        return np.array([int.from_bytes(hashlib.md5(t.encode()).digest()[:4], "big") for t in text.to_pylist()], np.int64)
    return first_words(words)


def draws(seed: str, *parts: pa.Array | pa.Scalar) -> np.ndarray:
    """What ``draw(seed, *parts)`` gives for every row; the parts are texts, and NULL ones are left out as there.

    The first part is an array, another may be one text for all rows.
    """
    out = [np.zeros(0, np.int64)]
    for at in range(0, len(parts[0]), AT_ONCE):
        texts = [p if isinstance(p, pa.Scalar) else p.slice(at, AT_ONCE).cast(pa.string()) for p in parts]
        out.append(_digests(pc.binary_join_element_wise(pa.scalar(seed), *texts, "|", null_handling="skip")))
    return np.concatenate(out)
