"""Words of many texts at once: bounds and 64-bit hashes as numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

U64 = np.uint64
#: Seed of every fixed random constant here.
SEED = 20_011
#: Bytes that part a text into pieces, which no phrase crosses.
PIECE_ENDS = tuple(b".,;:!?\x0a\x0b\x0c\x0d")
BASE = 0x9E3779B97F4A7C15 | 3  # 3 mod 4, so 1 - BASE**d keeps most bits


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every bit (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def constants(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed odd 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(BASE) + U64(SEED + 7919 * salt)) | U64(1)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(n, base, U64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(BASE), run(pow(BASE, -1, 1 << 64))


@lru_cache(maxsize=4)
def _tables(kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and a random value per byte (A-Z as a-z)."""
    b = np.arange(256)
    if kind == "spaced":  # [^\x20\x09-\x0D]+
        member = ~((b == 0x20) | ((b >= 0x09) & (b <= 0x0D)))
    elif kind == "plain":  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
        member = (b >= 0x80) | ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x41) & (b <= 0x5A)) | ((b >= 0x61) & (b <= 0x7A))
    elif kind == "pieces":  # [^\x20\x09]+ within pieces between [.,;:!?\x0A-\x0D]
        member = ~(np.isin(b, [0x20, *PIECE_ENDS]) | (b == 0x09))
    else:
        raise ValueError(kind)
    value = constants(256)
    value[0x41:0x5B] = value[0x61:0x7B]
    return member, value


@dataclass
class Words:
    """Words of a slice of texts: byte bounds, hash, and ``of[i]:of[i + 1]`` per text."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    of: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    def texts(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.of) - 1), self.counts())


def split(data: np.ndarray, bounds: np.ndarray, kind: str) -> Words:
    """Words of the texts ``data[bounds[i]:bounds[i + 1]]``; A-Z hash as a-z."""
    member, value = _tables(kind)
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = member[data]
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    power, back = _powers(1 << max(20, int(n).bit_length()))
    sums = np.zeros(n + 1, U64)
    np.cumsum(value[data] * power[:n], out=sums[1:])
    return Words(start, end, mix((sums[end] - sums[start]) * back[start]), np.searchsorted(start, bounds))


def grams(words: Words, offsets: tuple[int, ...], salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the words at ``i + offsets`` for each word ``i`` whose text reaches that
    far, and those ``i``."""
    span = offsets[-1] + 1
    n = len(words.hash) - span + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    total = np.zeros(n, U64)
    for o, c in zip(offsets, constants(len(offsets), salt + 1), strict=True):
        total += words.hash[o : o + n] * c
    text = words.texts()
    at = np.flatnonzero(text[:n] == text[span - 1 : span - 1 + n])
    return mix(total[at] + U64(len(offsets))), at
