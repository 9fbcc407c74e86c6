"""Hashes of many pieces of one byte array, by running sums."""

from __future__ import annotations

import functools

import numpy as np

BASE = 0x9E3779B97F4A7C15
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=8)
def byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(256, dtype=np.uint64) * np.uint64(BASE) + np.uint64((seed + 1) * 0x632BE59BD9B4E019 % 2**64))


# Powers kept for the next batch, of each of a few bases; longer ones are made again.
KEPT_POWERS = 1 << 20
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, KEPT_POWERS), base, np.uint64)
        out[:1] = 1
        have = np.multiply.accumulate(out)
        if len(have) == KEPT_POWERS:
            _powers[base] = have
    return have[:n]


class Pieces:
    """Polynomial hashes of any pieces [start, end) of the data.

    Modulo 2 ** 64 some long periodic pieces collide under every base (a Thue-Morse word of 1 024 bytes and
    its complement), so this is for pieces of some hundred bytes; ``digests`` has no such pairs.
    """

    def __init__(self, data: np.ndarray, seed: int = 0):
        base = (BASE + 2 * seed * 0x1000193) | 1
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(byte_values(seed)[data] * powers(base, n), out=self.sums[1:])
        self.back = powers(pow(base, -1, 2**64), n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit digests of the pieces [start, end), which may be empty but not many times longer than the data.

    A piece is read as words of eight bytes; each is mixed together with its place before they are added, so
    that the digest is no polynomial in the bytes, under which long periodic pieces could meet.
    """
    size = (end - start).astype(np.int64)
    parts = np.maximum(-(-size // 8), 1)
    last = np.cumsum(parts)
    place = np.arange(last[-1] if len(last) else 0) - np.repeat(last - parts, parts)
    at = np.repeat(start, parts) + place * 8
    rest = np.repeat(size, parts) - place * 8
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[at].view("<u8")[:, 0]
    bits = np.minimum(rest, 8).astype(np.uint64) * np.uint64(8)
    # A shift by 64 is undefined: whole words keep all their bits, empty pieces none.
    words &= np.where(rest >= 8, np.uint64(2**64 - 1), (np.uint64(1) << (bits & np.uint64(63))) - np.uint64(1))
    salt = mix(place.astype(np.uint64) * np.uint64(BASE) + np.uint64((seed + 1) * 0x632BE59BD9B4E019 % 2**64))
    mixed = mix(mix(words ^ salt) + salt)
    sums = np.add.reduceat(mixed, last - parts) if len(mixed) else mixed
    return mix(sums + size.astype(np.uint64) * np.uint64(BASE))
