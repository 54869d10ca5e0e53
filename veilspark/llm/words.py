"""Words and hashes used inside tasks (numpy); every function takes whole texts."""

from __future__ import annotations

import numpy as np

#: kinds of bytes: white space, signs, and word bytes (ASCII letters, digits, _, and all of a non-ASCII character)
SPACE, SIGN, WORD = 0, 1, 2
KIND = np.full(256, SIGN, dtype=np.int8)
KIND[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = SPACE
KIND[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = WORD

_P = 0x9DDFEA08EB382D69
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` or more powers, modulo 2^64, of an odd number and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        made = []
        for factor in (_P, pow(_P, -1, 1 << 64)):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps))
        _powers[:] = made
    return _powers[0], _powers[1]


class Tokens:
    """Words, and runs of other signs, of a whole text: byte offsets, and 64-bit hashes of any byte ranges."""

    def __init__(self, text: str, signs: bool = True, lower: bool = True):
        self.bytes = np.frombuffer((text.lower() if lower else text).encode("utf-8", "surrogatepass"), dtype=np.uint8)
        kind = KIND[self.bytes]
        if not signs:
            kind = np.where(kind == SIGN, SPACE, kind)
        edge = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1], [True]])) if len(kind) else np.zeros(1, int)
        kinds = kind[edge[:-1]]
        held = kinds != SPACE
        self.start, self.end, self.is_word = edge[:-1][held], edge[1:][held], kinds[held] == WORD
        power, _ = _power(len(kind) + 1)
        self.sums = np.zeros(len(kind) + 1, dtype=np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * power[:len(kind)], out=self.sums[1:])

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """uint64 hash of each range (of each token): equal bytes have equal hashes wherever they stand."""
        start = self.start if start is None else start
        end = self.end if end is None else end
        _, inverse = _power(len(self.bytes) + 1)
        return mix((self.sums[end] - self.sums[start]) * inverse[start])


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (murmur3's constants) on uint64 arrays."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def distinct(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct numbers and their counts (np.unique without its index work)."""
    if not len(at):
        return at, np.empty(0)
    at = np.sort(at)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], np.diff(np.append(first, len(at))).astype(float)
