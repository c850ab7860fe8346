"""Content-defined phrases of a text's bytes, and hashes of its 400-byte windows, in numpy."""

from __future__ import annotations

import numpy as np

from periodica.llm.setsketch import GOLDEN, Powers, mixed

U = np.uint64
LENGTH = 400
GRAM, WINDOW = 16, 128
#: A phrase boundary lies at most so far behind the start of a repeat, and so far before its end.
BEFORE, BEHIND = WINDOW - 1, WINDOW + GRAM - 1

BYTE = mixed((np.arange(256, dtype=U) + U(1)) * U(GOLDEN) + U(7))
BYTE2 = mixed(BYTE + U(GOLDEN))
POWERS, POWERS2 = Powers(), Powers(0x2545F4914F6CDD1D)


def sums(raw: np.ndarray, values: np.ndarray = BYTE, powers: Powers = POWERS) -> np.ndarray:
    """Prefix sums of byte values times powers; differences of them hash any piece of the text."""
    powers.need(len(raw) + 1)
    total = np.zeros(len(raw) + 1, U)
    np.cumsum(values[raw] * powers.up[: len(raw)], dtype=U, out=total[1:])
    return total


def pieces(total: np.ndarray, start, end, powers: Powers = POWERS) -> np.ndarray:
    return mixed((total[end] - total[start]) * powers.down[start])


def boundaries(raw: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The places that hold the least 16-byte hash, the last of equals, of any 128 places in a row.

    Equal pieces of text have the same boundaries from the first to the last window inside them, and
    there is one in every window."""
    n = len(raw) - GRAM + 1
    if n < WINDOW:
        return np.zeros(0, np.int64)
    # slices, as every place is taken
    key = total[GRAM : GRAM + n] - total[:n]
    key *= POWERS.down[:n]
    # the upper half alone is compared: one round mixes it
    key ^= key >> U(32)
    key *= U(0xBF58476D1CE4E5B9)
    key &= U(0xFFFFFFFF00000000)
    key |= U(0xFFFFFFFF) - np.arange(n, dtype=U)
    blocks = -(-n // WINDOW)
    padded = np.full(blocks * WINDOW, np.iinfo(np.uint64).max, U)
    padded[:n] = key
    grid = padded.reshape(blocks, WINDOW)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[: n - WINDOW + 1], left[WINDOW - 1 : n])
    least = least[np.concatenate(([True], least[1:] != least[:-1]))]
    place = (U(0xFFFFFFFF) - (least & U(0xFFFFFFFF))).astype(np.int64)
    return place


def phrases(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, name) of the phrases between neighbouring boundaries of a text."""
    raw = np.frombuffer(text, np.uint8)
    if len(raw) < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    total = sums(raw)
    cut = boundaries(raw, total)
    name = pieces(total, cut[:-1], cut[1:]) + np.diff(cut).astype(U)
    return cut[:-1], np.diff(cut), name.view(np.int64)


class Windows:
    """Two independent 64-bit hashes of pieces of one text."""

    def __init__(self, text: bytes) -> None:
        raw = np.frombuffer(text, np.uint8)
        self.sums = sums(raw), sums(raw, BYTE2, POWERS2)

    def one(self, starts: np.ndarray, size: int) -> np.ndarray:
        return pieces(self.sums[0], starts, starts + size).view(np.int64)

    def two(self, starts: np.ndarray, size: int) -> np.ndarray:
        return pieces(self.sums[1], starts, starts + size, POWERS2).view(np.int64)


class Covers:
    """Hashes of whole phrases from one place on, over the rows of many texts in order; `run` numbers
    the strings of neighbouring phrases."""

    def __init__(self, name: np.ndarray, length: np.ndarray, run: np.ndarray) -> None:
        self.run, self.n = run, len(name)
        self.end = np.cumsum(length)
        self.begin = self.end - length
        names = mixed(name.view(U))
        self.totals = []
        for powers, salt in ((POWERS, 3), (POWERS2, 5)):
            powers.need(self.n + 1)
            total = np.zeros(self.n + 1, U)
            np.cumsum(mixed(names + U(salt)) * powers.up[: self.n], dtype=U, out=total[1:])
            self.totals.append((total, powers))

    def key(self, size: int, before: int = 0, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Per phrase, the hash of the phrases that cover `size` bytes from its start and, where
        asked for, `before` bytes in front of it, and of how far in front the first of them begins; and
        whether its string has them."""
        last = np.searchsorted(self.end, self.begin + size)
        whole = last < self.n
        last = np.minimum(last, self.n - 1)
        first = np.searchsorted(self.begin, self.begin - before, side="right") - 1
        whole &= first >= 0
        first = np.maximum(first, 0)
        whole &= (self.run[last] == self.run) & (self.run[first] == self.run)
        total, powers = self.totals[which]
        key = pieces(total, first, last + 1, powers)
        if before:
            # neighbouring phrases may have the same phrases around
            key = mixed(key + (self.begin - self.begin[first]).astype(U) * U(GOLDEN))
        return key.view(np.int64), whole
