"""Word shingles of a text and their SetSketch, in numpy.

A SetSketch has `m` registers. Every element of a set sends a Poisson stream of points to random
registers; register i keeps its least point x_i, which is exponential with the set's size, as
`floor(1 - log_b(x_i / a))`, truncated to 16 bits. Registers of a union are the maxima of the parts'.
Two registers are equal with a probability close to the resemblance of the sets, so bands of them
find similar sets, and the numbers of greater, lesser and equal registers give the likelihood of any
resemblance J given the sizes of the two sets.
"""

from __future__ import annotations

import hashlib

import numpy as np

BASE, RATE, TOP = 1.001, 20.0, 65535
ROWS, BANDS = 5, 40
M = ROWS * BANDS
U = np.uint64

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
FACTOR = 0x5851F42D4C957F2D
GOLDEN = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _byte_values() -> np.ndarray:
    own = np.arange(256)
    own[ord("A") : ord("Z") + 1] += 32
    return mixed((own + 1).astype(U) * U(GOLDEN))


BYTE = _byte_values()


class Powers:
    """Powers of an odd factor and of its inverse modulo 2**64, as many as the longest text needs."""

    def __init__(self, factor: int = FACTOR) -> None:
        self.factor = factor
        self.up = self.down = np.ones(1, U)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up), 1 << 14)
            back = pow(self.factor, -1, 1 << 64)
            steps = np.full(n, self.factor, U), np.full(n, back, U)
            for step in steps:
                step[0] = 1
            self.up, self.down = (np.cumprod(step, dtype=U) for step in steps)


POWERS = Powers()


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """Sorted different hashes of the `size`-word shingles; all words as one if there are fewer."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.concatenate(([False], ~BLANK[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edges):
        return np.zeros(0, U)
    start, end = edges[::2], edges[1::2]
    POWERS.need(len(raw))
    total = np.concatenate((np.zeros(1, U), np.cumsum(BYTE[raw] * POWERS.up[: len(raw)], dtype=U)))
    words = mixed((total[end] - total[start]) * POWERS.down[start] + (end - start).astype(U))
    wide = min(size, len(words))
    n = len(words) - wide + 1
    out = words[:n]
    for i in range(1, wide):
        out = mixed(out * U(GOLDEN) + words[i : i + n])
    return np.unique(out + U(wide))


def set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def least_points(hashes: np.ndarray, m: int = M) -> np.ndarray:
    """The least point of each register, over all elements. Points beyond a guessed limit can't
    matter once every register has one below it; else the limit grows."""
    n = len(hashes)
    limit = (np.log(m) + 3) / n
    while True:
        least = np.full(m, np.inf)
        at, rows, first = np.zeros(n), hashes, 0
        while len(rows):
            mean = max(0.0, m * limit - first / n)
            width = int(mean + 2 * np.sqrt(mean) + 2)
            steps = (np.arange(first, first + width, dtype=U) + U(1)) * U(GOLDEN)
            random = mixed(rows[:, None] + steps)
            unit = ((random >> U(12)).astype(float) + 0.5) * 2.0**-52
            points = at[:, None] + np.cumsum(-np.log(unit), axis=1) / m
            near = points <= limit
            register = (mixed(random[near] ^ U(FACTOR)) >> U(32)) * U(m) >> U(32)
            np.minimum.at(least, register.astype(np.int64), points[near])
            on = near[:, -1]
            at, rows, first = points[on, -1], rows[on], first + width
        if np.isfinite(least).all():
            return least
        limit *= 2


def registers(hashes: np.ndarray, m: int = M) -> np.ndarray:
    """The SetSketch of a set that isn't empty."""
    value = np.floor(1 - np.log(least_points(hashes, m) / RATE) / np.log(BASE))
    return np.clip(value, 0, TOP).astype(np.uint16)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One key per row and band; its low six bits are the band's number."""
    parts = sketches.reshape(len(sketches), BANDS, ROWS).astype(U)
    out = np.zeros(parts.shape[:2], U)
    for i in range(ROWS):
        out = mixed(out * U(GOLDEN) + parts[:, :, i] + U(1))
    band = np.arange(BANDS, dtype=U)
    return ((mixed(out + band * U(FACTOR)) << U(6)) | band).view(np.int64)


def _share(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(above, below, equal, n_a, n_b, j) -> np.ndarray:
    """Of resemblance j, given how many registers of a are above, below and equal to b's."""
    u = n_a / (n_a + n_b)
    up, down = _share(u - (1 - u) * j), _share((1 - u) - u * j)
    tiny = 1e-12
    same = np.clip(1 - up - down, tiny, 1)
    return (
        above * np.log(np.maximum(up, tiny))
        + below * np.log(np.maximum(down, tiny))
        + equal * np.log(same)
    )


GRID = np.linspace(0, 1, 201)


def plausible(above, below, n_a, n_b, least: float, sigmas: float = 5.0, m: int = M):
    """Estimates of the resemblance, and which pairs may reach `least`: their best value does, or
    `least` itself is no less likely than `sigmas` standard deviations off."""
    above, below, n_a, n_b = (np.asarray(x, float)[:, None] for x in (above, below, n_a, n_b))
    equal = m - above - below
    most = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    score = log_likelihood(above, below, equal, n_a, n_b, np.minimum(GRID, most))
    best = score.argmax(1)
    at_least = log_likelihood(above, below, equal, n_a, n_b, np.minimum(least, most))[:, 0]
    estimate = np.minimum(GRID[best], most[:, 0])
    near = 2 * (score.max(1) - at_least) <= sigmas**2
    return estimate, (most[:, 0] >= least) & ((estimate >= least) | near)
