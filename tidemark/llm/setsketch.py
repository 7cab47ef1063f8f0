"""SetSketch registers of word shingles, and what two sketches say of two sets.

Register i of a set holds floor(1 - log_b x) for the least of the exponential
values that the set's elements have there: exponentially spaced, so a small
integer, and the register of a union is the larger of the two.  An element's
values ascend over the registers in an order of its own, so all values beyond a
bound that no register's minimum exceeds need not be drawn.
"""

from __future__ import annotations

import functools

import numpy as np

M = 256                 # registers
BASE = 1.02             # two registers of disjoint sets of one size agree in about 1 of 100 cases
RATE = 20.0
SHINGLE = 5

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (all bits depend on all bits)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i < n."""
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def forget() -> None:
    """Drop the tables of powers, which grow with the longest text."""
    _powers.cache_clear()


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of UTF-8 texts laid end to end (A-Z lower-cased), and the text it is in."""
    data = _LOWER[data]
    inner = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[ends[ends <= len(data)]] = True
    cut[0] = True
    starts = np.flatnonzero(inner & (cut[:-1] | ~np.r_[False, inner[:-1]]))
    stops = np.flatnonzero(inner & (cut[1:] | ~np.r_[inner[1:], False])) + 1
    room = 1 << max(20, int(len(data)).bit_length())
    out = np.zeros(len(starts), np.uint64)
    for base in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        up, down = _powers(base, room)
        sums = np.r_[_U(0), np.cumsum((data.astype(np.uint64) + _U(1)) * down[:len(data)])]
        out = mix(out + (sums[stops] - sums[starts]) * up[starts] + _U(base))
    return out, np.searchsorted(ends, starts, "right")


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Distinct hashes of the shingles of one text's words; fewer words than a shingle are one."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    size = min(n, SHINGLE)
    out = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        out = out * _U(0x9FB21C651E98DF25) + words[k:n - size + 1 + k]
    return np.unique(mix(out))


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (uint16, a row of M for each set) of sets of distinct hashes."""
    least = np.full((len(sets), M), np.inf)
    todo, slack = np.array([i for i, s in enumerate(sets) if len(s)], np.int64), np.log(M) + 6.0
    while len(todo):
        # Most sets' registers all have their minimum below the bound; the others are done again.
        sizes = np.array([len(sets[i]) for i in todo])
        bound = np.repeat(slack / (RATE * sizes), sizes)
        row, h = np.repeat(todo, sizes), np.concatenate([sets[i] for i in todo])
        step, at = (mix(h + _U(1)) >> _U(56)) | _U(1), mix(h + _U(2)) >> _U(56)     # odd step: a permutation
        x, flat = np.zeros(len(h)), least.reshape(-1)
        for j in range(M):
            u = ((mix(h + _U((j + 3) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> _U(11)).astype(float) + 0.5) * 2.0 ** -53
            x = x - np.log(u) / (RATE * (M - j))
            on = x <= bound
            if not on.all():
                x, h, row, step, at, bound = x[on], h[on], row[on], step[on], at[on], bound[on]
            if not len(h):
                break
            at = (at + step) & _U(M - 1)
            np.minimum.at(flat, row * M + at.astype(np.int64), x)
        todo, slack = todo[np.isinf(least[todo]).any(1)], slack * 4
    with np.errstate(divide="ignore", invalid="ignore"):
        k = np.floor(1 - np.log(least) / np.log(BASE))
    return np.clip(np.nan_to_num(k, neginf=0.0), 0, 65535).astype(np.uint16)


_GRID = np.linspace(0.0, 1.0, 129)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def jaccard(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sketches of sets with known sizes (rows of a against rows of b).

    The counts of registers that are larger in a, in b, or equal are jointly
    multinomial, with probabilities that follow from the sizes and the similarity.
    """
    more, less = (a > b).sum(1), (a < b).sum(1)
    u = (size_a / (size_a + size_b))[:, None]
    j = _GRID[None] * np.minimum(u / (1 - u), (1 - u) / u)          # up to the largest these sizes allow
    p, q = _p(np.clip(u - (1 - u) * j, 0, 1)), _p(np.clip((1 - u) - u * j, 0, 1))
    tiny = 1e-12
    fit = (more[:, None] * np.log(p + tiny) + less[:, None] * np.log(q + tiny)
           + (a.shape[1] - more - less)[:, None] * np.log(np.clip(1 - p - q, tiny, None)))
    best = fit.argmax(1)
    return np.take_along_axis(j, best[:, None], 1)[:, 0]
