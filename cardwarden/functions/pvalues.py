"""p-values of finished test statistics.

All functions run on one row per feature or per report, never on transactions.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ks_asymptotic(d: Column, n: Column, m: Column) -> Column:
    """Kolmogorov tail series with the usual small-sample factor, JVM-side."""
    en = (n.cast("double") * m) / (n.cast("double") + m)
    lam = (F.sqrt(en) + 0.12 + 0.11 / F.sqrt(en)) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    tail = F.least(F.greatest(series * 2.0, F.lit(0.0)), F.lit(1.0))
    # Near zero the truncated series does not converge; the tail is one there.
    return F.when(lam < 0.3, F.lit(1.0)).otherwise(tail)


#: Steps of the walk that one stored matrix takes; only time depends on it.
STRIDE = 64
#: Stored matrices of one walk. A border is a line, so it has little more than ``STRIDE`` shapes within a stride.
MOST_MATRICES = 1000


def _convolve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if min(len(a), len(b)) <= 2 * STRIDE:
        return np.convolve(a, b)
    size = len(a) + len(b) - 1
    padded = 1 << (size - 1).bit_length()
    return np.fft.irfft(np.fft.rfft(a, padded) * np.fft.rfft(b, padded), padded)[:size]


def _stirling_rest(x: int) -> float:
    """``log(x!)`` without the leading terms of Stirling's formula."""
    if x < 32:
        return math.lgamma(x + 1) - (x * math.log(x) - x + 0.5 * math.log(2 * math.pi * x))
    return 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


class _Corridor:
    """A walk of ``n + m`` steps that goes up with chance ``n / (n + m)`` and ends at a border.

    Positions ``i`` are allowed after ``s`` steps while ``|i * (n + m) - s * n| < limit``. Only positions within reach
    of a border need its course: the others take all steps at once, by a convolution, and the rest goes on
    in two halves, down to ``STRIDE`` steps.
    """

    def __init__(self, n: int, m: int, limit: int):
        self.n, self.total, self.limit, self.up = n, n + m, limit, n / (n + m)
        self.ahead = np.arange(1, STRIDE + 1, dtype=np.int64)
        self.kernels: dict[int, np.ndarray] = {}
        self.matrices: dict[tuple, tuple[int, np.ndarray]] = {}

    def low(self, s):
        return (s * self.n - self.limit) // self.total + 1

    def high(self, s):
        return -((-s * self.n - self.limit) // self.total) - 1

    def step(self, chances: np.ndarray) -> np.ndarray:
        """One step of a state (or of several, as columns) whose last position is empty."""
        moved = chances * (1.0 - self.up)
        moved[1:] += chances[:-1] * self.up
        return moved

    def kernel(self, steps: int) -> np.ndarray:
        """Chances of 0 to ``steps`` steps up; ``steps`` is a power of two."""
        if steps not in self.kernels:
            half = self.kernel(steps // 2) if steps > 1 else None
            k = np.array([1.0 - self.up, self.up]) if half is None else _convolve(half, half)
            self.kernels[steps] = k / k.sum()
        return self.kernels[steps]

    def stride(self, start: int, size: int, s: int) -> tuple[int, np.ndarray]:
        """The first allowed position after ``STRIDE`` steps, from ``start``, and the matrix that takes them."""
        lows = np.maximum(self.low(s + self.ahead) - start, 0)
        highs = np.minimum(self.high(s + self.ahead) - start, size - 1 + self.ahead)
        key = (size, lows.tobytes(), highs.tobytes())
        if key not in self.matrices:
            if len(self.matrices) >= MOST_MATRICES:
                self.matrices.clear()
            state = np.zeros((size + STRIDE, size))
            state[:size] = np.eye(size)
            for low, high in zip(lows, highs):
                state = self.step(state)
                state[:low] = 0.0
                state[high + 1 :] = 0.0
            self.matrices[key] = int(lows[-1]), np.ascontiguousarray(state[lows[-1] : highs[-1] + 1])
        return self.matrices[key]

    def advance(self, start: int, chances: np.ndarray, s: int, steps: int) -> tuple[int, np.ndarray]:
        """The state ``steps`` steps after step ``s``: its first position and the chances from there on."""
        if steps == STRIDE:
            first, matrix = self.stride(start, len(chances), s)
            return start + first, matrix @ chances
        half, bottom, top = steps // 2, self.low(s + steps), self.high(s + steps)
        # From a up to b no border can be reached.
        a, b = max(bottom - start, 0), min(top - steps - start + 1, len(chances))
        if b - a < half:
            return self.advance(*self.advance(start, chances, s, half), s + half, half)
        first = max(bottom, start)
        out = np.zeros(min(top, start + len(chances) - 1 + steps) - first + 1)
        parts = [(start + a, _convolve(chances[a:b], self.kernel(steps)))]
        for at, near in ((start, chances[:a]), (start + b, chances[b:])):
            if len(near):
                parts.append(self.advance(*self.advance(at, near, s, half), s + half, half))
        for at, part in parts:
            out[at - first : at - first + len(part)] += part
        return first, out

    def ends_at(self, end: int) -> float:
        """Chance of ending at ``end`` without having left the corridor."""
        start, chances, s, steps = 0, np.ones(1), 0, STRIDE
        while 4 * steps <= self.high(0) - self.low(0):
            steps *= 2
        while self.total - s >= STRIDE:
            while steps > self.total - s:
                steps //= 2
            start, chances = self.advance(start, chances, s, steps)
            s += steps
        for s in range(s + 1, self.total + 1):
            moved, low = self.step(np.append(chances, 0.0)), max(self.low(s) - start, 0)
            start, chances = start + low, moved[low : max(self.high(s) - start + 1, low)]
        return float(chances[end - start]) if 0 <= end - start < len(chances) else 0.0


def ks_exact_tail(d: float, n: int, m: int) -> float:
    """P(D >= d) when both samples share one distribution and have no common values.

    All merge orders of ``n`` and ``m`` values are equally likely: they are the walks of ``n + m`` independent steps,
    up for a value of the first sample, that end after ``n`` steps up. The distribution functions stay closer than
    ``d`` while the walk stays between two lines. Time grows with the number of values, little more; rounding errors
    stay near 1e-12.
    """
    n, m = min(n, m), max(n, m)  # the event is symmetric
    limit, total = round(d * n * m), n + m
    if limit <= 0:
        return 1.0
    # Serfling's bound for a step (twice, for both borders), added up over all steps: below it the tail vanishes in 1 - inside.
    if 2.0 * total * math.exp(-8.0 * (limit / total) ** 2 * total / (total + 1) ** 2) < 1e-17:
        return 0.0
    free = math.exp(0.5 * math.log(total / (2 * math.pi * n * m)) + _stirling_rest(total) - _stirling_rest(n) - _stirling_rest(m))
    inside = _Corridor(n, m, limit).ends_at(n) / free
    return float(min(1.0, max(0.0, 1.0 - inside)))


@F.pandas_udf(T.DoubleType())
def ks_exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([ks_exact_tail(*row) for row in zip(d, n.astype(int), m.astype(int))])


def chi2_tail(x: float, df: int) -> float:
    """Upper tail of the chi-square distribution for a whole number of degrees of freedom.

    Stepping the degrees of freedom by two adds one term, starting from the closed forms for one
    and two degrees.
    """
    if df <= 0 or x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    half = x / 2.0
    start = 1.0 if df % 2 == 0 else 0.5
    base = math.exp(-half) if df % 2 == 0 else math.erfc(math.sqrt(half))
    shapes = np.arange(start, df / 2.0)
    if shapes.size == 0:
        return base
    log_first = start * math.log(half) - half - math.lgamma(start + 1.0)
    steps = np.log(half) - np.log(shapes[1:] + 0.0)
    log_terms = log_first + np.concatenate([[0.0], np.cumsum(steps)])
    return float(min(1.0, base + np.exp(log_terms).sum()))


@F.pandas_udf(T.DoubleType())
def chi2_sf(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_tail(float(a), int(b)) for a, b in zip(x, df)])


def binomial_two_sided(k: int, n: int, p0: float) -> float:
    """Total probability of all outcomes that are no likelier than ``k`` successes in ``n``.

    Neighbouring outcome ratios are accumulated outwards from the mode, so nothing of the size of
    ``n!`` is ever formed. Outcomes beyond forty standard deviations weigh less than 1e-300.
    """
    if n == 0:
        return 1.0
    if p0 <= 0.0 or p0 >= 1.0:
        return 1.0 if k == round(n * p0) else 0.0
    mode = min(n, int((n + 1) * p0))
    reach = int(40 * math.sqrt(n * p0 * (1 - p0))) + 60
    low, high = max(0, mode - reach), min(n, mode + reach)
    if not low <= k <= high:
        return 0.0
    odds = math.log(p0) - math.log1p(-p0)
    up = np.arange(mode, high, dtype=np.float64)
    down = np.arange(mode, low, -1, dtype=np.float64)
    log_up = np.cumsum(np.log(n - up) - np.log(up + 1) + odds)
    log_down = np.cumsum(np.log(down) - np.log(n - down + 1) - odds)
    logs = np.concatenate([log_down[::-1], [0.0], log_up])
    weights = np.exp(logs)
    ceiling = weights[k - low] * (1 + 1e-7)
    return float(min(1.0, weights[weights <= ceiling].sum() / weights.sum()))


@F.pandas_udf(T.DoubleType())
def binomial_p(k: pd.Series, n: pd.Series, p0: pd.Series) -> pd.Series:
    return pd.Series([binomial_two_sided(int(a), int(b), float(c)) for a, b, c in zip(k, n, p0)])
