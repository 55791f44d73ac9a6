"""Lasso on moment matrices: small numpy helpers used inside tasks.

For 1/(2n) * RSS + alpha * |w|_1 with intercept everything needed is in the
centred moments C = Xc'Xc/n, c = Xc'yc/n and v = yc'yc/n.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TOLERANCE = 1e-7


@dataclass
class Moments:
    """Sums over rows: n, x, xx', y, y^2, xy. They add up and subtract."""

    n: float
    sx: np.ndarray
    sxx: np.ndarray
    sy: float
    syy: float
    sxy: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, y: np.ndarray) -> Moments:
        return cls(float(len(y)), x.sum(axis=0), x.T @ x, float(y.sum()), float(y @ y), x.T @ y)

    def __add__(self, o: Moments) -> Moments:
        return Moments(self.n + o.n, self.sx + o.sx, self.sxx + o.sxx, self.sy + o.sy, self.syy + o.syy, self.sxy + o.sxy)

    def __sub__(self, o: Moments) -> Moments:
        return Moments(self.n - o.n, self.sx - o.sx, self.sxx - o.sxx, self.sy - o.sy, self.syy - o.syy, self.sxy - o.sxy)

    def centred(self) -> tuple[np.ndarray, np.ndarray]:
        mx, my = self.sx / self.n, self.sy / self.n
        return self.sxx / self.n - np.outer(mx, mx), self.sxy / self.n - mx * my

    def scales(self) -> np.ndarray:
        """Population deviations, 1 for a constant column."""
        var = np.diag(self.sxx) / self.n - (self.sx / self.n) ** 2
        size = np.diag(self.sxx) / self.n
        flat = var <= 1e-12 * np.maximum(size, 1e-300)
        return np.where(flat, 1.0, np.sqrt(np.maximum(var, 0.0)))

    def mse(self, w: np.ndarray, train: Moments) -> float:
        """Mean squared error of the model fitted on ``train`` on these rows."""
        b = (train.sy - w @ train.sx) / train.n
        rss = (
            self.syy - 2 * (w @ self.sxy) - 2 * b * self.sy
            + w @ self.sxx @ w + 2 * b * (w @ self.sx) + self.n * b * b
        )
        return max(rss, 0.0) / self.n


def lasso(cov: np.ndarray, xy: np.ndarray, alpha: float, start: np.ndarray | None = None,
          max_iter: int = 1000) -> np.ndarray:
    """Coordinate descent on centred moments."""
    p = len(xy)
    w = np.zeros(p) if start is None else start.copy()
    diag = np.diag(cov)
    usable = np.flatnonzero(diag > 1e-15)
    grad = xy - cov @ w
    if not w.any() and np.all(np.abs(xy[usable]) <= alpha):
        return np.zeros(p)
    active = usable
    for sweep in range(max_iter):
        biggest = 0.0
        for j in active:
            old = w[j]
            rho = grad[j] + diag[j] * old
            new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / diag[j]
            if new != old:
                grad -= cov[:, j] * (new - old)
                w[j] = new
                biggest = max(biggest, abs(new - old) * np.sqrt(diag[j]))
        if biggest < TOLERANCE:
            if active is usable:
                break
            active = usable  # confirm on all coordinates
        else:
            active = usable[w[usable] != 0] if sweep % 10 else usable
            if len(active) == 0:
                active = usable
    return w


def alpha_path(train: Moments, test: Moments, alphas: np.ndarray, max_iter: int = 1000) -> np.ndarray:
    """Test error per alpha with columns scaled (not centred) by the train deviations."""
    s = train.scales()
    cov, xy = train.centred()
    cov, xy = cov / np.outer(s, s), xy / s
    out = np.empty(len(alphas))
    w = np.zeros(len(s))
    for i in np.argsort(-alphas):
        w = lasso(cov, xy, float(alphas[i]), w, max_iter)
        out[i] = test.mse(w / s, train)
    return out


def eliminate(train: Moments, keep: list[int], selector_alpha: float) -> dict[int, list[int]]:
    """Feature sets by size: drop the smallest squared coefficient, first feature on ties."""
    cov, xy = train.centred()
    left = list(range(len(xy)))
    sets = {}
    smallest = min(keep)
    while True:
        if len(left) in keep:
            sets[len(left)] = list(left)
        if len(left) <= smallest:
            break
        w = lasso(cov[np.ix_(left, left)], xy[left], selector_alpha)
        left.pop(int(np.argmin(w * w)))
    return sets


def rfe_score(train: Moments, test: Moments, chosen: list[int], alpha: float, max_iter: int = 1000) -> float:
    """Negative root mean squared error of the refit on the chosen features."""
    cov, xy = train.centred()
    w = np.zeros(len(xy))
    w[chosen] = lasso(cov[np.ix_(chosen, chosen)], xy[chosen], alpha, max_iter=max_iter)
    return -float(np.sqrt(test.mse(w, train)))
