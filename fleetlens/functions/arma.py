"""ARMA(2, 2) on a differenced series by two-stage least squares (inside tasks)."""

from __future__ import annotations

import numpy as np

Z80 = 1.2815515655446004


def _lags(x: np.ndarray, count: int) -> np.ndarray:
    """Columns x[t-1] .. x[t-count] for t = count .. len(x) - 1."""
    return np.column_stack([x[count - k : len(x) - k] for k in range(1, count + 1)])


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(a, b, rcond=None)[0]


def _shrink(c: np.ndarray) -> np.ndarray:
    """Scale coefficients so that the recursion they define does not explode."""
    roots = np.abs(np.roots([1.0, -c[0], -c[1]]))
    worst = roots.max() if len(roots) else 0.0
    if worst < 0.98:
        return c
    s = 0.98 / worst
    return np.array([c[0] * s, c[1] * s * s])


def forecast_mean(y: np.ndarray, steps: int) -> tuple[float, float] | None:
    """Mean of the next ``steps`` values and the mean width of their 80 % interval."""
    d = np.diff(y)
    if len(d) < 5 or not np.isfinite(d).all():
        return None
    long = int(min(max(3, round(np.log(len(d)) * 2)), (len(d) - 1) // 3))
    first = _lags(d, long)
    shock = np.zeros(len(d))
    shock[long:] = d[long:] - first @ _solve(first, d[long:])
    start = max(2, min(long + 2, len(d) - 4))
    design = np.column_stack([_lags(d, 2), _lags(shock, 2)])[start - 2 :]
    coef = _solve(design, d[start:])
    ar, ma = _shrink(coef[:2]), -_shrink(-coef[2:])
    # Residuals of the final model, run forward from zero.
    e = np.zeros(len(d))
    for t in range(2, len(d)):
        e[t] = d[t] - ar @ d[t - 1 : t - 3 if t > 2 else None : -1] - ma @ e[t - 1 : t - 3 if t > 2 else None : -1]
    sigma = float(np.sqrt(np.mean(e[2:] ** 2)))
    diffs, shocks, level, path = [d[-1], d[-2]], [e[-1], e[-2]], y[-1], []
    for _ in range(steps):
        nxt = float(ar @ diffs[:2] + ma @ shocks[:2])
        diffs.insert(0, nxt)
        shocks.insert(0, 0.0)
        level = level + nxt
        path.append(level)
    psi, response = [1.0], [1.0]
    for k in range(1, steps):
        w = sum(ar[j] * psi[k - 1 - j] for j in range(2) if k - 1 - j >= 0) + (ma[k - 1] if k <= 2 else 0.0)
        psi.append(w)
        response.append(response[-1] + w)
    spread = sigma * np.sqrt(np.cumsum(np.square(response)))
    mean, width = float(np.mean(path)), float(np.mean(2 * Z80 * spread))
    return (mean, width) if np.isfinite(mean) and np.isfinite(width) else None
