"""One step of each admission rule, shared by batch and streams."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

import numpy as np


@dataclass
class Bucket:
    """Tokens left at the last request; None before the first one."""

    tokens: float | None = None
    at: float = 0.0


def bucket_step(state: Bucket, at: float, need: float, refill: float, capacity: float) -> tuple:
    """Returns (allowed, remaining, reset_after)."""
    if state.tokens is None:
        level = capacity
    else:
        level = min(capacity, state.tokens + max(0.0, at - state.at) * refill)
    allowed = level >= need
    state.tokens, state.at = (level - need if allowed else level), at
    wait = 0.0 if state.tokens >= 1 else (1 - state.tokens) / refill
    return allowed, int(state.tokens), wait


@dataclass
class LevelTable:
    """What a run of requests makes of the level at its first one: pieces of [0, capacity], from ``edges`` on, that
    each end at a fixed level or at the level they began with plus an offset."""

    edges: np.ndarray
    values: np.ndarray
    fixed: np.ndarray

    @classmethod
    def start(cls) -> LevelTable:
        return cls(np.zeros(1), np.zeros(1), np.zeros(1, bool))

    def split(self, level: float, top: float) -> LevelTable:
        """The same pieces, cut where they reach ``level``."""
        ends = np.append(self.edges[1:], np.nextafter(top, np.inf))
        at = level - self.values
        cut = ~self.fixed & (at > self.edges) & (at < ends)
        order = np.argsort(np.concatenate([self.edges, at[cut]]), kind="stable")
        both = lambda x: np.concatenate([x, x[cut]])[order]
        return LevelTable(np.concatenate([self.edges, at[cut]])[order], both(self.values), both(self.fixed))

    def levels(self) -> np.ndarray:
        return np.where(self.fixed, self.values, self.edges + self.values)

    def then(self, gain: float, need: float, capacity: float) -> LevelTable:
        """Followed by a refill of ``gain`` up to ``capacity`` and a request for ``need``."""
        out = LevelTable(self.edges, self.values + gain, self.fixed).split(capacity, capacity)
        full = out.levels() >= capacity
        out = LevelTable(out.edges, np.where(full, capacity, out.values), out.fixed | full).split(need, capacity)
        taken = out.levels() >= need
        out = LevelTable(out.edges, np.where(taken, out.values - need, out.values), out.fixed)
        same = np.zeros(len(out.edges), bool)
        same[1:] = (out.fixed[1:] == out.fixed[:-1]) & (out.values[1:] == out.values[:-1])
        return LevelTable(out.edges[~same], out.values[~same], out.fixed[~same])

    def after(self, level: float) -> float:
        k = int(np.searchsorted(self.edges, level, side="right")) - 1
        return float(self.values[k] if self.fixed[k] else level + self.values[k])


@dataclass
class Admitted:
    """Times of the admitted requests that are still inside the window."""

    times: deque = field(default_factory=deque)


def window_step(state: Admitted, at: float, limit: int, window_s: float) -> tuple:
    """Returns (allowed, remaining, reset_after). Only admitted requests count."""
    held = state.times
    while held and held[0] <= at - window_s:
        held.popleft()
    allowed = len(held) < limit
    if allowed:
        held.append(at)
    wait = max(0.0, held[0] + window_s - at) if held else 0.0
    return allowed, max(0, limit - len(held)), wait
