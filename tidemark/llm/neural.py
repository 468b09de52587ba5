"""Small numpy networks with their gradients: a recurrent direction, attention pooling, Adam."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def sums_by_row(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """(n, columns): the sums of the values (k, columns) of each row number."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(rows):
        order = np.argsort(rows, kind="stable")
        firsts = np.flatnonzero(np.r_[True, np.diff(rows[order]) != 0])
        out[rows[order[firsts]]] = np.add.reduceat(values[order], firsts)
    return out


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float = 0.01):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.99 * self.v[k] + 0.01 * g * g
            self.params[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-6)


def gru(x: np.ndarray, mask: np.ndarray | None, u: np.ndarray, keep: bool = False):
    """States (steps, rows, h) of a gated recurrent unit; x (steps, rows, 3h) has the inputs' share of
    update gate, reset gate and candidate, u (h, 3h) the states'. A masked step leaves the state as it
    is. With keep, also what ``gru_back`` needs."""
    steps, rows, three = x.shape
    h = three // 3
    state = np.zeros((rows, h), x.dtype)
    out = np.empty((steps, rows, h), x.dtype)
    kept = []
    for t in range(steps):
        own = state @ u
        gates = 0.5 * np.tanh(0.5 * (x[t, :, : 2 * h] + own[:, : 2 * h])) + 0.5
        z, r = gates[:, :h], gates[:, h:]
        n = np.tanh(x[t, :, 2 * h :] + r * own[:, 2 * h :])
        new = n + z * (state - n)
        if mask is not None:
            new = np.where(mask[t][:, None], new, state)
        if keep:
            kept.append((state, z, r, n, own[:, 2 * h :]))
        state = new
        out[t] = state
    return (out, kept) if keep else out


def gru_back(d_out: np.ndarray, mask: np.ndarray | None, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """(gradient of x, gradient of u)."""
    steps, rows, h = d_out.shape
    dx, du = np.empty((steps, rows, 3 * h), d_out.dtype), np.zeros_like(u)
    carried = np.zeros((rows, h), d_out.dtype)
    for t in reversed(range(steps)):
        state, z, r, n, own = kept[t]
        d = carried + d_out[t]
        through = np.zeros_like(d)
        if mask is not None:
            on = mask[t][:, None]
            through, d = np.where(on, 0, d), np.where(on, d, 0)
        dz = d * (state - n) * z * (1 - z)
        dn = d * (1 - z) * (1 - n * n)
        dr = dn * own * r * (1 - r)
        dx[t] = np.concatenate([dz, dr, dn], 1)
        d_own = np.concatenate([dz, dr, dn * r], 1)
        du += state.T @ d_own
        carried = d * z + d_own @ u.T + through
    return dx, du


def attend(hs: np.ndarray, mask: np.ndarray | None, w: np.ndarray, b: np.ndarray, v: np.ndarray, keep: bool = False):
    """The states' mean (rows, h), weighted by softmax(tanh(hs w + b) v) over the steps."""
    inner = np.tanh(hs @ w + b)
    e = inner @ v
    if mask is not None:
        e = np.where(mask, e, -1e9)
    a = np.exp(e - e.max(0))
    a = a / a.sum(0)
    out = np.einsum("tb,tbh->bh", a, hs)
    return (out, (inner, a)) if keep else out


def attend_back(d_out: np.ndarray, hs: np.ndarray, w: np.ndarray, v: np.ndarray, kept) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of hs, w, b, v."""
    inner, a = kept
    da = np.einsum("bh,tbh->tb", d_out, hs)
    de = a * (da - (a * da).sum(0))
    d_inner = de[..., None] * v * (1 - inner * inner)
    flat = d_inner.reshape(-1, d_inner.shape[-1])
    dhs = a[..., None] * d_out + d_inner @ w.T
    return dhs, hs.reshape(-1, hs.shape[-1]).T @ flat, flat.sum(0), np.einsum("tb,tba->a", de, inner)
