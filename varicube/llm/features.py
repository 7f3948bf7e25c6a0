"""Hashed features of a text and a small softmax model, shared by the quality and the domain classifier."""

from __future__ import annotations

import numpy as np

BINS = 2048


def features(text: str | None, extra: tuple[int, ...] = (), bins: int = BINS) -> np.ndarray:
    """Square roots of the shares of the text's hashed byte pairs, with hashed `extra` tokens. A short text's weigh less: it tells less."""
    raw = np.frombuffer(b" " + (text or "").encode("utf-8", "surrogatepass") + b" ", np.uint8).astype(np.uint32)
    pair = ((raw[:-1] * 256 + raw[1:]) * np.uint32(2654435761)) >> np.uint32(21)
    out = np.sqrt(np.bincount(pair % bins, minlength=bins) / (len(pair) + 50)).astype(np.float32)
    for token in extra:
        out[(token * 40503 + 977) % bins] += 0.5
    return out


def fit_softmax(x: np.ndarray, y: np.ndarray, rounds: int = 300, ridge: float = 1e-4) -> np.ndarray:
    """Weights (features + 1, classes) for soft labels y (rows, classes), by accelerated gradient descent; x has at most a bounded sample's rows."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros((x.shape[1], y.shape[1]))
    ahead, step = w.copy(), 4.0 / max(1e-9, float((x**2).sum(1).mean()))
    for k in range(rounds):
        z = x @ ahead.astype(np.float32)
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        new = ahead - step * (x.T @ (p - y).astype(np.float32) / len(x) + ridge * ahead)
        ahead, w = new + k / (k + 3) * (new - w), new
    return w


def posteriors(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    z = x @ w[:-1] + w[-1]
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)
