"""Minimising a smooth function on one machine, for models of bounded size."""

from __future__ import annotations

import numpy as np


def minimise(loss, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with halving steps."""
    value, grad = loss(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, used = -grad.copy(), []
        for s, y in reversed(moves):
            a = (s @ way) / (s @ y)
            used.append(a)
            way -= a * y
        if moves:
            s, y = moves[-1]
            way *= (s @ y) / (y @ y)
        else:
            way /= max(np.sqrt(grad @ grad), 1e-12)
        for (s, y), a in zip(moves, reversed(used)):
            way += s * (a - (y @ way) / (s @ y))
        size, slope = 1.0, grad @ way
        for _ in range(20):
            new_value, new_grad = loss(x + size * way)
            if new_value <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = size * way, new_grad - grad
        if s @ y > 1e-12:
            moves = [*moves, (s, y)][-memory:]
        done = value - new_value < 1e-7 * max(abs(value), 1.0)
        x, value, grad = x + s, new_value, new_grad
        if done:
            break
    return x
