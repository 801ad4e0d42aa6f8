"""A bidirectional gated recurrent network with attention pooling, in numpy; trained by hand-written gradients.

Arrays are laid out (step, feature, window), so every gate is a contiguous block for all windows at once.
A padding step carries a gate input that keeps the state as it is, so no step needs a mask.
"""

from __future__ import annotations

import numpy as np

KEEP = np.float32(40.0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.clip(x, -60, 60, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    x *= 2
    x = _sigmoid(x)
    x *= 2
    x -= 1
    return x


def init(dim: int, hidden: int, words: int, grams: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return {"word": np.concatenate([np.zeros((1, dim), np.float32), normal(words, dim, scale=0.1)]), "gram": normal(grams, dim, scale=0.3),
            "in": normal(6 * hidden, dim, scale=0.4), "in_b": np.zeros((6 * hidden, 1), np.float32),
            "fw": normal(3 * hidden, hidden, scale=0.3), "bw": normal(3 * hidden, hidden, scale=0.3),
            "att": normal(2 * hidden, scale=0.3), "out": normal(2 * hidden, scale=0.3), "out_b": np.zeros(1, np.float32)}


def run_direction(x: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (step, hidden, window) for gate inputs ``x`` (step, 3 hidden, window); ``keep`` collects gates for training."""
    steps, wide, n = x.shape
    hidden = wide // 3
    h, out = np.zeros((hidden, n), np.float32), np.empty((steps, hidden, n), np.float32)
    for t in range(steps):
        from_h = u @ h
        gates = _sigmoid(x[t, :2 * hidden] + from_h[:2 * hidden])
        z, r = gates[:hidden], gates[hidden:]
        new = _tanh(x[t, 2 * hidden:] + r * from_h[2 * hidden:])
        if keep is not None:
            keep.append((h, z, r, new, from_h[2 * hidden:]))
        h = new + z * (h - new)
        out[t] = h
    return out


def back_direction(dout: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    steps, hidden, n = dout.shape
    dx, du, dh = np.empty((steps, 3 * hidden, n), np.float32), np.zeros_like(u), np.zeros((hidden, n), np.float32)
    for t in range(steps - 1, -1, -1):
        h, z, r, new, inner = kept[t]
        dh = dh + dout[t]
        dnew = dh * (1 - z) * (1 - new * new)
        dz = dh * (h - new) * z * (1 - z)
        dr = dnew * inner * r * (1 - r)
        dx[t] = np.concatenate([dz, dr, dnew])
        gate = np.concatenate([dz, dr, dnew * r])
        du += gate @ h.T
        dh = dh * z + u.T @ gate
    return dx, du


def pool(states: np.ndarray, real: np.ndarray, att: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Attention weights (step, window) over the real steps and the pooled state (2 hidden, window)."""
    e = np.einsum("tfb,f->tb", states, att)
    e = np.where(real, e, -1e9)
    e = np.exp(e - e.max(axis=0))
    a = (e / e.sum(axis=0)).astype(np.float32)
    return a, np.einsum("tfb,tb->fb", states, a)


def both_states(x: np.ndarray, p: dict, kept: tuple | None = None) -> np.ndarray:
    wide = x.shape[1] // 2
    forward = run_direction(x[:, :wide], p["fw"], kept and kept[0])
    backward = run_direction(x[::-1, wide:], p["bw"], kept and kept[1])[::-1]
    return np.concatenate([forward, backward], axis=1)


def logits(x: np.ndarray, real: np.ndarray, p: dict) -> np.ndarray:
    _, pooled = pool(both_states(x, p), real, p["att"])
    return p["out"] @ pooled + p["out_b"][0]


def sliding_logits(x: np.ndarray, steps: int, real: np.ndarray | None, p: dict) -> np.ndarray:
    """``logits`` of all windows of ``steps`` neighbouring columns of ``x`` (6 hidden, column), without a copy per window.

    Attention needs two numbers per state, so states are not kept. ``real`` (step, window) masks padding.
    """
    n, hidden = x.shape[1] - steps + 1, len(p["att"]) // 2
    halves = np.zeros((2, steps, n), np.float32)  # attention and output, summed over both directions
    for part, u, order in ((slice(0, 3 * hidden), p["fw"], range(steps)), (slice(3 * hidden, None), p["bw"], range(steps - 1, -1, -1))):
        side = slice(0, hidden) if part.start == 0 else slice(hidden, None)
        reads, rows = np.stack([p["att"][side], p["out"][side]]).astype(np.float32), np.array(x[part])
        # A sigmoid is half a tangent of half its input.
        scale = np.ones((3 * hidden, 1), np.float32)
        scale[:2 * hidden] = 0.5
        rows *= scale
        u = (u * scale).astype(np.float32)
        h, from_h, gates = np.zeros((hidden, n), np.float32), np.empty((3 * hidden, n), np.float32), np.empty((2 * hidden, n), np.float32)
        new = np.empty((hidden, n), np.float32)
        for t in order:
            np.matmul(u, h, out=from_h)
            np.add(rows[:2 * hidden, t:t + n], from_h[:2 * hidden], out=gates)
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            np.multiply(gates[hidden:], from_h[2 * hidden:], out=new)
            new += rows[2 * hidden:, t:t + n]
            np.tanh(new, out=new)
            h -= new
            h *= gates[:hidden]
            h += new
            halves[:, t] += reads @ h
    e = halves[0] if real is None else np.where(real, halves[0], np.float32(-1e9))
    e = np.exp(e - e.max(axis=0))
    return (e * halves[1]).sum(axis=0) / e.sum(axis=0) + p["out_b"][0]


def gate_inputs(word_ids: np.ndarray, gram_ids: np.ndarray, gram_first: np.ndarray, p: dict) -> np.ndarray:
    """Gate inputs (6 hidden, word) of distinct words, with one padding column at the end."""
    counts = np.diff(gram_first)
    chars = np.add.reduceat(p["gram"][gram_ids], gram_first[:-1], axis=0) / counts[:, None] if len(word_ids) else np.zeros((0, p["gram"].shape[1]), np.float32)
    x = p["in"] @ (p["word"][word_ids] + chars).T + p["in_b"]
    wide = len(p["in"]) // 2
    pad = np.zeros((len(p["in"]), 1), np.float32)
    pad[:wide // 3] = pad[wide:wide + wide // 3] = KEEP
    return np.ascontiguousarray(np.concatenate([x, pad], axis=1), dtype=np.float32)


def _add_rows(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """out[at] += values, with repeats in ``at`` added up."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    heads = np.flatnonzero(np.diff(at, prepend=-1))
    out[at[heads]] += np.add.reduceat(values[order], heads, axis=0)


def gradients(ids: np.ndarray, labels: np.ndarray, words: tuple, p: dict) -> tuple[float, dict]:
    """Mean log loss of windows and its gradients. ``ids``: (step, window) into the distinct words, -1 for padding."""
    word_ids, gram_ids, gram_first = words
    table = gate_inputs(word_ids, gram_ids, gram_first, p)
    x, real, kept = np.moveaxis(table[:, ids], 0, 1), ids >= 0, ([], [])
    states = both_states(np.ascontiguousarray(x), p, kept)
    a, pooled = pool(states, real, p["att"])
    y = _sigmoid(p["out"] @ pooled + p["out_b"][0])
    loss = -np.mean(np.where(labels > 0, np.log(y + 1e-9), np.log(1 - y + 1e-9)))
    dlogit = ((y - labels) / len(labels)).astype(np.float32)
    g = {"out": pooled @ dlogit, "out_b": np.array([dlogit.sum()], np.float32)}
    dpooled = p["out"][:, None] * dlogit
    da = np.einsum("tfb,fb->tb", states, dpooled)
    de = a * (da - (a * da).sum(axis=0))
    g["att"] = np.einsum("tfb,tb->f", states, de)
    dstates = a[:, None, :] * dpooled[None] + de[:, None, :] * p["att"][None, :, None]
    hidden = len(p["att"]) // 2
    dxf, g["fw"] = back_direction(dstates[:, :hidden], p["fw"], kept[0])
    dxb, g["bw"] = back_direction(dstates[::-1, hidden:], p["bw"], kept[1])
    dx = np.moveaxis(np.concatenate([dxf, dxb[::-1]], axis=1), 1, 0)[:, real]
    dtable = np.zeros((len(word_ids), len(table)), np.float32)
    _add_rows(dtable, ids[real], dx.T)
    counts = np.diff(gram_first)
    chars = np.add.reduceat(p["gram"][gram_ids], gram_first[:-1], axis=0) / counts[:, None]
    g["in"], g["in_b"] = dtable.T @ (p["word"][word_ids] + chars), dtable.sum(axis=0)[:, None]
    dinput = dtable @ p["in"]
    g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
    _add_rows(g["word"], word_ids, dinput)
    _add_rows(g["gram"], gram_ids, np.repeat(dinput / counts[:, None], counts, axis=0))
    g["word"][0] = 0  # unknown words have no entry of their own
    return float(loss), g


class Adam:
    def __init__(self, p: dict, rate: float):
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}
        self.t, self.rate = 0, rate

    def step(self, p: dict, g: dict) -> None:
        self.t += 1
        for k in p:
            self.m[k] += 0.1 * (g[k] - self.m[k])
            self.v[k] += 0.01 * (g[k] * g[k] - self.v[k])
            p[k] -= (self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.99 ** self.t)) + 1e-7)).astype(np.float32)
