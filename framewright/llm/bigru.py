"""A bidirectional gated recurrent network over bytes that labels every position, in numpy.

For byte x_t, in each direction with weights of its own:

    z, r = sigmoid(W_zr[x_t] + h U_zr)
    c    = tanh(W_c[x_t] + r * (h U_c + b_c))
    h'   = z * h + (1 - z) * c

and the label of position t has the probabilities softmax(h_forward V_f + h_backward V_b + b).
Trained by backpropagation through time with Adam.
"""

from __future__ import annotations

import numpy as np

DIRECTIONS = ("f", "b")
#: Rows that are read side by side, and positions whose probabilities are made together.
ROWS, POSITIONS = 2048, 32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def init(hidden: int, labels: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w: dict[str, np.ndarray] = {"out": np.zeros(labels)}
    for d in DIRECTIONS:
        w |= {f"W{d}": rng.normal(0, 0.3, (256, 3 * hidden)), f"U{d}": rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)), f"b{d}": np.zeros(hidden), f"V{d}": rng.normal(0, hidden**-0.5, (hidden, labels))}
    return {k: v.astype(np.float32) for k, v in w.items()}


def _taped(w: dict[str, np.ndarray], d: str, x: np.ndarray, tape: list) -> np.ndarray:
    """States after each position of x (rows x length), in the order of the positions; what backpropagation needs goes on the tape."""
    rows, length = x.shape
    n = w[f"U{d}"].shape[0]
    W, U, b = w[f"W{d}"], w[f"U{d}"], w[f"b{d}"]
    h = np.zeros((rows, n), W.dtype)
    out = np.empty((length, rows, n), W.dtype)
    for t in range(length) if d == "f" else range(length - 1, -1, -1):
        a, g = W[x[:, t]], h @ U
        zr = _sigmoid(a[:, : 2 * n] + g[:, : 2 * n])
        z, r = zr[:, :n], zr[:, n:]
        inner = g[:, 2 * n :] + b
        c = np.tanh(a[:, 2 * n :] + r * inner)
        tape.append((t, h, z, r, c, inner))
        out[t] = h = c + z * (h - c)
    return out


def _scores(w: dict[str, np.ndarray], d: str, places: np.ndarray) -> np.ndarray:
    """length x labels x rows: what one direction adds to the labels' scores at each position of places (length x rows).

    States are columns here, so that gates are contiguous blocks of rows. The gates' halves
    of sigmoid(x) = (tanh(x / 2) + 1) / 2 are in the weights, and a last state of 1 carries the bias.
    """
    length, rows = places.shape
    n, labels = w[f"V{d}"].shape
    half = np.concatenate([np.full(2 * n, 0.5, np.float32), np.ones(n, np.float32)])
    W = np.ascontiguousarray((w[f"W{d}"] * half).T)
    bias = np.concatenate([np.zeros(2 * n, np.float32), w[f"b{d}"]])[:, None]
    U = np.concatenate([w[f"U{d}"].T, bias], axis=1) * np.float32(0.5)
    V = np.concatenate([w[f"V{d}"].T, np.zeros((labels, 1), np.float32)], axis=1)
    state = np.zeros((n + 1, rows), np.float32)
    state[n] = 1
    h = state[:n]
    a, g, out = np.empty((3 * n, rows), np.float32), np.empty((3 * n, rows), np.float32), np.empty((length, labels, rows), np.float32)
    zr, c = g[: 2 * n], g[2 * n :]
    for t in range(length) if d == "f" else range(length - 1, -1, -1):
        np.take(W, places[t], axis=1, out=a, mode="clip")
        np.matmul(U, state, out=g)
        zr += a[: 2 * n]
        np.tanh(zr, out=zr)
        zr += 1  # twice the gates
        c *= zr[n:]
        c += a[2 * n :]
        np.tanh(c, out=c)
        h -= c
        h *= zr[:n]
        h *= np.float32(0.5)
        h += c
        np.matmul(V, state, out=out[t])
    return out


def _softmax(s: np.ndarray, axis: int) -> np.ndarray:
    s -= s.max(axis=axis, keepdims=True)
    np.exp(s, out=s)
    s /= s.sum(axis=axis, keepdims=True)
    return s


def probabilities(w: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """length x rows x labels: the labels' probabilities at each position of x (rows x length)."""
    places = np.ascontiguousarray(x.T).astype(np.intp)
    return _softmax(_scores(w, "f", places) + _scores(w, "b", places) + w["out"][:, None], 1).transpose(0, 2, 1)


def pooled(w: dict[str, np.ndarray], x: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """rows x labels: the sums of the labels' probabilities over each row's positions that are counted."""
    out = np.zeros((len(x), len(w["out"])), np.float64)
    for at in range(0, len(x), ROWS):
        places = np.ascontiguousarray(x[at : at + ROWS].T).astype(np.intp)
        which = np.ascontiguousarray(counted[at : at + ROWS].T)
        scores = _scores(w, "f", places)
        scores += _scores(w, "b", places)
        scores += w["out"][:, None]
        for t in range(0, len(places), POSITIONS):
            p = _softmax(scores[t : t + POSITIONS], 1)
            p *= which[t : t + POSITIONS, None, :]
            out[at : at + ROWS] += p.sum(axis=0).T
    return out


def gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, counted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over the positions of rows x with labels y that are counted (rows x length), and its gradients."""
    rows = len(x)
    tapes: dict[str, list] = {d: [] for d in DIRECTIONS}
    states = {d: _taped(w, d, x, tapes[d]) for d in DIRECTIONS}
    p = _softmax(states["f"] @ w["Vf"] + states["b"] @ w["Vb"] + w["out"], 2)
    share = (counted.T / max(1, int(counted.sum()))).astype(p.dtype)
    loss = float(-(np.log(np.maximum(p[:, np.arange(rows), y], 1e-12)) * share).sum())
    p[:, np.arange(rows), y] -= 1
    p *= share[:, :, None]
    g = {"out": p.sum(axis=(0, 1))}
    for d in DIRECTIONS:
        U, V = w[f"U{d}"], w[f"V{d}"]
        n = U.shape[0]
        g[f"V{d}"] = np.tensordot(states[d], p, axes=((0, 1), (0, 1)))
        back = p @ V.T
        gW, gU, gb = np.zeros_like(w[f"W{d}"]), np.zeros_like(U), np.zeros_like(w[f"b{d}"])
        dh = np.zeros((rows, n), U.dtype)
        for t, h, z, r, c, inner in reversed(tapes[d]):
            dh = dh + back[t]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * inner * r * (1 - r)
            dinner = dc * r
            down = np.concatenate([dz, dr, dinner], axis=1)
            up = np.concatenate([dz, dr, dc], axis=1)
            gb += dinner.sum(axis=0)
            gU += h.T @ down
            onto = np.zeros((256, rows), U.dtype)
            onto[x[:, t], np.arange(rows)] = 1
            gW += onto @ up
            dh = dh * z + down @ U.T
        g |= {f"W{d}": gW, f"U{d}": gU, f"b{d}": gb}
    return loss, g


def train(x: np.ndarray, labels: np.ndarray, counted: np.ndarray, n_labels: int, hidden: int, steps: int, batch: int, rate: float, seed: int) -> dict[str, np.ndarray]:
    """Fits to rows of bytes (rows x length) with a label each; labels weigh alike, however many rows each has."""
    rng = np.random.default_rng(seed)
    w = init(hidden, n_labels, seed)
    own = [np.flatnonzero(labels == k) for k in range(n_labels)]
    own = [rows for rows in own if len(rows)]
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        at = np.array([own[k][rng.integers(len(own[k]))] for k in rng.integers(0, len(own), batch)])
        _, g = gradients(w, x[at], labels[at], counted[at])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        scale = min(1.0, 1.0 / max(norm, 1e-9))
        lr = rate * (1 - 0.9 * step / steps)
        for k, v in g.items():
            v = v * scale
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            w[k] = (w[k] - lr * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return w
