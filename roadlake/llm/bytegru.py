"""A bidirectional gated recurrent network over bytes, in numpy: training by backpropagation through time, and labelling.

Every position of a window of bytes gets a probability for each language from the states of a forward and a backward
pass. The three gates of a step take their input terms from a table with a row per byte, so a step is one small matrix
product. Sigmoids are written as tanh of half their argument.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Direction(NamedTuple):
    table: np.ndarray  # 256 x 3h: the byte's terms of the update gate, the reset gate and the candidate state
    gates: np.ndarray  # h x 2h: from the state to the update and reset gates
    state: np.ndarray  # h x h: from the reset state to the candidate


class Network(NamedTuple):
    ahead: Direction
    back: Direction
    out: np.ndarray  # 2h x labels
    bias: np.ndarray  # labels


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def fresh(labels: int, hidden: int, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0] if shape[0] != 256 else 4), shape)
    one = lambda: Direction(draw(256, 3 * hidden), draw(hidden, 2 * hidden), draw(hidden, hidden))
    return Network(one(), one(), draw(2 * hidden, labels), np.zeros(labels))


def passed(side: Direction, windows: np.ndarray, keep: bool) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """The states (steps x windows x h) along the second axis of `windows`, and what a backward pass needs of each step."""
    hidden = side.state.shape[0]
    h = np.zeros((len(windows), hidden), side.table.dtype)
    states, kept = np.empty((windows.shape[1], len(windows), hidden), side.table.dtype), []
    for t in range(windows.shape[1]):
        x = side.table[windows[:, t]]
        zr = sigmoid(x[:, : 2 * hidden] + h @ side.gates)
        z, r = zr[:, :hidden], zr[:, hidden:]
        c = np.tanh(x[:, 2 * hidden :] + (r * h) @ side.state)
        if keep:
            kept.append((h, z, r, c))
        h = h + z * (c - h)
        states[t] = h
    return states, kept


def backward(side: Direction, windows: np.ndarray, kept: list[tuple[np.ndarray, ...]], d_states: np.ndarray) -> Direction:
    """Gradients of a direction, from those of its states, through time."""
    hidden = side.state.shape[0]
    d_table, d_gates, d_state = np.zeros_like(side.table), np.zeros_like(side.gates), np.zeros_like(side.state)
    d_inputs = np.empty((len(kept), len(windows), 3 * hidden))
    carry = np.zeros_like(d_states[0])
    for t in range(len(kept) - 1, -1, -1):
        h, z, r, c = kept[t]
        d = d_states[t] + carry
        d_c = d * z * (1 - c * c)
        d_rh = d_c @ side.state.T
        d_zr = np.concatenate([d * (c - h) * z * (1 - z), d_rh * h * r * (1 - r)], axis=1)
        d_gates += h.T @ d_zr
        d_state += (r * h).T @ d_c
        d_inputs[t, :, : 2 * hidden], d_inputs[t, :, 2 * hidden :] = d_zr, d_c
        carry = d * (1 - z) + d_rh * r + d_zr @ side.gates.T
    order = np.argsort(windows.T, axis=None, kind="stable")
    used, first = np.unique(windows.T.ravel()[order], return_index=True)
    d_table[used] = np.add.reduceat(d_inputs.reshape(-1, 3 * hidden)[order], first)
    return Direction(d_table, d_gates, d_state)


def probabilities(states: np.ndarray, net: Network) -> np.ndarray:
    scores = (states.reshape(-1, states.shape[-1]) @ net.out).reshape(*states.shape[:-1], -1) + net.bias
    scores -= scores.max(axis=-1, keepdims=True)
    np.exp(scores, out=scores)
    return scores / scores.sum(axis=-1, keepdims=True)


def both(net: Network, windows: np.ndarray, keep: bool) -> tuple[np.ndarray, list, list]:
    ahead, kept_ahead = passed(net.ahead, windows, keep)
    back, kept_back = passed(net.back, windows[:, ::-1], keep)
    return np.concatenate([ahead, back[::-1]], axis=2), kept_ahead, kept_back


def gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> tuple[float, Network]:
    """The mean cross-entropy over all positions, each labelled as its window, and its gradients."""
    states, kept_ahead, kept_back = both(net, windows, keep=True)
    p = probabilities(states, net)
    n, hidden = p.shape[0] * p.shape[1], net.ahead.state.shape[0]
    loss = -float(np.log(np.take_along_axis(p, labels[None, :, None], axis=2) + 1e-12).mean())
    p[:, np.arange(len(labels)), labels] -= 1
    p /= n
    d_states = p @ net.out.T
    d_out = np.einsum("tnh,tnl->hl", states, p)
    return loss, Network(
        backward(net.ahead, windows, kept_ahead, d_states[:, :, :hidden]), backward(net.back, windows[:, ::-1], kept_back, d_states[::-1, :, hidden:]), d_out, p.sum(axis=(0, 1)))


def flat(net: Network) -> list[np.ndarray]:
    return [*net.ahead, *net.back, net.out, net.bias]


def train(windows: np.ndarray, labels: np.ndarray, n_labels: int, hidden: int = 8, steps: int = 300, batch: int = 128, rate: float = 0.02, seed: int = 5) -> Network:
    """A network fitted with Adam on batches that draw every label equally often, with a falling rate."""
    net, rng = fresh(n_labels, hidden, seed), np.random.default_rng(seed)
    of_label = [np.flatnonzero(labels == k) for k in range(n_labels)]
    first, second = [np.zeros_like(w) for w in flat(net)], [np.zeros_like(w) for w in flat(net)]
    for step in range(1, steps + 1):
        rows = np.array([rng.choice(of_label[k]) for k in rng.integers(0, n_labels, batch)])
        _, grads = gradients(net, windows[rows], labels[rows])
        norm = np.sqrt(sum(float((g * g).sum()) for g in flat(grads)))
        for w, g, m, v in zip(flat(net), flat(grads), first, second, strict=True):
            g = g / max(1.0, norm)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    cast = lambda side: Direction(*(w.astype(np.float32) for w in side))
    return Network(cast(net.ahead), cast(net.back), net.out.astype(np.float32), net.bias.astype(np.float32))


def label_positions(net: Network, windows: np.ndarray) -> np.ndarray:
    """Probabilities (steps x windows x labels) of every position."""
    states, _, _ = both(net, windows, keep=False)
    return probabilities(states, net)
