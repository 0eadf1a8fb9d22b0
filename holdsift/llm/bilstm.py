"""A bidirectional LSTM over characters with CRF transitions, in NumPy: training, scores and Viterbi decoding.

Sequences come as columns of a (time, batch) array of character classes; 0 is padding after a sequence's end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCKED = -1e4


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Net:
    """``table``: input per class and direction, already times the input weights; ``recur``: hidden to gates."""

    table: np.ndarray  # 2, classes, 4 * hidden
    recur: np.ndarray  # 2, hidden, 4 * hidden
    out: np.ndarray  # 2 * hidden, tags
    bias: np.ndarray  # tags
    moves: np.ndarray  # tags, tags
    start: np.ndarray  # tags

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.recur, self.out, self.bias, self.moves, self.start]


def fresh(classes: int, hidden: int, tags: int, seed: int) -> Net:
    rng = np.random.default_rng(seed)
    f = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    table = f(2, classes, 4 * hidden, scale=0.3)
    table[:, :, hidden: 2 * hidden] += 1.0  # gates that forget start open
    return Net(table, f(2, hidden, 4 * hidden, scale=hidden**-0.5), f(2 * hidden, tags, scale=0.2), np.zeros(tags, np.float32),
               np.zeros((tags, tags), np.float32), np.zeros(tags, np.float32))


def _run(table: np.ndarray, recur: np.ndarray, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    steps, batch = x.shape
    h = recur.shape[0]
    hidden, cell = np.zeros((batch, h), np.float32), np.zeros((batch, h), np.float32)
    out, kept = np.zeros((steps, batch, h), np.float32), []
    for t in range(steps):
        z = table[x[t]] + hidden @ recur
        gates = _sigmoid(z[:, : 3 * h])
        new = np.tanh(z[:, 3 * h:])
        before, cell = cell, gates[:, h: 2 * h] * cell + gates[:, :h] * new
        squashed = np.tanh(cell)
        past, hidden = hidden, gates[:, 2 * h:] * squashed
        out[t] = hidden
        if keep:
            kept.append((gates, new, before, squashed, past))
    return out, kept


def emissions(net: Net, x: np.ndarray) -> np.ndarray:
    """Tag scores (time, batch, tags). Padding only follows a sequence, and the backward pass starts behind it."""
    ahead, _ = _run(net.table[0], net.recur[0], x, False)
    behind, _ = _run(net.table[1], net.recur[1], x[::-1], False)
    return np.concatenate([ahead, behind[::-1]], axis=2) @ net.out + net.bias


def viterbi(net: Net, e: np.ndarray, lengths: np.ndarray, allowed: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best tag sequence of each column (time, batch); rows past a length are 0."""
    steps, batch, tags = e.shape
    moves = np.where(allowed, net.moves, BLOCKED)
    score = e[0] + np.where(first, net.start, BLOCKED)
    back = np.zeros((steps, batch, tags), np.int8)
    for t in range(1, steps):
        reach = score[:, :, None] + moves[None]
        back[t] = reach.argmax(axis=1)
        live = (t < lengths)[:, None]
        score = np.where(live, reach.max(axis=1) + e[t], score)
    best = np.zeros((steps, batch), np.int8)
    tag = score.argmax(axis=1)
    columns = np.arange(batch)
    for t in range(steps - 1, -1, -1):
        live = t < lengths
        best[t] = np.where(live, tag, 0)
        if t:
            tag = np.where(live, back[t, columns, tag], tag)
    return best


def gradients(net: Net, x: np.ndarray, gold: np.ndarray, allowed: np.ndarray, first: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log likelihood of whole sequences (all of one length) and its slopes, in the order of ``parts``."""
    steps, batch = x.shape
    hidden, tags = net.recur.shape[1], len(net.bias)
    runs = [_run(net.table[0], net.recur[0], x, True), _run(net.table[1], net.recur[1], x[::-1], True)]
    both = np.concatenate([runs[0][0], runs[1][0][::-1]], axis=2)
    e = both @ net.out + net.bias
    # forward and backward sums as probabilities, scaled to one at each step
    top = e.max(axis=2, keepdims=True)
    weight, moved = np.exp(e - top), np.where(allowed, np.exp(net.moves), 0)
    ahead, behind = np.zeros_like(e), np.ones_like(e)
    scale = np.zeros((steps, batch), np.float32)
    for t in range(steps):
        ahead[t] = (ahead[t - 1] @ moved if t else np.where(first, np.exp(net.start), 0)) * weight[t]
        scale[t] = ahead[t].sum(axis=1)
        ahead[t] /= scale[t][:, None]
    pair = np.zeros((tags, tags), np.float32)
    for t in range(steps - 2, -1, -1):
        coming = behind[t + 1] * weight[t + 1] / scale[t + 1][:, None]
        behind[t] = coming @ moved.T
        pair += moved * (ahead[t].T @ coming)
    node = ahead * behind
    at = np.eye(tags, dtype=np.float32)[gold]
    right = (e * at).sum() + net.moves[gold[:-1], gold[1:]].sum() + net.start[gold[0]].sum()
    loss = float((np.log(scale).sum() + top.sum() - right) / batch)
    slope = (node - at) / np.float32(batch)
    np.add.at(pair, (gold[:-1].ravel(), gold[1:].ravel()), -1)
    flat = slope.reshape(-1, tags)
    d_out = both.reshape(-1, 2 * hidden).T @ flat
    d_both = slope @ net.out.T
    d_table, d_recur = np.zeros_like(net.table), np.zeros_like(net.recur)
    for side in (0, 1):
        seen = x if side == 0 else x[::-1]
        pull = d_both[:, :, :hidden] if side == 0 else d_both[::-1, :, hidden:]
        dh, dc = np.zeros((batch, hidden), np.float32), np.zeros((batch, hidden), np.float32)
        dz_all = np.zeros((steps, batch, 4 * hidden), np.float32)
        for t in range(steps - 1, -1, -1):
            gates, new, before, squashed, past = runs[side][1][t]
            i, f, o = gates[:, :hidden], gates[:, hidden: 2 * hidden], gates[:, 2 * hidden:]
            dh = dh + pull[t]
            dc = dc + dh * o * (1 - squashed**2)
            dz = dz_all[t]
            dz[:, :hidden] = dc * new * i * (1 - i)
            dz[:, hidden: 2 * hidden] = dc * before * f * (1 - f)
            dz[:, 2 * hidden: 3 * hidden] = dh * squashed * o * (1 - o)
            dz[:, 3 * hidden:] = dc * i * (1 - new**2)
            d_recur[side] += past.T @ dz
            dh, dc = dz @ net.recur[side].T, dc * f
        chosen = np.zeros((len(net.table[side]), seen.size), np.float32)
        chosen[seen.ravel(), np.arange(seen.size)] = 1
        d_table[side] = chosen @ dz_all.reshape(-1, 4 * hidden)
    d_start = (node[0] - at[0]).sum(axis=0) / batch
    return loss, [d_table, d_recur, d_out, flat.sum(axis=0), np.where(allowed, pair / batch, 0).astype(np.float32),
                  np.where(first, d_start, 0).astype(np.float32)]


def train(net: Net, x: np.ndarray, gold: np.ndarray, allowed: np.ndarray, first: np.ndarray, epochs: int, batch: int,
          step: float, seed: int) -> list[float]:
    """Adam over shuffled batches; changes ``net`` in place and returns the mean loss of each epoch."""
    rng = np.random.default_rng(seed)
    one, two = [np.zeros_like(p) for p in net.parts()], [np.zeros_like(p) for p in net.parts()]
    losses, k = [], 0
    for epoch in range(epochs):
        order, total = rng.permutation(x.shape[1]), []
        rate = step * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for begin in range(0, len(order), batch):
            cols = order[begin: begin + batch]
            loss, slopes = gradients(net, x[:, cols], gold[:, cols], allowed, first)
            total.append(loss)
            size = np.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in slopes))
            k += 1
            for p, g, m, v in zip(net.parts(), slopes, one, two):
                g = g * min(1.0, 5.0 / max(size, 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)).astype(p.dtype)
        losses.append(float(np.mean(total)))
    return losses
