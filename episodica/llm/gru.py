"""A small gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, packed lanes."""

from __future__ import annotations

import heapq

import numpy as np

CLASSES, PER_CLASS, HIDDEN = 32, 32, 16
SYMBOLS = CLASSES * PER_CLASS
OTHER = SYMBOLS - 1  # any word outside the vocabulary
SHAPES = {
    "inputs": (SYMBOLS, 3 * HIDDEN),  # what a symbol adds to update gate, reset gate and candidate
    "recur": (HIDDEN, 3 * HIDDEN),
    "class_w": (HIDDEN, CLASSES),
    "class_b": (CLASSES,),
    "word_w": (CLASSES, HIDDEN, PER_CLASS),
    "word_b": (CLASSES, PER_CLASS),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def untrained(counts: np.ndarray, seed: int = 7) -> np.ndarray:
    """Small random weights, and output biases that make the model the smoothed unigram distribution of ``counts``."""
    rng = np.random.default_rng(seed)
    flat = (rng.standard_normal(SIZE) * 0.1).astype(np.float32)
    p = unpack(flat)
    share = np.log((counts + 0.1) / (counts + 0.1).sum()).reshape(CLASSES, PER_CLASS)
    total = np.log(np.exp(share).sum(axis=1, keepdims=True))
    p["class_b"][:], p["word_b"][:] = total[:, 0], share - total
    p["class_w"][:] = 0
    p["word_w"][:] = 0
    return flat


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def forward(p: dict, symbols: np.ndarray, keep: np.ndarray, h: np.ndarray, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """States before each symbol of a window (steps x lanes) and the state after it; ``keep`` is 0 where a text starts.

    Inside, units are rows and lanes are columns, so that a gate is one stretch of memory.
    """
    steps, lanes = symbols.shape
    states = np.empty((steps, HIDDEN, lanes), np.float32)
    inputs, recur, h = np.ascontiguousarray(p["inputs"].T), np.ascontiguousarray(p["recur"].T), np.ascontiguousarray(h.T)
    for t in range(steps):
        h = h * keep[t]
        states[t] = h
        given, back = np.take(inputs, symbols[t], axis=1), recur @ h
        gate = sigmoid(given[: 2 * HIDDEN] + back[: 2 * HIDDEN])
        z, r = gate[:HIDDEN], gate[HIDDEN:]
        new = np.tanh(given[2 * HIDDEN :] + r * back[2 * HIDDEN :])
        if trace is not None:
            trace.append((z, r, new, back[2 * HIDDEN :], h))
        h = new + z * (h - new)
    return states.transpose(0, 2, 1), h.T


def by_class(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """Places ordered by class, and per class that occurs its slice of them."""
    groups = (symbols // PER_CLASS).astype(np.int8)
    order = np.argsort(groups, kind="stable")
    cuts = np.searchsorted(groups[order], np.arange(CLASSES + 1)).tolist()
    return order, [(c, slice(cuts[c], cuts[c + 1])) for c in range(CLASSES) if cuts[c + 1] > cuts[c]]


def softmax(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of each row and the log of what they were divided by; overwrites ``x`` with values less their row's top.

    One top serves all rows; rows that lie so far below it that nothing is left of them get their own.
    """
    x -= x.max(initial=-np.inf)
    e = np.exp(x)
    total = e @ np.ones(x.shape[1], x.dtype)
    low = total < 1e-30
    if low.any():
        x[low] -= x[low].max(axis=1, keepdims=True)
        e[low] = np.exp(x[low])
        total[low] = e[low].sum(axis=1)
    return e / total[:, None], np.log(total)


def word_logits(p: dict, states: np.ndarray, groups: list[tuple[int, slice]]) -> np.ndarray:
    """Per state, ordered by class, the values of the words of its symbol's class."""
    out = np.empty((len(states), PER_CLASS), np.float32)
    for c, at in groups:
        out[at] = states[at] @ p["word_w"][c] + p["word_b"][c]
    return out


def log_probabilities(p: dict, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Natural log probability of each symbol: that of its class, then that of the symbol within the class."""
    order, groups = by_class(symbols)
    rows = np.arange(len(symbols))
    classes = states @ p["class_w"] + p["class_b"]
    _, total = softmax(classes)
    out = classes[rows, symbols // PER_CLASS] - total
    words = word_logits(p, states[order], groups)
    _, total = softmax(words)
    out[order] += words[rows, symbols[order] % PER_CLASS] - total
    return out


def window_gradient(p: dict, symbols: np.ndarray, keep: np.ndarray, weight: np.ndarray, h: np.ndarray):
    """Loss, flat gradient and last state for one window; the gradient stops at the window's start."""
    trace: list = []
    states, last = forward(p, symbols, keep, h, trace)
    steps, lanes = symbols.shape
    flat = np.zeros(SIZE, np.float32)
    g = unpack(flat)
    s, x, w = states.reshape(-1, HIDDEN), symbols.reshape(-1).astype(np.intp), weight.reshape(-1, 1)
    rows, group = np.arange(len(x)), x // PER_CLASS
    classes = s @ p["class_w"] + p["class_b"]
    d, total = softmax(classes)
    loss = total - classes[rows, group]
    d[rows, group] -= 1
    d *= w
    g["class_w"][:], g["class_b"][:] = s.T @ d, d.sum(axis=0)
    ds = d @ p["class_w"].T
    order, groups = by_class(x)
    sorted_s, word = s[order], x[order] % PER_CLASS
    words = word_logits(p, sorted_s, groups)
    d, total = softmax(words)
    loss[order] += total - words[rows, word]
    d[rows, word] -= 1
    d *= w[order]
    back_s = np.empty_like(sorted_s)
    for c, at in groups:
        g["word_w"][c], g["word_b"][c] = sorted_s[at].T @ d[at], d[at].sum(axis=0)
        back_s[at] = d[at] @ p["word_w"][c].T
    ds[order] += back_s
    ds = np.ascontiguousarray(ds.reshape(steps, lanes, HIDDEN).transpose(0, 2, 1))
    dgiven = np.empty((3 * HIDDEN, steps, lanes), np.float32)
    after, dback = np.zeros((HIDDEN, lanes), np.float32), np.empty((3 * HIDDEN, lanes), np.float32)
    recur, drecur = p["recur"], np.zeros((3 * HIDDEN, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        z, r, new, back, h = trace[t]
        dnew = after * (1 - z) * (1 - new * new)
        dback[:HIDDEN] = after * (h - new) * z * (1 - z)
        dback[HIDDEN : 2 * HIDDEN] = dnew * back * r * (1 - r)
        dback[2 * HIDDEN :] = dnew * r
        dgiven[: 2 * HIDDEN, t], dgiven[2 * HIDDEN :, t] = dback[: 2 * HIDDEN], dnew
        drecur += dback @ h.T
        after = (after * z + recur @ dback + ds[t]) * keep[t]
    g["recur"][:] = drecur.T
    for k, column in enumerate(dgiven.reshape(3 * HIDDEN, -1)):
        g["inputs"][:, k] = np.bincount(x, weights=column, minlength=SYMBOLS)
    return float((loss * w[:, 0]).sum()), flat, last


class Adam:
    def __init__(self, rate: float):
        self.rate, self.m, self.v, self.t = rate, np.zeros(SIZE, np.float32), np.zeros(SIZE, np.float32), 0

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> None:
        norm = float(np.sqrt((gradient * gradient).sum()))
        gradient = gradient * min(1.0, 1.0 / (norm + 1e-9))
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.01 * (gradient * gradient - self.v)
        weights -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def train(flat: np.ndarray, segments: np.ndarray, window: int, lanes: int, least_steps: int, rate: float, seed: int, passes: int = 3, optimiser=None) -> np.ndarray:
    """Weights after passes over ``segments`` (rows of symbols, -1 as padding): one, or up to ``passes`` until ``least_steps`` steps.

    A segment is cut into windows; the state is carried from one to the next, the gradient is not.
    Every segment begins at an empty state.  An ``optimiser`` goes on where it was.
    """
    flat, optimiser = flat.copy(), optimiser or Adam(rate)
    p, rng, steps = unpack(flat), np.random.default_rng(seed), 0
    for _ in range(passes):
        if steps >= least_steps:
            break
        order = rng.permutation(len(segments))
        for at in range(0, len(order), lanes):
            batch = segments[order[at : at + lanes]].T
            h = np.zeros((batch.shape[1], HIDDEN), np.float32)
            for t in range(0, len(batch), window):
                x = batch[t : t + window]
                weight = (x >= 0).astype(np.float32)
                if not weight.any():
                    break
                _, gradient, h = window_gradient(p, np.maximum(x, 0), np.ones(x.shape, np.float32), weight / weight.sum(), h)
                optimiser.step(flat, gradient)
                steps += 1
    return flat


def pack(lengths: np.ndarray, most_lanes: int) -> list[list[int]]:
    """Texts dealt to lanes of about equal length, longest first."""
    total, longest = int(lengths.sum()), int(lengths.max(initial=1))
    lanes = int(np.clip(-(-total // max(longest, 1024)), 1, most_lanes))
    heap = [(0, k) for k in range(lanes)]
    out: list[list[int]] = [[] for _ in range(lanes)]
    for text in np.argsort(-lengths, kind="stable").tolist():
        size, lane = heapq.heappop(heap)
        out[lane].append(text)
        heapq.heappush(heap, (size + int(lengths[text]), lane))
    return out


def score(flat: np.ndarray, symbols: np.ndarray, first: np.ndarray, window: int = 32, most_lanes: int = 512) -> np.ndarray:
    """Natural log probability of each text; text k is ``symbols[first[k]:first[k + 1]]``.

    Texts run side by side in lanes, one after the other in each lane, with an empty state at each text's start and
    the state carried from window to window to its end.
    """
    p, lengths = unpack(flat), np.diff(first)
    out = np.zeros(len(lengths))
    lanes = pack(lengths, most_lanes)
    depth = max((int(lengths[lane].sum()) for lane in lanes), default=0)
    grid = np.full((depth, len(lanes)), -1, np.int16)
    owner = np.zeros((depth, len(lanes)), np.int32)
    keep = np.ones((depth, len(lanes)), np.float32)
    for k, lane in enumerate(lanes):
        at = 0
        for text in lane:
            n = int(lengths[text])
            if n:
                grid[at : at + n, k], owner[at : at + n, k], keep[at, k] = symbols[first[text] : first[text + 1]], text, 0
            at += n
    h = np.zeros((len(lanes), HIDDEN), np.float32)
    for t in range(0, depth, window):
        x = grid[t : t + window]
        states, h = forward(p, np.maximum(x, 0), keep[t : t + window], h)
        real = x >= 0
        found = log_probabilities(p, states[real], x[real].astype(np.int64))
        out += np.bincount(owner[t : t + window][real], weights=found, minlength=len(out))
    return out
