"""A gated recurrent language model in numpy: class-factored output, truncated backpropagation.

Inputs are numbers of words: 0 is the end of a text, below ``words`` are the
words that the model knows one by one, from there on a number for each class of
other words. P(word) = P(class | state) x P(word | class, state); for classes of
other words the second factor is left to the caller.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np

HIDDEN = 32
#: words of a class that the model knows one by one
PER_CLASS = 64
#: words of texts that a trainer holds; steps of its longest window
HELD, LONGEST = 4_000_000, 256


class Net(NamedTuple):
    """Input rows (to update, reset and candidate gates), recurrent weights, class output, word output."""

    inputs: np.ndarray
    recurrent: np.ndarray
    class_weights: np.ndarray
    class_bias: np.ndarray
    word_weights: np.ndarray
    word_bias: np.ndarray

    @property
    def words(self) -> int:
        return len(self.word_bias)

    @property
    def known_classes(self) -> int:
        return -(-self.words // PER_CLASS)

    def classes(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.words, ids // PER_CLASS, ids - self.words + self.known_classes)

    def to_bytes(self) -> bytes:
        return b"".join(a.astype("<f4").tobytes() for a in self)

    def like(self, data: bytes) -> Net:
        out, at = [], 0
        for a in self:
            out.append(np.frombuffer(data, "<f4", a.size, at).reshape(a.shape).astype(np.float32))
            at += 4 * a.size
        return Net(*out)


def new_net(counts: np.ndarray, other_counts: np.ndarray, seed: int = 1) -> Net:
    """A net that starts as the unigram model: ``counts`` of the known words (most frequent first), ``other_counts`` of the other classes."""
    rng = np.random.default_rng(seed)
    words, others = len(counts), len(other_counts)
    mass = counts.astype(np.float64) + 0.1
    known = np.add.reduceat(mass, np.arange(0, words, PER_CLASS))
    classes = np.concatenate([known, other_counts + 0.1])
    f = lambda *shape: (0.1 * rng.standard_normal(shape)).astype(np.float32)
    return Net(
        f(words + others, 3 * HIDDEN),
        f(HIDDEN, 3 * HIDDEN),
        f(HIDDEN, len(classes)) * np.float32(0.1),
        np.log(classes / classes.sum()).astype(np.float32),
        f(words, HIDDEN) * np.float32(0.1),
        np.log(mass / known[np.arange(words) // PER_CLASS]).astype(np.float32),
    )


class Space(dict):
    """Arrays that are used again window after window, so that their memory is not fetched anew each time."""

    def array(self, name: str, dtype: np.dtype, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if (name, dtype) not in self or self[name, dtype].size < size:
            self[name, dtype] = np.empty(size, dtype=dtype)
        return self[name, dtype][:size].reshape(shape)


class Window(NamedTuple):
    """What a stretch of steps leaves for the backward pass: states before, gates, and parts of the candidates, (steps, units, lanes) each."""

    before: np.ndarray
    gates: np.ndarray
    tails: np.ndarray
    candidates: np.ndarray


def read_window(net: Net, inputs: np.ndarray, begins: np.ndarray, h: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray, Window]:
    """States after each step of ``inputs`` (steps x lanes) as rows, and the last as (units, lanes), which ``h`` is too.

    A lane whose text ``begins`` there drops its state before. The arrays are the ``space``'s, but for the last state.
    """
    steps, lanes = inputs.shape
    kind = net.inputs.dtype
    rows = space.array("rows", kind, steps * lanes, 3 * HIDDEN)
    np.take(net.inputs, inputs.reshape(-1), axis=0, out=rows, mode="clip")
    x = space.array("x", kind, steps, 3 * HIDDEN, lanes)
    x[:] = rows.reshape(steps, lanes, 3 * HIDDEN).transpose(0, 2, 1)
    weights = np.ascontiguousarray(net.recurrent.T)
    before, states, tails, candidates = (space.array(name, kind, steps, HIDDEN, lanes) for name in ("before", "states", "tails", "candidates"))
    gates = x[:, : 2 * HIDDEN]
    u, resets = np.empty((3 * HIDDEN, lanes), dtype=kind), begins.any(axis=1).tolist()
    # the gates are 1 / (1 + exp(-x))
    weights[: 2 * HIDDEN] *= -1
    np.negative(gates, out=gates)
    with np.errstate(over="ignore"):  # beyond single precision a gate is 0, as it should be
        for t in range(steps):
            old, g, n = before[t], gates[t], candidates[t]
            old[:] = h
            if resets[t]:
                old[:, begins[t]] = 0
            np.matmul(weights, old, out=u)
            g += u[: 2 * HIDDEN]
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            tails[t] = u[2 * HIDDEN :]
            np.multiply(g[HIDDEN:], u[2 * HIDDEN :], out=n)
            n += x[t, 2 * HIDDEN :]
            np.tanh(n, out=n)
            h = states[t]
            np.subtract(old, n, out=h)
            h *= g[:HIDDEN]
            h += n
    return _as_rows(states, space.array("state rows", kind, steps * lanes, HIDDEN)), h.copy(), Window(before, gates, tails, candidates)


def _as_rows(a: np.ndarray, out: np.ndarray) -> np.ndarray:
    """(steps, units, lanes) as a row of units for each step and lane."""
    out.reshape(len(a), -1, a.shape[1])[:] = a.transpose(0, 2, 1)
    return out


def step(net: Net, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, Window]:
    """The next state of each lane, and what the backward pass needs of it."""
    states, _, kept = read_window(net, ids[None], np.zeros((1, len(ids)), dtype=bool), h.T, Space())
    return states, kept


def _with_one(states: np.ndarray, space: Space) -> np.ndarray:
    """States with a column of ones, which meets the biases."""
    out = space.array("with one", states.dtype, len(states), HIDDEN + 1)
    out[:, :HIDDEN], out[:, HIDDEN] = states, 1
    return out


class _Output(NamedTuple):
    """Weights of the output layers with the biases below, class by class; words fill up the last class that have no probability."""

    classes: np.ndarray
    words: np.ndarray
    bounded: bool

    @classmethod
    def of(cls, net: Net, states: np.ndarray) -> _Output:
        rows = np.zeros((net.known_classes * PER_CLASS, HIDDEN + 1), dtype=net.word_weights.dtype)
        rows[: net.words, :HIDDEN], rows[: net.words, HIDDEN] = net.word_weights, net.word_bias
        classes = np.concatenate([net.class_weights, net.class_bias[None]])
        ones = np.ones(HIDDEN + 1, dtype=rows.dtype)
        most = max(1.0, states.max(initial=0), -states.min(initial=0)) * max((ones @ np.abs(classes)).max(), (np.abs(rows) @ ones).max())
        rows[net.words :, HIDDEN] = -np.inf
        return cls(classes, np.ascontiguousarray(rows.reshape(-1, PER_CLASS, HIDDEN + 1).transpose(0, 2, 1)), bool(most < 60))

    def class_logits(self, states: np.ndarray, space: Space) -> np.ndarray:
        return np.matmul(states, self.classes, out=space.array("class logits", states.dtype, len(states), self.classes.shape[1]))

    def word_logits(self, states: np.ndarray, parts: list[tuple[int, int, int]], space: Space) -> np.ndarray:
        """Of the words of its own class in each row; the rows of a class follow each other."""
        out = space.array("word logits", states.dtype, len(states), PER_CLASS)
        for c, i, j in parts:
            np.matmul(states[i:j], self.words[c], out=out[i:j])
        return out

    def log_shares(self, logits: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Log softmax at one column of each row. The logits become exponentials; the maximum is only taken off where one could overflow."""
        if not self.bounded and len(logits):
            logits -= logits.max(axis=1, keepdims=True)
        chosen = logits[np.arange(len(logits)), columns]
        np.exp(logits, out=logits)
        return chosen - np.log(logits @ np.ones(logits.shape[1], dtype=logits.dtype))

    def slopes(self, logits: np.ndarray, columns: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
        """Gradient of the weighted loss by the logits, which it overwrites, and that loss."""
        loss = -float(w @ self.log_shares(logits, columns))
        logits *= (w / (logits @ np.ones(logits.shape[1], dtype=logits.dtype)))[:, None]
        logits[np.arange(len(logits)), columns] -= w
        return logits, loss


def _by_class(classes: np.ndarray, known: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The rows of known classes in order of class, and (class, begin, end) of each among them."""
    order = np.argsort(classes.astype(np.uint16), kind="stable")
    ends = np.searchsorted(classes[order], np.arange(known + 1)).tolist()
    return order[: ends[-1]], [(c, a, b) for c, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]


def log_probabilities(net: Net, states: np.ndarray, targets: np.ndarray, space: Space | None = None) -> np.ndarray:
    """Natural log of P(class), and for known words of P(word | class) too, in double precision."""
    space = Space() if space is None else space
    output, classes, states = _Output.of(net, states), net.classes(targets), _with_one(states, space)
    out = output.log_shares(output.class_logits(states, space), classes).astype(np.float64)
    order, parts = _by_class(classes, net.known_classes)
    out[order] += output.log_shares(output.word_logits(states[order], parts, space), targets[order] % PER_CLASS)
    return out


def _summed(rows: np.ndarray, ids: np.ndarray, few: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids and the sum of the rows of each. ``few`` rows of all ids are added side by side, what is left of an id by itself."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    first = np.flatnonzero(np.diff(ids[order], prepend=-1))
    count = np.diff(first, append=len(ids))
    most = np.argsort(-count, kind="stable")
    first, count = first[most], count[most]
    out = rows[order[first]]
    with_more = np.searchsorted(-count, -np.arange(1, few + 1), side="left").tolist()
    for k, n in enumerate(with_more[:-1], 1):
        out[:n] += rows[order[first[:n] + k]]
    for i in range(with_more[-1]):
        out[i] += rows[order[first[i] + few : first[i] + count[i]]].sum(axis=0)
    return ids[order[first]], out


def _gradient(net: Net, inputs: np.ndarray, targets: np.ndarray, weight: np.ndarray, h: np.ndarray, space: Space) -> tuple[Net, np.ndarray, np.ndarray | slice, np.ndarray, float]:
    """As :func:`window_gradient`, with only the input rows and word rows that the window used, and which these are; ``h`` as (units, lanes)."""
    steps, lanes = inputs.shape
    begins = inputs == 0
    s, h, (before, gates, tails, candidates) = read_window(net, inputs, begins, h, space)
    y, w = targets.reshape(-1), weight.reshape(-1).astype(s.dtype)
    w /= max(float(w.sum()), 1.0)
    output, classes, with_one = _Output.of(net, s), net.classes(y), _with_one(s, space)
    d, loss = output.slopes(output.class_logits(with_one, space), classes, w)
    g_class, ds = with_one.T @ d, np.matmul(d, net.class_weights.T, out=space.array("ds", s.dtype, *s.shape))
    order, parts = _by_class(classes, net.known_classes)
    own = with_one[order]
    d, more = output.slopes(output.word_logits(own, parts, space), y[order] % PER_CLASS, w[order])
    loss += more
    g_word, own_ds = np.zeros_like(output.words), np.empty((len(own), HIDDEN), dtype=s.dtype)
    for c, i, j in parts:
        a, b = c * PER_CLASS, min((c + 1) * PER_CLASS, net.words)
        np.matmul(own[i:j].T, d[i:j], out=g_word[c])
        np.matmul(d[i:j, : b - a], net.word_weights[a:b], out=own_ds[i:j])
    ds[order] += own_ds
    g_words, g_word_bias = g_word[:, :HIDDEN].transpose(0, 2, 1).reshape(-1, HIDDEN)[: net.words], g_word[:, HIDDEN].reshape(-1)[: net.words]
    used = slice(None) if len(parts) == net.known_classes else np.flatnonzero(np.isin(np.arange(net.words) // PER_CLASS, [c for c, *_ in parts]))
    by_lane = space.array("ds by lane", s.dtype, steps, HIDDEN, lanes)
    by_lane[:] = ds.reshape(steps, lanes, HIDDEN).transpose(0, 2, 1)
    ds = by_lane
    z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
    rest = np.subtract(1, z, out=space.array("rest", s.dtype, steps, HIDDEN, lanes))
    by_update = np.subtract(before, candidates, out=space.array("by update", s.dtype, steps, HIDDEN, lanes))
    by_update *= z
    by_update *= rest
    candidates *= candidates
    by_candidate = np.subtract(1, candidates, out=candidates)
    by_candidate *= rest
    tails *= r
    by_reset = np.multiply(tails, np.subtract(1, r, out=rest), out=tails)
    du, dn = space.array("du", s.dtype, steps, 3 * HIDDEN, lanes), space.array("dn", s.dtype, steps, HIDDEN, lanes)
    back, resets = np.zeros_like(h), begins.any(axis=1).tolist()
    for t in range(steps - 1, -1, -1):
        dh, d, n = ds[t], du[t], dn[t]
        dh += back
        np.multiply(dh, by_candidate[t], out=n)
        np.multiply(dh, by_update[t], out=d[:HIDDEN])
        np.multiply(n, by_reset[t], out=d[HIDDEN : 2 * HIDDEN])
        np.multiply(n, r[t], out=d[2 * HIDDEN :])
        np.matmul(net.recurrent, d, out=back)
        dh *= z[t]
        back += dh
        if resets[t]:
            back[:, begins[t]] = 0
    dx = _as_rows(du, space.array("rows", s.dtype, steps * lanes, 3 * HIDDEN))
    g_recurrent = _as_rows(before, s).T @ dx  # the states have served
    dx[:, 2 * HIDDEN :] = _as_rows(dn, s)
    rows, g_inputs = _summed(dx, inputs.reshape(-1))
    return Net(g_inputs, g_recurrent, g_class[:HIDDEN], g_class[HIDDEN], g_words[used], g_word_bias), rows, used, h, loss


def window_gradient(net: Net, inputs: np.ndarray, targets: np.ndarray, weight: np.ndarray, h: np.ndarray) -> tuple[Net, np.ndarray, float]:
    """Gradient of the mean loss of a window (steps x lanes), the state after it, and the loss.

    Nothing flows to before the window, and no state from one text to the next (which input 0 begins).
    """
    found, rows, used, h, loss = _gradient(net, inputs, targets, weight, h.T, Space())
    whole = found._replace(inputs=np.zeros_like(net.inputs), word_weights=np.zeros_like(net.word_weights))
    whole.inputs[rows], whole.word_weights[used] = found.inputs, found.word_weights
    return whole, h.T, loss


class Lanes(NamedTuple):
    """Whole texts one after another in lanes of about equal length, (lanes, 1 + steps) each: words, and whose text each is (-1: none)."""

    words: np.ndarray
    whose: np.ndarray

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Inputs, targets, whose they are and where texts begin, (steps, lanes) each."""
        for at in range(0, self.words.shape[1] - 1, steps):
            words = self.words[:, at : at + steps + 1].T.astype(np.int64)
            whose = np.ascontiguousarray(self.whose[:, at : at + steps + 1].T)
            begins = whose[1:] != whose[:-1]
            words[:-1][begins] = -1
            yield np.maximum(words[:-1], 0), self.words[:, at + 1 : at + steps + 1].T.astype(np.int64), whose[1:], begins


def side_by_side(texts: list[np.ndarray], lanes: int) -> Lanes:
    """At most ``lanes`` lanes, and no more than the longest text leaves full: the longest go first, each to the lane with least.

    Within a lane texts keep their order.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    count = int(max(1, min(lanes, sizes.sum() // max(1, sizes.max(initial=0)))))
    parts: list[list[int]] = [[] for _ in range(count)]
    ends = [(0, i) for i in range(count)]
    for i in np.argsort(-sizes, kind="stable").tolist():
        n, at = ends[0]
        heapq.heapreplace(ends, (n + int(sizes[i]), at))
        parts[at].append(i)
    steps = max(n for n, _ in ends)
    found = Lanes(np.zeros((count, 1 + steps), dtype=np.int32), np.full((count, 1 + steps), -1, dtype=np.int32))
    for words, whose, own in zip(*found, parts):
        at = 1
        for i in sorted(own):
            words[at : at + sizes[i]], whose[at : at + sizes[i]] = texts[i], i
            at += int(sizes[i])
    return found


def _gathered(batches: Iterable[list[np.ndarray]], most: int) -> Iterator[list[np.ndarray]]:
    """The texts of batches together, until they have ``most`` words."""
    texts, words = [], 0
    for batch in batches:
        texts.extend(batch)
        words += sum(map(len, batch))
        if words >= most:
            yield texts
            texts, words = [], 0
    if texts:
        yield texts


class Trainer:
    """Adam over windows of texts that are read whole, side by side in lanes, with the state carried on."""

    def __init__(self, net: Net, rate: float = 0.01, window: int = 16, clip: float = 1.0):
        self.net = Net(*[a.copy() for a in net])
        self.rate, self.window, self.clip = rate, window, clip
        self.mean = [np.zeros_like(a) for a in net]
        self.square = [np.zeros_like(a) for a in net]
        self.steps, self.most = 0, 0
        self.space = Space()

    def learn(self, batches: Iterable[list[np.ndarray]], lanes: int) -> tuple[int, float]:
        """Learns once from every word and end of the texts (ids of the words and the end); how many, and their summed loss.

        Held are the texts of about ``HELD`` words at a time, side by side in up to
        ``lanes`` lanes. With fewer lanes windows are longer, so a
        window has about as many words.
        """
        seen, loss = 0, 0.0
        for texts in _gathered(batches, HELD):
            grid = side_by_side(texts, lanes)
            count = len(grid.words)
            window = min(LONGEST, max(self.window, self.window * lanes // count))
            h = np.zeros((HIDDEN, count), dtype=np.float32)
            for inputs, targets, whose, _ in grid.windows(window):
                real = whose >= 0
                words = int(real.sum())
                gradient, rows, used, h, mean_loss = _gradient(self.net, inputs, targets, real, h, self.space)
                self.most = max(self.most, words)
                self.update(gradient, rows, used, words / self.most)
                seen, loss = seen + words, loss + mean_loss * words
        return seen, loss

    def update(self, gradient: Net, rows: np.ndarray, used: np.ndarray | slice, share: float = 1.0) -> None:
        """A step of Adam, shorter where a window has only a ``share`` of the words of others. Input and word rows that no word of the window used keep their averages as they are."""
        self.steps += 1
        norm = float(np.sqrt(sum(float(np.vdot(g, g)) for g in gradient)))
        scale = np.float32(min(1.0, self.clip / max(norm, 1e-9)))
        correct = np.float32(share * self.rate * (1 - 0.99**self.steps) ** 0.5 / (1 - 0.9**self.steps))
        every = slice(None)
        for a, mean, square, g, at in zip(self.net, self.mean, self.square, gradient, (rows, every, every, every, used, every)):
            g = g * scale
            m, v = mean[at], square[at]
            m *= np.float32(0.9)
            m += np.float32(0.1) * g
            g *= g
            g *= np.float32(0.01)
            v *= np.float32(0.99)
            v += g
            if at is not every:
                mean[at], square[at] = m, v
            np.sqrt(v, out=g)
            g += np.float32(1e-6)
            np.divide(m, g, out=g)
            g *= correct
            a[at] -= g


def score_texts(net: Net, texts: list[np.ndarray], held: int = 1 << 13, lanes: int = 512) -> np.ndarray:
    """Log likelihood of each whole text (ids of its words and the end), the state carried from its first word to its last.

    About ``held`` states at a time are turned into probabilities.
    """
    grid = side_by_side(texts, lanes)
    count = len(grid.words)
    h = np.zeros((HIDDEN, count), dtype=np.float32)
    total, space = np.zeros(len(texts)), Space()
    for inputs, targets, whose, begins in grid.windows(max(1, held // count)):
        states, h, _ = read_window(net, inputs, begins, h, space)
        real = np.flatnonzero(whose >= 0)
        logs = log_probabilities(net, states[real], targets.reshape(-1)[real], space)
        total += np.bincount(whose.reshape(-1)[real], weights=logs, minlength=len(total))
    return total
