"""A small gated recurrent network in numpy with a class-factored output.

The output is P(class | state) * P(word | class, state). Words with vectors of
their own are normalised within their class; the other classes have a fixed
distribution over their words, so only the class is predicted there.

Training is truncated backpropagation: streams of documents are cut into windows,
the state runs on from window to window and is reset where a document begins.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

HIDDEN = 24
WINDOW, STREAMS = 24, 64


class Layout(NamedTuple):
    """``word_class[i]`` is the class of output word i, ``own[i]`` its place among words with vectors or -1;
    ``inputs[i]`` its row in the input table. Words with vectors lie class by class:
    those of class k from ``first[k]`` to ``first[k + 1]``."""

    word_class: np.ndarray
    own: np.ndarray
    inputs: np.ndarray
    first: np.ndarray
    n_inputs: int

    @property
    def classes(self) -> int:
        return len(self.first) - 1

    @property
    def start(self) -> int:
        """Input row that stands before the first word."""
        return self.n_inputs - 1


class Net(NamedTuple):
    table: np.ndarray  # (3, inputs, HIDDEN): a token's part of update, reset and new state
    gates: np.ndarray  # (3, HIDDEN, HIDDEN): the state's part
    to_class: np.ndarray  # (HIDDEN + 1, classes), the last row is the bias
    to_word: np.ndarray  # (words with vectors, HIDDEN + 1)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self])

    def filled(self, flat: np.ndarray) -> Net:
        ends = np.cumsum([x.size for x in self])
        return Net(*(p.reshape(x.shape).astype(np.float32) for p, x in zip(np.split(flat, ends[:-1]), self, strict=True)))


def fresh(layout: Layout, class_share: np.ndarray, word_share: np.ndarray) -> Net:
    """Small random weights; the biases give the shares of classes, and of words within them."""
    rng = np.random.default_rng(5)
    draw = lambda *shape: rng.normal(0, 0.08, shape).astype(np.float32)
    thirds = lambda x: np.stack(np.split(x, 3, axis=1))
    net = Net(
        thirds(draw(layout.n_inputs, 3 * HIDDEN)), thirds(draw(HIDDEN, 3 * HIDDEN)), draw(HIDDEN + 1, layout.classes),
        draw(len(word_share), HIDDEN + 1),
    )
    net.to_class[-1] = np.log(np.maximum(class_share, 1e-9))
    net.to_word[:, -1] = np.log(np.maximum(word_share, 1e-9))
    return net


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def step(net: Net, tokens: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
    """The next state, and what backpropagation needs."""
    z = _sigmoid(net.table[0].take(tokens, 0) + h @ net.gates[0])
    r = _sigmoid(net.table[1].take(tokens, 0) + h @ net.gates[1])
    u = h @ net.gates[2]
    n = net.table[2].take(tokens, 0)
    n += r * u
    np.tanh(n, out=n)
    after = h - n
    after *= z
    after += n
    return after, (h, z, r, n, u)


def _target_logs(x: np.ndarray, target: np.ndarray, d: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log softmax of each column's target; ``x`` is used up, and with ``d`` becomes the loss's gradient by itself."""
    columns = np.arange(x.shape[1])
    x -= x.max(0)
    at = x[target, columns]
    np.exp(x, out=x)
    sums = x.sum(0)
    if d:
        x /= sums
        x[target, columns] -= 1
    return at - np.log(sums), x


def outputs(net: Net, layout: Layout, states: np.ndarray, words: np.ndarray, grads: Net | None = None):
    """Log probability (natural) of each word at each state, without fixed distributions;
    with ``grads``, also the loss's gradient by the states, and ``grads`` is added to."""
    n = len(words)
    ones = np.concatenate([states, np.ones((n, 1), np.float32)], 1)
    classes = layout.word_class[words]
    out, d = _target_logs(net.to_class.T @ ones.T, classes, grads is not None)
    back = None
    if grads is not None:
        grads.to_class[:] += (d @ ones).T
        back = d.T @ net.to_class[:HIDDEN].T
    own = layout.own[words]
    order = np.nonzero(own >= 0)[0]
    # Own places lie class by class. A stable sort of short integers is a radix sort.
    order = order[np.argsort(own[order].astype(np.min_scalar_type(len(net.to_word))), kind="stable")]
    cuts = np.searchsorted(own[order], layout.first)
    for k in np.nonzero(np.diff(cuts))[0]:
        rows, low, high = order[cuts[k] : cuts[k + 1]], layout.first[k], layout.first[k + 1]
        w, mine = net.to_word[low:high], ones[rows]
        logs, d = _target_logs(w @ mine.T, own[rows] - low, grads is not None)
        out[rows] += logs
        if grads is not None:
            grads.to_word[low:high] += d @ mine
            back[rows] += d.T @ w[:, :HIDDEN]
    return out, back


# --- training ---------------------------------------------------------------------


def _add_rows(to: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """``np.add.at`` for each part of ``to``, with the rows of an index added up first."""
    order = np.argsort(index.astype(np.min_scalar_type(to.shape[1])), kind="stable")
    index = index[order]
    starts = np.nonzero(np.append(True, index[1:] != index[:-1]))[0]
    for part, new in zip(to, rows, strict=True):
        part[index[starts]] += np.add.reduceat(new.take(order, 0), starts, axis=0)


def streams(documents: list[np.ndarray], layout: Layout, most: int = STREAMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents laid end to end in ``most`` rows or fewer: inputs, words to predict, and where a document begins.
    The last row is filled up with the first words."""
    words = np.concatenate(documents)
    begins = np.zeros(len(words), bool)
    begins[np.cumsum([0, *map(len, documents[:-1])])] = True
    inputs = np.concatenate([[layout.start], layout.inputs[words[:-1]]])
    inputs[begins] = layout.start
    rows = max(1, min(most, len(words) // WINDOW))
    cut = lambda x: np.resize(x, (rows, -(-len(words) // rows)))
    return cut(inputs), cut(words), cut(begins)


def squares(net: Net) -> Net:
    """AdaGrad's sums of squares at the start."""
    return Net(*(np.full_like(x, 1e-2) for x in net))


def train(
    net: Net, layout: Layout, documents: list[np.ndarray], passes: int, rate: float, sums: Net | None = None, rows: int = STREAMS
) -> Net:
    """Truncated backpropagation with AdaGrad; documents are word numbers with the end as the last.
    ``sums`` are added to, so that training can go on with further documents."""
    if not documents:
        return net
    inputs, words, begins = streams(documents, layout, rows)
    net = Net(*(x.copy() for x in net))
    sums = squares(net) if sums is None else sums
    for _ in range(passes):
        h = np.zeros((len(inputs), HIDDEN), np.float32)
        for at in range(0, inputs.shape[1], WINDOW):
            x, y, b = (np.ascontiguousarray(v[:, at : at + WINDOW].T) for v in (inputs, words, begins))
            kept, states = [], np.empty((len(x), len(h), HIDDEN), np.float32)
            for t in range(len(x)):
                h[b[t]] = 0
                h, memory = step(net, x[t], h)
                kept.append(memory)
                states[t] = h
            grads = Net(*(np.zeros_like(v) for v in net))
            _, back = outputs(net, layout, states.reshape(-1, HIDDEN), y.ravel(), grads)
            back = back.reshape(len(x), -1, HIDDEN)
            by_token = np.empty((3, *states.shape), np.float32)
            by_reset = np.empty_like(states)
            dh = np.zeros_like(h)
            for t in reversed(range(len(x))):
                before, z, r, n, u = kept[t]
                dz, dr, dn = by_token[:, t]
                dh += back[t]
                away = dh * (1 - z)
                np.multiply(away, 1 - n * n, out=dn)
                np.multiply(away * z, before - n, out=dz)
                dnr = np.multiply(dn, r, out=by_reset[t])
                np.multiply(dnr * u, 1 - r, out=dr)
                dh *= z
                for d, gate in zip((dz, dr, dnr), net.gates, strict=True):
                    dh += d @ gate.T
                dh[b[t]] = 0
            befores = np.concatenate([memory[0] for memory in kept]).T
            for to, d in zip(grads.gates, (*by_token[:2], by_reset), strict=True):
                to += befores @ d.reshape(-1, HIDDEN)
            _add_rows(grads.table, x.ravel(), by_token.reshape(3, -1, HIDDEN))
            scale = np.float32(1 / rows)
            for v, s, g in zip(net, sums, grads, strict=True):
                g *= scale
                np.clip(g, -1, 1, out=g)
                s += g * g
                g *= np.float32(rate)
                g /= np.sqrt(s)
                v -= g
    return net


# --- scoring ----------------------------------------------------------------------


def log_likelihoods(net: Net, layout: Layout, documents: list[np.ndarray], batch: int = 512, window: int = 48):
    """Natural log probability of each whole document; its state runs through all of its windows."""
    total = np.zeros(len(documents))
    order = np.argsort([-len(d) for d in documents], kind="stable")
    for low in range(0, len(order), batch):
        part = order[low : low + batch]
        lengths = np.array([len(documents[i]) for i in part])
        words = np.concatenate([documents[i] for i in part])
        starts = np.cumsum([0, *lengths[:-1]])
        h = np.zeros((len(part), HIDDEN), np.float32)
        last = np.full(len(part), layout.start)
        for at in range(0, int(lengths[0]), window):
            live = int(np.searchsorted(-lengths, -at))  # longer documents come first
            width = min(window, int(lengths[0]) - at)
            steps = np.arange(at, at + width)[:, None]
            there = steps < lengths[:live]
            y = words[starts[:live] + np.minimum(steps, lengths[:live] - 1)]
            x = layout.inputs[y]
            h, states, x_t = h[:live], np.zeros((width, live, HIDDEN), np.float32), last[:live]
            lives = there.sum(1).tolist()
            for t, n in enumerate(lives):
                h[:n], _ = step(net, x_t[:n], h[:n])
                states[t] = h
                x_t = x[t]
            last = x_t
            logs, _ = outputs(net, layout, states[there], y[there])
            total[part[:live]] += np.bincount(np.nonzero(there)[1], logs, live)
    return total
