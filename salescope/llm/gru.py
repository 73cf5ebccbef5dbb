"""A gated recurrent language model in numpy, with a class-factored softmax and truncated backpropagation.

Tokens are numbers by falling frequency.  Number 0 stands for every word outside the vocabulary and is a
class of its own; the others form classes of ``MEMBERS`` neighbours.  A token's probability is that of
its class times that of the token within it.  The model begins at the frequencies it is given.

Documents are laid out in lanes, one after another, and all lanes step together.  The state is zero at
the start of a document, and carried from window to window within it; only gradients stop at the
edge of a window.
"""

from __future__ import annotations

import numpy as np

EMBED, HIDDEN, MEMBERS = 16, 16, 32
WINDOW = 20
STEP = 400  # tokens at least whose gradients make one step: few lanes are left when the longest documents end
Params = dict[str, np.ndarray]


def start(counts: np.ndarray, seed: int = 7) -> Params:
    """Parameters for tokens with these counts; their number less one is a multiple of ``MEMBERS``, or is filled up to one."""
    words = np.asarray(counts[1:], dtype=np.float64) + 1.0
    classes = max(1, -(-len(words) // MEMBERS))
    table = np.full(classes * MEMBERS, 1e-30)
    table[: len(words)] = words
    table = table.reshape(classes, MEMBERS)
    mass = np.append(float(counts[0]) + 1.0, table.sum(axis=1))
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    bias = np.zeros(3 * HIDDEN, dtype=np.float32)
    return {
        "emb": draw(1 + classes * MEMBERS, EMBED),
        "wx": draw(EMBED, 3 * HIDDEN),
        "u": draw(HIDDEN, 3 * HIDDEN),
        "b": bias,
        "wc": np.zeros((HIDDEN, 1 + classes), dtype=np.float32),
        "bc": np.log(mass / mass.sum()).astype(np.float32),
        "wo": np.zeros((classes, HIDDEN, MEMBERS), dtype=np.float32),
        "bo": np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32),
    }


def lanes(sizes: np.ndarray, width: int) -> list[np.ndarray]:
    """Documents dealt to at most ``width`` lanes, the longest first, each to the shortest lane; longest lanes first."""
    import heapq

    heap = [(0, i) for i in range(min(width, len(sizes)))]
    held: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-sizes, kind="stable").tolist():
        n, i = heapq.heappop(heap)
        held[i].append(d)
        heapq.heappush(heap, (n + int(sizes[d]), i))
    return [np.array(x, dtype=np.int64) for _, x in sorted(((-int(sizes[x].sum()), x) for x in held), key=lambda p: p[0])]


class Layout:
    """Tokens of documents in lanes, laid end to end; lanes end one after another, the longest last, so none is padded."""

    def __init__(self, tokens: np.ndarray, begin: np.ndarray, width: int, first: int):
        """``tokens`` of all documents, each from its ``begin`` on (one more place at the end); ``first`` comes before a document."""
        sizes = np.diff(begin)
        order = lanes(sizes, width)
        docs = np.concatenate(order) if order else np.empty(0, np.int64)
        length = np.array([int(sizes[x].sum()) for x in order], dtype=np.int64)
        heads = np.cumsum(sizes[docs]) - sizes[docs]
        own = np.arange(int(sizes.sum())) + np.repeat(begin[docs] - heads, sizes[docs])
        self._target = tokens[own].astype(np.int32)
        self._doc = np.repeat(docs, sizes[docs]).astype(np.int32)
        self._input = np.roll(self._target, 1)
        self._fresh = np.zeros(len(own), dtype=bool)
        heads = heads[sizes[docs] > 0]
        self._input[heads] = first
        self._fresh[heads] = True
        self._lane = np.cumsum(length) - length
        self.steps, self.width = (int(length.max()) if len(length) else 0), len(order)
        self.active = np.searchsorted(-length, -np.arange(self.steps), "left")  # lanes still going at a step

    def at(self, t: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lanes still going at step ``t``, and their inputs, targets, documents, and whether those begin here."""
        n = int(self.active[t])
        place = self._lane[:n] + t
        return n, self._input[place], self._target[place], self._doc[place], self._fresh[place]


def _output(p: Params, h: np.ndarray, target: np.ndarray, learn: Params | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural logarithms of the targets' probabilities after states ``h``; with ``learn``, gradients are added there, and those of ``h`` returned."""
    n = len(target)
    rows = np.arange(n)
    kind = np.where(target > 0, (target - 1) // MEMBERS + 1, 0)
    x = h @ p["wc"]
    x += p["bc"]
    np.minimum(x, 80, out=x)  # states are within 1, so only a runaway weight is cut
    out = x[rows, kind]
    e = np.exp(x, out=x)
    total = e @ np.ones(e.shape[1], e.dtype)
    out -= np.log(total)
    back = None
    if learn is not None:
        e /= total[:, None]
        e[rows, kind] -= 1
        learn["wc"] += h.T @ e
        learn["bc"] += e.sum(axis=0)
        back = e @ p["wc"].T
    order = np.argsort(kind, kind="stable")
    stops = np.searchsorted(kind[order], np.arange(1, p["wo"].shape[0] + 2))
    order, stops = order[stops[0] :], stops - stops[0]  # words of a class lie side by side
    hs, place, inside = h.take(order, axis=0), (target[order] - 1) % MEMBERS, np.zeros(len(order))
    ones = np.ones(MEMBERS, h.dtype)
    behind = np.zeros_like(hs) if learn is not None else None
    for c in np.flatnonzero(np.diff(stops)).tolist():
        own = slice(stops[c], stops[c + 1])
        at = rows[: own.stop - own.start]
        y = hs[own] @ p["wo"][c]
        y += p["bo"][c]
        np.minimum(y, 80, out=y)
        inside[own] = y[at, place[own]]
        e = np.exp(y, out=y)
        total = e @ ones
        inside[own] -= np.log(total)
        if learn is not None:
            e /= total[:, None]
            e[at, place[own]] -= 1
            learn["wo"][c] += hs[own].T @ e
            learn["bo"][c] += e.sum(axis=0)
            behind[own] = e @ p["wo"][c].T
    out[order] += inside
    if learn is not None:
        back[order] += behind
    return out, back


def score(p: Params, layout: Layout, docs: int) -> np.ndarray:
    """Natural log-likelihood of each document."""
    out = np.zeros(docs)
    state = np.zeros((layout.width, HIDDEN), dtype=np.float32)
    project, half = p["emb"] @ p["wx"] + p["b"], p["u"].copy()
    for x in (project, half):
        x[:, : 2 * HIDDEN] *= 0.5  # a sigmoid is a hyperbolic tangent of half its argument
    for at in range(0, layout.steps, WINDOW):
        steps = [layout.at(t) for t in range(at, min(at + WINDOW, layout.steps))]
        inputs, targets, docs_of = (np.concatenate([s[i] for s in steps]) for i in (1, 2, 3))
        xs, hs, end = project.take(inputs, axis=0), np.empty((len(inputs), HIDDEN), project.dtype), 0
        for n, _, _, _, fresh in steps:
            own, end = slice(end, end + n), end + n
            h, x = state[:n], xs[own]
            h[fresh] = 0
            g = h @ half
            zr = g[:, : 2 * HIDDEN]
            zr += x[:, : 2 * HIDDEN]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            new = zr[:, HIDDEN:] * g[:, 2 * HIDDEN :]
            new += x[:, 2 * HIDDEN :]
            np.tanh(new, out=new)
            # The state before a token's input predicts nothing; the one after it predicts the target.
            h -= new
            h *= zr[:, :HIDDEN]
            h += new
            hs[own] = h
        got, _ = _output(p, hs, targets, None)
        out += np.bincount(docs_of, got, minlength=docs)
    return out


class Trainer:
    """Adam over windows of all lanes."""

    def __init__(self, p: Params, rate: float = 0.01):
        self.p = {k: v.astype(np.float32).copy() for k, v in p.items()}
        self.rate, self.t, self.tokens = rate, 0, 0
        self.grad, self.held = {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}

    def run(self, layout: Layout) -> None:
        state = np.zeros((layout.width, HIDDEN), dtype=np.float32)
        for at in range(0, layout.steps, WINDOW):
            self._window(layout, at, min(at + WINDOW, layout.steps), state)

    def finish(self) -> None:
        """The step for tokens that didn't fill one."""
        if self.held:
            self._step()

    def _window(self, layout: Layout, at: int, stop: int, state: np.ndarray) -> None:
        p, grad = self.p, self.grad
        steps = [layout.at(t) for t in range(at, stop)]
        ends = np.cumsum([s[0] for s in steps])
        inputs, targets = (np.concatenate([s[i] for s in steps]) for i in (1, 2))
        e = p["emb"].take(inputs, axis=0)
        x = e @ p["wx"] + p["b"]
        x[:, : 2 * HIDDEN] *= 0.5
        half = p["u"].copy()
        half[:, : 2 * HIDDEN] *= 0.5  # a sigmoid is a hyperbolic tangent of half its argument
        h, new, hs = (np.empty((len(inputs), HIDDEN), x.dtype) for _ in range(3))
        g = np.empty_like(x)  # update and reset gates, and the recurrent part of the new state
        for (n, _, _, _, fresh), end in zip(steps, ends.tolist()):
            own = slice(end - n, end)
            h[own] = state[:n]
            h[own][fresh] = 0
            step = h[own] @ half
            zr = step[:, : 2 * HIDDEN]
            zr += x[own, : 2 * HIDDEN]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            g[own] = step
            np.tanh(x[own, 2 * HIDDEN :] + zr[:, HIDDEN:] * step[:, 2 * HIDDEN :], out=new[own])
            np.add(new[own], zr[:, :HIDDEN] * (h[own] - new[own]), out=hs[own])
            state[:n] = hs[own]
        _, back = _output(p, hs, targets, grad)
        z, r, inner = g[:, :HIDDEN].copy(), g[:, HIDDEN : 2 * HIDDEN].copy(), g[:, 2 * HIDDEN :]
        by_new = (1 - z) * (1 - new * new)
        # Gradients at the gates per unit of the state's.
        unit = np.concatenate([(h - new) * z * (1 - z), by_new * inner * r * (1 - r), by_new * r], axis=1).reshape(-1, 3, HIDDEN)
        to_g = np.empty_like(unit)
        ahead = np.zeros((layout.width, HIDDEN), dtype=back.dtype)
        turned = p["u"].T.copy()
        for (n, _, _, _, fresh), end in zip(steps[::-1], ends[::-1].tolist()):
            own = slice(end - n, end)
            d = back[own]
            d += ahead[:n]
            np.multiply(unit[own], d[:, None, :], out=to_g[own])
            to = to_g[own].reshape(n, -1) @ turned
            to += d * z[own]
            to[fresh] = 0
            ahead[:n] = to
        to_g = to_g.reshape(len(inputs), -1)
        grad["u"] += h.T @ to_g
        to_g[:, 2 * HIDDEN :] = back * by_new  # now at the input's side
        grad["wx"] += e.T @ to_g
        grad["b"] += to_g.sum(axis=0)
        at_emb = inputs[:, None].astype(np.int64) * EMBED + np.arange(EMBED)
        grad["emb"] += np.bincount(at_emb.ravel(), (to_g @ p["wx"].T).ravel(), grad["emb"].size).reshape(grad["emb"].shape).astype(grad["emb"].dtype)
        self.tokens += int(ends[-1])
        self.held += int(ends[-1])
        if self.held >= STEP:
            self._step()

    def _step(self) -> None:
        self.t += 1
        for k, g in self.grad.items():
            g /= self.held
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.99**self.t)
            self.p[k] -= (self.rate * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
            g[...] = 0
        self.held = 0


def to_bytes(p: Params) -> bytes:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float32).tobytes()


def from_values(values: np.ndarray, like: Params) -> Params:
    out, at = {}, 0
    for k in sorted(like):
        n = like[k].size
        out[k] = values[at : at + n].reshape(like[k].shape).astype(np.float32)
        at += n
    return out
