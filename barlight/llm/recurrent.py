"""A gated recurrent language model in numpy: forward, truncated backpropagation, class-factored softmax.

A word's probability is that of its class, times that of its group in the class, times its own in the group. Texts run in lanes side by side, one after another in each lane. The state is carried from window to
window until a text ends.
"""

from __future__ import annotations

import ctypes
import math
from dataclasses import dataclass
from pathlib import Path

import numpy as np

#: Steps of a window: gradients go no further back.
WINDOW = 20
#: Tokens of a text that are learned in one go: no more than a lane is filled with, or long texts run on almost alone.
PART = 2048
#: Logits that are held at a time, and weights that are moved on at a time: each a core's cache or less.
HELD, PIECE = 48 << 10, 16 << 10
#: Words of a group, the probability of a place of a group that no word has (as a logarithm), and tokens whose groups are held at a time.
GROUP, NONE, GROUPED = 8, -1e4, 1024
#: Tokens whose words are scored at a time, and rows of a run from which on it is summed by itself.
SCORED, LONG = 32 << 10, 8


def one_thread() -> None:
    """Matrix products of this process on one core, where numpy's library lets that be set.

    Spark runs a task on each core. Threads of small products wait for each other most of the time, which
    takes twice the CPU for no gain.
    """
    loaded = {x.split()[-1] for x in Path("/proc/self/maps").read_text().splitlines() if "openblas" in x} if Path("/proc/self/maps").exists() else set()
    for path in loaded:
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


@dataclass(frozen=True)
class Classes:
    """Words 0 .. n-1 by falling count; word n stands for all others and is the last group and class, alone.

    The first words are groups by themselves, those behind them make groups of GROUP words. Neighbouring groups are a class.
    """

    words: int  # n
    alone: int  # first words that are groups by themselves
    of: np.ndarray  # class of each group
    place: np.ndarray  # place in its class
    start: np.ndarray  # first group of each class, and the end

    @classmethod
    def by_count(cls, counts: np.ndarray) -> Classes:
        """0.8 times the root of the number of groups, each class of the same sum of roots of counts."""
        words = len(counts)
        alone = min(words, 2 * math.isqrt(words))
        counts = np.add.reduceat(counts, np.r_[np.arange(alone), np.arange(alone, words, GROUP)]) if words else counts
        n = len(counts)
        mass = np.cumsum(np.sqrt(np.maximum(counts, 1e-9)))
        wanted = max(1, int(0.8 * np.sqrt(n)))
        raw = np.minimum((mass - mass[0]) / max(mass[-1], 1e-9) * wanted, wanted - 1).astype(np.int64) if n else np.zeros(0, np.int64)
        of = np.append(np.unique(raw, return_inverse=True)[1] if n else raw, (len(np.unique(raw)) if n else 0)).astype(np.int64)
        start = np.append(np.flatnonzero(np.r_[True, of[1:] != of[:-1]]), n + 1)
        return cls(words, alone, of, np.arange(n + 1) - start[of], start)

    @property
    def leaves(self) -> int:
        """Groups of GROUP words."""
        return -(-(self.words - self.alone) // GROUP)

    def group(self, words: np.ndarray) -> np.ndarray:
        return np.where(words < self.alone, words, np.where(words < self.words, self.alone + (words - self.alone) // GROUP, self.alone + self.leaves))


class Model:
    """Weights: x (word to gates), u (state to gates), b, c (state to classes), w (state to groups), l (state to the words of each
    group of GROUP, a row a group).

    The last column of c, of w and for each word of l is the bias: states are followed by a 1.
    """

    NAMES = ("x", "u", "b", "c", "w", "l")

    def __init__(self, classes: Classes, weights: dict[str, np.ndarray]):
        self.classes, self.p = classes, {n: np.ascontiguousarray(w) for n, w in weights.items()}
        self.hidden = weights["u"].shape[0]

    @classmethod
    def start(cls, counts: np.ndarray, rest: float, hidden: int = 16, seed: int = 1) -> Model:
        """Begins at the plain word frequencies: state has no say yet in which word comes."""
        classes = Classes.by_count(counts)
        rng = np.random.default_rng(seed)
        every = np.append(counts, max(rest, 1)).astype(float) + 0.5
        groups = np.bincount(classes.group(np.arange(len(every))), weights=every)
        mass = np.add.reduceat(groups, classes.start[:-1])
        inside = every[classes.alone : -1] / groups[classes.group(np.arange(classes.alone, len(counts)))]
        f = np.float32
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(f)
        n = len(every)
        l = np.zeros((classes.leaves * GROUP, hidden + 1), f)
        l[:, -1] = NONE
        l[: len(inside)] = np.c_[normal(len(inside), hidden, scale=0.01), np.log(inside).astype(f)]
        return cls(classes, {
            "x": normal(n, 3 * hidden, scale=0.3), "u": normal(hidden, 3 * hidden, scale=hidden**-0.5), "b": np.r_[np.full(hidden, 1.0), np.zeros(2 * hidden)].astype(f),
            "c": np.c_[normal(hidden, len(mass), scale=0.01).T, np.log(mass / mass.sum()).astype(f)], "w": np.c_[normal(len(groups), hidden, scale=0.01), np.log(groups / mass[classes.of]).astype(f)],
            "l": l.reshape(classes.leaves, GROUP * (hidden + 1)),
        })

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[n].ravel() for n in self.NAMES])

    def with_flat(self, flat: np.ndarray) -> Model:
        out, at = {}, 0
        for n in self.NAMES:
            size = self.p[n].size
            out[n] = flat[at : at + size].reshape(self.p[n].shape).astype(np.float32)
            at += size
        return Model(self.classes, out)

    def run(self, window: Window, ids: np.ndarray, state: np.ndarray) -> np.ndarray:
        """The states after a window whose lanes come in with `state`; what learning needs of it stays in the window."""
        k, u, edge = self.hidden, self.p["u"], window.edge
        x = self.p["x"].take(ids, axis=0)
        x += self.p["b"]
        np.negative(x[:, : 2 * k], out=x[:, : 2 * k])
        u_gates, u_new = -u[:, : 2 * k], np.ascontiguousarray(u[:, 2 * k :])
        window.h, window.gates, window.rh, window.new = (np.empty((edge[-1], n), x.dtype) for n in (k, 2 * k, k, k))
        for begun, a, b in zip(window.begun, edge[:-1], edge[1:], strict=True):
            h = window.h[a:b]
            h[:] = state[: b - a]
            if begun is not None:
                h[begun] = 0
            gates = np.matmul(h, u_gates, out=window.gates[a:b])
            gates += x[a:b, : 2 * k]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            rh = np.multiply(gates[:, k:], h, out=window.rh[a:b])
            new = np.matmul(rh, u_new, out=window.new[a:b])
            new += x[a:b, 2 * k :]
            np.tanh(new, out=new)
            after = h - new
            after *= gates[:, :k]
            after += new
            state = after if b - a == len(state) else np.concatenate([after, state[b - a :]])
        return state

    def output(self, states: np.ndarray, words: np.ndarray, space: np.ndarray | None = None, order: np.ndarray | None = None, shifted: bool = False) -> tuple[np.ndarray, np.ndarray | None, dict]:
        """Natural logarithm of the probability of each word after its state.

        With `space`, an array like w that is 0 for groups alone in their class, also gradients of minus their sum: of the
        states, and of c, w (in `space`) and l. order: what sorts the words, and with them their groups and classes.
        shifted: the largest logit of each choice is taken from all. That is done where exponentials go beyond their type.
        """
        p, cl, learn = self.p, self.classes, space is not None
        order = np.argsort(words, kind="stable") if order is None else order
        given, words = words, words[order]
        group = cl.group(words)
        of, place = cl.of[group], cl.place[group]
        edge = np.searchsorted(of, np.arange(len(cl.start))).tolist()
        x = np.ones((self.hidden + 1, len(words)), p["w"].dtype)
        x[:-1] = states.take(order, axis=0).T
        size = np.diff(cl.start)
        most = max(len(p["c"]), int(size.max()), GROUP)
        ones, columns, room = np.ones(most, x.dtype), np.arange(len(words)), np.empty(max(HELD, most), x.dtype)

        def softmax(weights: np.ndarray, x: np.ndarray, right: np.ndarray, into: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
            # choices stand in rows; exponentials are divided by their sums in what they are multiplied with
            rows, n = len(weights), len(right)
            flat = room[: rows * n]
            e = np.matmul(weights, x, out=flat.reshape(rows, n))
            if shifted:
                e -= e.max(axis=0)
            at = right * n + columns[:n]
            got = flat.take(at)
            np.exp(e, out=e)
            total = ones[:rows] @ e
            if not learn:
                return np.subtract(got, np.log(total), out=got), None
            flat[at] = flat.take(at) - total
            total = np.reciprocal(total, out=total)
            back = e.T @ weights[:, :-1]
            back *= total[:, None]
            np.matmul(e, (x * total).T, out=into)
            return np.add(got, np.log(total, out=total), out=got), back

        out, back = np.empty(len(words), x.dtype), np.empty_like(states) if learn else None
        classes = np.zeros_like(p["c"])
        piece = np.empty((most, x.shape[0]), x.dtype) if learn else None
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            step = max(1, HELD // len(classes))
            for a in range(0, len(words), step):
                mine = slice(a, a + step)
                out[mine], d = softmax(p["c"], x[:, mine], of[mine], piece[: len(classes)] if learn else None)
                if learn:
                    back[mine] = d
                    classes += piece[: len(classes)]
            for c in np.flatnonzero(size > 1).tolist():
                first, end, rows = edge[c], edge[c + 1], slice(cl.start[c], cl.start[c + 1])
                if first == end:
                    if learn:
                        space[rows] = 0
                    continue
                weights = p["w"][rows]
                step = max(1, HELD // len(weights))
                for a in range(first, end, step):
                    mine = slice(a, min(a + step, end))
                    # the first piece of a class writes its gradient where it belongs, others are added
                    inner, d = softmax(weights, x[:, mine], place[mine], (space[rows] if a == first else piece[: len(weights)]) if learn else None)
                    out[mine] += inner
                    if learn:
                        back[mine] += d
                        if a > first:
                            space[rows] += piece[: len(weights)]
            first, end = np.searchsorted(words, [cl.alone, cl.words])
            outer = np.empty((end - first, GROUP, x.shape[0]), x.dtype) if learn else None
            for a in range(first, end, GROUPED):
                mine = slice(a, min(a + GROUPED, end))
                leaf, right = np.divmod(words[mine] - cl.alone, GROUP)
                n, one = columns[: len(leaf)], np.ascontiguousarray(x[:, mine].T)
                weights = p["l"].take(leaf, axis=0).reshape(len(leaf), GROUP, -1)
                e = np.matmul(weights, one[:, :, None])[:, :, 0]
                if shifted:
                    e -= e.max(axis=1, keepdims=True)
                got = e[n, right]
                np.exp(e, out=e)
                total = e @ ones[:GROUP]
                out[mine] += got - np.log(total)
                if learn:
                    e[n, right] -= total
                    e /= total[:, None]
                    back[mine] += np.matmul(e[:, None, :], weights)[:, 0, :-1]
                    np.multiply(e[:, :, None], one[:, None, :], out=outer[a - first : a - first + len(leaf)])
        if not shifted and not np.isfinite(out).all():
            return self.output(states, given, space, order, True)
        of_words = np.empty_like(out)
        of_words[order] = out
        if not learn:
            return of_words, None, {}
        of_states = np.empty_like(states)
        of_states[order] = back
        leaf = (words[first:end] - cl.alone) // GROUP
        starts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]]) if len(leaf) else leaf
        leaves = Rows(leaf[starts], summed(outer.reshape(len(leaf), GROUP * x.shape[0]), starts), len(p["l"]))
        return of_words, of_states, {"c": classes, "w": space, "l": leaves}


@dataclass
class Rows:
    """A gradient that is 0 but in some rows. Added to an array or a number it is one with all rows."""

    rows: np.ndarray
    values: np.ndarray
    all_rows: int
    __array_ufunc__ = None

    def __radd__(self, other: np.ndarray | float) -> np.ndarray:
        out = np.zeros((self.all_rows, self.values.shape[1]), self.values.dtype)
        out[self.rows] = self.values
        return other + out


def summed(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each run of rows that begins at `starts`: of short runs row by row for all at once, of each long one as a product."""
    count = np.diff(np.append(starts, len(rows)))
    out, ones = rows[starts], np.ones(int(count.max(initial=0)), rows.dtype)
    long = np.flatnonzero(count > LONG)
    for k in long.tolist():
        out[k] = ones[: count[k]] @ rows[starts[k] : starts[k] + count[k]]
    for i in range(1, LONG):
        some = np.flatnonzero((count > i) & (count <= LONG))
        out[some] += rows[starts[some] + i]
    return out


def lanes(sizes: np.ndarray, most: int) -> list[np.ndarray]:
    """Texts by lane, the lanes of about equal length: each text, the longest first, goes to the shortest lane."""
    import heapq

    n = max(1, min(most, len(sizes)))
    heap = [(0, k) for k in range(n)]
    out: list[list[int]] = [[] for _ in range(n)]
    for d in np.argsort(-sizes, kind="stable").tolist():
        length, k = heapq.heappop(heap)
        out[k].append(d)
        heapq.heappush(heap, (length + int(sizes[d]), k))
    return sorted((np.array(x) for x in out if x), key=lambda x: -int(sizes[x].sum()))


def _layout(first: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token at each step of each lane (-1: past its end), tokens of a lane, and which tokens begin a text."""
    sizes = np.diff(first)
    rows = lanes(sizes, most)
    length = np.array([int(sizes[x].sum()) for x in rows])
    token = np.full((length.max(initial=0), len(rows)), -1, np.int64)
    for k, texts in enumerate(rows):
        at = 0
        for d in texts.tolist():
            token[at : at + sizes[d], k] = np.arange(first[d], first[d + 1])
            at += sizes[d]
    begins = np.zeros(int(first[-1]) + 1, bool)
    begins[first[:-1][sizes > 0]] = True
    return token, length, begins


@dataclass
class Window:
    """Some steps of all lanes that still run: the tokens of each step, one step after the other."""

    token: np.ndarray
    edge: list[int]  # first token of each step, and the end
    begun: list[np.ndarray | None]  # of each step the lanes in which a text begins
    h: np.ndarray | None = None  # of each token, the state before it
    gates: np.ndarray | None = None
    rh: np.ndarray | None = None
    new: np.ndarray | None = None


def windows(model: Model, ids: np.ndarray, first: np.ndarray, most: int, steps: int = WINDOW):
    """The windows of the texts, run with the weights that the model has when each is asked for."""
    token, length, begins = _layout(first, most)
    state = np.zeros((token.shape[1], model.hidden), model.p["u"].dtype)
    for t0 in range(0, len(token), steps):
        running = [int((length > t).sum()) for t in range(t0, min(t0 + steps, len(token)))]
        edge = np.concatenate([[0], np.cumsum(running)]).tolist()
        at = np.concatenate([token[t0 + i, :m] for i, m in enumerate(running)])
        begun = [x if x.any() else None for x in np.split(begins[at], edge[1:-1])]
        window = Window(at, edge, begun)
        state = model.run(window, ids[at], state[: running[0]])
        yield window


def score(model: Model, ids: np.ndarray, first: np.ndarray, most: int = 1024) -> np.ndarray:
    """Natural logarithm of each token's probability given all before it in its text.

    There are as many lanes as the longest text allows to fill, so that it doesn't run on alone.
    """
    out = np.zeros(len(ids))
    most = int(np.clip(len(ids) // max(1, np.diff(first).max(initial=1)), 16, most))
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> None:
        token, states = (np.concatenate(x) for x in zip(*held, strict=True))
        out[token] = model.output(states, ids[token])[0]
        held.clear()

    for window in windows(model, ids, first, most, 2 * WINDOW):
        held.append((window.token, window.h))
        if sum(len(t) for t, _ in held) >= SCORED:
            flush()
    if held:
        flush()
    return out


class Trainer:
    """Adam over windows; the state, not its gradient, goes on from one window to the next."""

    def __init__(self, model: Model, rate: float = 0.01):
        self.model, self.rate, self.n = model, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in model.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in model.p.items()}
        self.space = np.zeros_like(model.p["w"])  # its gradient

    def learn(self, ids: np.ndarray, first: np.ndarray, most: int) -> None:
        """One pass over the texts. Those of more than PART tokens are learned in parts, each from the empty state."""
        first = np.union1d(first, np.concatenate([np.zeros(0, np.int64), *(np.arange(a, b, PART) for a, b in zip(first[:-1], first[1:], strict=True) if b - a > PART)]).astype(np.int64)) if np.diff(first).max(initial=0) > PART else first
        model, k = self.model, self.model.hidden
        for window in windows(model, ids, first, most):
            words = ids[window.token]
            order = np.argsort(words, kind="stable")
            _, back, grad = model.output(window.h, words, self.space, order)
            u, edge, z, r = model.p["u"], window.edge, window.gates[:, :k], window.gates[:, k:]
            u_gates, u_new = np.ascontiguousarray(u[:, : 2 * k].T), np.ascontiguousarray(u[:, 2 * k :].T)
            # what the gradient of the state after a token is multiplied with, for all steps at once
            other = 1 - z
            to_z = (window.h - window.new) * z * other
            to_r = window.rh * (1 - r)
            other *= 1 - window.new * window.new
            gates = np.empty((edge[-1], 3 * k), window.h.dtype)
            carry = np.zeros((0, k), gates.dtype)
            for i in range(len(edge) - 2, -1, -1):
                a, b = edge[i], edge[i + 1]
                d = carry if len(carry) == b - a else np.concatenate([carry, np.zeros((b - a - len(carry), k), gates.dtype)])
                through = np.multiply(d, other[a:b], out=gates[a:b, 2 * k :]) @ u_new
                np.multiply(d, to_z[a:b], out=gates[a:b, :k])
                np.multiply(through, to_r[a:b], out=gates[a:b, k : 2 * k])
                carry = gates[a:b, : 2 * k] @ u_gates
                carry += back[a:b]
                through *= r[a:b]
                carry += through
                carry += np.multiply(d, z[a:b], out=through)
                if window.begun[i] is not None:
                    carry[window.begun[i]] = 0
            grad["u"] = np.concatenate([window.h.T @ gates[:, : 2 * k], window.rh.T @ gates[:, 2 * k :]], axis=1)
            grad["b"] = gates.sum(axis=0)
            read = words[order]
            starts = np.flatnonzero(np.r_[True, read[1:] != read[:-1]])
            grad["x"] = Rows(read[starts], summed(gates.take(order, axis=0), starts), len(model.p["x"]))
            self._update(grad, len(words))

    def _update(self, grad: dict[str, np.ndarray | Rows], tokens: int) -> None:
        """A step of Adam, with the corrections of both means taken out of the vectors."""
        self.n += 1
        late = np.sqrt(1 - 0.99**self.n)
        rate = self.rate * late / (1 - 0.9**self.n)
        for name, g in grad.items():
            if isinstance(g, Rows):
                # of a large vocabulary only the words and groups of the window are touched
                m, v, p = (x[name].take(g.rows, axis=0) for x in (self.m, self.v, self.model.p))
                self._moved(g.values.ravel(), m.reshape(-1), v.reshape(-1), p.reshape(-1), tokens, rate, late)
                self.m[name][g.rows], self.v[name][g.rows], self.model.p[name][g.rows] = m, v, p
            else:
                self._moved(g.ravel(), self.m[name].reshape(-1), self.v[name].reshape(-1), self.model.p[name].reshape(-1), tokens, rate, late)

    @staticmethod
    def _moved(g: np.ndarray, m: np.ndarray, v: np.ndarray, p: np.ndarray, tokens: int, rate: float, late: float) -> None:
        """Move m, v and p on in place, in pieces that stay in a core's cache."""
        space = np.empty(min(PIECE, len(g)), g.dtype)
        for a in range(0, len(g), PIECE):
            g_, m_, v_, p_ = (x[a : a + PIECE] for x in (g, m, v, p))
            # a tenth of the mean gradient: added to m as it is, to v as its square
            at = np.multiply(g_, 0.1 / tokens, out=space[: len(g_)])
            m_ *= 0.9
            m_ += at
            at *= at
            v_ *= 0.99
            v_ += at
            np.sqrt(v_, out=at)
            at += 1e-6 * late
            np.divide(m_, at, out=at)
            at *= rate
            p_ -= at
