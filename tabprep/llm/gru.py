"""A small gated recurrent language model in numpy, with a class-factored softmax.

``P(token | state) = P(class | state) * P(token | class, state)`` for the
listed words; the words beyond the list form classes by shape, whose members'
probabilities come from corpus counts (see ``language_model``), so here a token
beyond the list is just its class.  Documents advance together, longest
first: step t is one set of array operations on those that still have a
token.  The state is carried from window to window and, in training, from
lane to lane of a document; gradients stop at a window's start (truncated
backpropagation).
"""

from __future__ import annotations

import numpy as np

HIDDEN, WINDOW, LANES = 16, 12, 512
#: Tokens of a training lane: a longer document becomes several, each starting in the state that the ones before leave.
LANE = 120
CLASSES, WORDS_PER_CLASS = 32, 32
LISTED = CLASSES * WORDS_PER_CLASS


class Gru:
    """Parameters: x (input rows), u, b (recurrence), wc, bc (classes), wo, bo (words of a class)."""

    NAMES = ("x", "u", "b", "wc", "bc", "wo", "bo")

    def __init__(self, n_shapes: int, hidden: int = HIDDEN, seed: int = 5):
        rng, h = np.random.default_rng(seed), hidden
        draw = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        self.n_shapes, self.hidden, self.start = n_shapes, h, LISTED + n_shapes
        self.x = draw(LISTED + n_shapes + 1, 3 * h)
        self.u, self.b = draw(h, 3 * h), np.zeros(3 * h, np.float32)
        self.wc, self.bc = draw(h, CLASSES + n_shapes), np.zeros(CLASSES + n_shapes, np.float32)
        self.moments, self.steps = None, 0
        self.wo, self.bo = draw(CLASSES, h, WORDS_PER_CLASS), np.zeros((CLASSES, WORDS_PER_CLASS), np.float32)

    def biases(self, listed: np.ndarray, shapes: np.ndarray) -> Gru:
        """Start at the frequencies of the listed words and of the shapes."""
        words = np.zeros(LISTED)
        words[:len(listed)] = listed
        words = words.reshape(CLASSES, WORDS_PER_CLASS)
        self.bo = np.log(words + 1e-3).astype(np.float32)
        self.bc = np.log(np.concatenate([words.sum(axis=1), shapes]) + 0.5).astype(np.float32)
        self.bc -= self.bc.max()
        return self

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> Gru:
        at = 0
        for n in self.NAMES:
            a = getattr(self, n)
            setattr(self, n, flat[at:at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return self

    # ------------------------------------------------------------ forward

    def step(self, inputs: np.ndarray, h: np.ndarray, x: np.ndarray | None = None):
        """(next state, update gate, reset gate, new state, its recurrent part); ``x``: the input rows with the bias."""
        k = 2 * self.hidden
        a, g = (self.x + self.b if x is None else x).take(inputs, axis=0), h @ self.u
        gates = a[:, :k] + g[:, :k]
        gates *= 0.5  # a sigmoid is 0.5 * tanh(half) + 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r, recurrent = gates[:, :self.hidden], gates[:, self.hidden:], g[:, k:]
        n = r * recurrent
        n += a[:, k:]
        np.tanh(n, out=n)
        out = h - n
        out *= z
        out += n
        return out, z, r, n, recurrent

    def token_logp(self, h: np.ndarray, token: np.ndarray, grads: dict | None = None):
        """Log probability of each token; with ``grads``, adds -d/d(parameter), returns also -d/dh."""
        listed = token < LISTED
        cls = np.where(listed, token // WORDS_PER_CLASS, token - LISTED + CLASSES)
        rows = np.arange(len(token))
        out, dh = self._softmax(h, self.wc, self.bc, cls, rows, grads, "wc", "bc")
        order = np.argsort(cls, kind="stable")
        edge = np.searchsorted(cls[order], np.arange(CLASSES + 1))
        for c in np.flatnonzero(np.diff(edge)):
            rows = order[edge[c]:edge[c + 1]]
            lp, d = self._softmax(h[rows], self.wo[c], self.bo[c], token[rows] % WORDS_PER_CLASS,
                                  np.arange(len(rows)), grads, "wo", "bo", c)
            out[rows] += lp
            if grads is not None:
                dh[rows] += d
        return out, dh

    @staticmethod
    def _softmax(h, w, b, pick, rows, grads, wn, bn, at=slice(None)):
        s = h @ w
        s += b
        ones = np.ones(s.shape[1], s.dtype)
        if grads is None:
            with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
                lp = s[rows, pick] - np.log(np.exp(s) @ ones)
            if np.isfinite(lp).all():
                return lp, None
        s -= s.max(axis=1, keepdims=True)  # exponents beyond the number range
        lp = s[rows, pick]
        e = np.exp(s, out=s)
        total = e @ ones
        lp -= np.log(total)
        if grads is None:
            return lp, None
        e /= total[:, None]
        e[rows, pick] -= 1
        grads[wn][at] += h.T @ e
        grads[bn][at] += e.sum(axis=0)
        return lp, e @ w.T

    # ------------------------------------------------------------ documents

    def _lanes(self, docs: list[np.ndarray]):
        """Longest first: order, lengths, flat tokens, starts."""
        lengths = np.array([len(d) for d in docs], np.int64)
        order = np.argsort(-lengths, kind="stable")
        flat = np.concatenate([docs[i] for i in order]) if len(docs) else np.zeros(0, np.int64)
        size = lengths[order]
        return order, size, flat, np.cumsum(size) - size

    def score(self, docs: list[np.ndarray], tokens_at_once: int = 60_000) -> np.ndarray:
        """Natural log probability of each whole token sequence."""
        order, size, flat, starts = self._lanes(docs)
        total, x = np.zeros(len(docs)), self.x + self.b
        h = np.zeros((len(docs), self.hidden), np.float32)
        t, longest = 0, int(size[0]) if len(size) else 0
        while t < longest:
            states, targets, live, held = [], [], [], 0
            while t < longest and held < tokens_at_once:  # a window
                n = int(np.searchsorted(-size, -t, "left"))
                at = starts[:n] + t
                inputs = flat[at - 1] if t else np.full(n, self.start)
                h = self.step(inputs, h[:n], x)[0]
                states.append(h), targets.append(flat[at]), live.append(n)
                held, t = held + n, t + 1
            lp, _ = self.token_logp(np.concatenate(states), np.concatenate(targets))
            at = 0
            for n in live:
                total[:n] += lp[at:at + n]
                at += n
        out = np.zeros(len(docs))
        out[order] = total
        return out

    def states(self, docs: list[np.ndarray], every: int = LANE) -> list[np.ndarray]:
        """Of each sequence, the states before its tokens 0, every, 2 * every, ..."""
        order, size, flat, starts = self._lanes(docs)
        found = [[np.zeros(self.hidden, np.float32)] for _ in docs]
        h, x = np.zeros((len(docs), self.hidden), np.float32), self.x + self.b
        longest = int(size[0]) if len(size) else 0
        for t in range((longest - 1) // every * every):  # up to the last start of a lane
            n = int(np.searchsorted(-size, -((t // every + 1) * every), "left"))  # a later lane follows
            inputs = flat[starts[:n] + t - 1] if t else np.full(n, self.start)
            h = self.step(inputs, h[:n], x)[0]
            if (t + 1) % every == 0:
                for row, i in enumerate(order[:n]):
                    found[i].append(h[row])
        return [np.array(x) for x in found]

    def train(self, docs: list[np.ndarray], rate: float = 0.01, window: int = WINDOW, lanes: int = LANES,
              lane: int = LANE) -> Gru:
        """One pass of Adam over the sequences, ``lanes`` at a time, by windows.

        A sequence is cut in lanes; each starts with the token before it and the
        state that the sequence up to there leaves (by the parameters at the
        call's start), as in scoring.  The moments carry over to the next call."""
        if self.moments is None:
            self.moments = [{n: np.zeros_like(getattr(self, n)) for n in self.NAMES} for _ in range(2)]
        m, v = self.moments
        pieces = [(d[t:t + lane], h, d[t - 1] if t else self.start)
                  for d, at in zip(docs, self.states(docs, lane)) for t, h in zip(range(0, len(d), lane), at)]
        by_length = sorted(range(len(pieces)), key=lambda i: len(pieces[i][0]))
        groups = [by_length[i:i + lanes] for i in range(0, len(pieces), lanes)]
        np.random.default_rng(len(docs)).shuffle(groups)
        for group in groups:
            order, size, flat, starts = self._lanes([pieces[i][0] for i in group])
            h = np.array([pieces[group[i]][1] for i in order])
            before = np.array([pieces[group[i]][2] for i in order], np.int64)
            for t0 in range(0, int(size[0]), window):
                grads, n_tokens, h = self._window(h, size, flat, starts, t0, window, before)
                self.steps += 1
                warm = min(1.0, self.steps / 20)
                for name in self.NAMES:
                    g = grads[name] / n_tokens
                    np.clip(g, -1, 1, out=g)
                    m[name] += 0.1 * (g - m[name])
                    v[name] += 0.01 * (g * g - v[name])
                    a = getattr(self, name)
                    a -= rate * warm * (m[name] / (1 - 0.9 ** self.steps)) / (np.sqrt(v[name] / (1 - 0.99 ** self.steps)) + 1e-5)
        return self

    def _window(self, h, size, flat, starts, t0: int, window: int, first=None):
        k, x, caches, states, targets = self.hidden, self.x + self.b, [], [], []
        for t in range(t0, min(t0 + window, int(size[0]))):
            n = int(np.searchsorted(-size, -t, "left"))
            at = starts[:n] + t
            inputs = flat[at - 1] if t else np.full(n, self.start) if first is None else first[:n]
            before = h[:n]
            h, z, r, new, recurrent = self.step(inputs, before, x)
            caches.append((inputs, before, z, r, new, recurrent))
            states.append(h), targets.append(flat[at])
        grads = {name: np.zeros_like(getattr(self, name)) for name in self.NAMES}
        tokens = np.concatenate(targets)
        _, dout = self.token_logp(np.concatenate(states), tokens, grads)
        ends = np.cumsum([len(s) for s in targets])
        dh = np.zeros((0, k), np.float32)
        dx = np.empty((len(tokens), 3 * k), dout.dtype)
        for start, end, (_, before, z, r, new, recurrent) in zip((ends - [len(s) for s in targets])[::-1], ends[::-1], caches[::-1]):
            d = dout[start:end]
            d[:len(dh)] += dh
            keep = 1 - z
            dn = d * keep
            dz = before - new
            new *= new
            dn *= np.subtract(1, new, out=new)
            dz *= d
            dz *= z
            dz *= keep
            dr = dn * recurrent
            dr *= r
            dr *= np.subtract(1, r, out=keep)
            dx[start:end, :k], dx[start:end, k:2 * k], dx[start:end, 2 * k:] = dz, dr, dn
            dn *= r
            dg = np.concatenate([dz, dr, dn], axis=1)
            grads["u"] += before.T @ dg
            dh = dg @ self.u.T
            d *= z
            dh += d
        rows = np.concatenate([c[0] for c in caches[::-1]])
        dx = np.concatenate([dx[e - len(t):e] for e, t in zip(ends[::-1], targets[::-1])])  # the last step's first
        order = np.argsort(rows, kind="stable")
        kinds, first = np.unique(rows[order], return_index=True)
        grads["x"][kinds] = np.add.reduceat(dx[order], first, axis=0)
        grads["b"] = dx.sum(axis=0)
        return grads, len(tokens), h
