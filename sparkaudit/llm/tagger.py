"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Batches are padded matrices; all sums over paths of the CRF run in log space.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Character classes: every printable ASCII character, white space, digits and letters beyond ASCII, the rest.
N_CHARS = 100


def char_codes(text: str) -> np.ndarray:
    """1 .. 99 per character; 0 is padding."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    codes = np.where((points >= 32) & (points < 127), points - 31, 99)
    codes[(points >= 9) & (points <= 13)] = 96
    codes[(points >= 0xC0) & (points < 0x2000)] = 97  # mostly letters
    codes[points == 0xA0] = 1
    return codes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Weights by name; ``tags`` is their number."""

    weights: dict[str, np.ndarray]
    tags: int
    hidden: int

    @classmethod
    def new(cls, tags: int, hidden: int = 20, embed: int = 14, seed: int = 5) -> Tagger:
        rng = np.random.default_rng(seed)

        def matrix(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        weights = {"embed": matrix(N_CHARS, embed), "out": matrix(2 * hidden, tags), "out_b": np.zeros(tags, np.float32),
                   "move": np.zeros((tags, tags), np.float32), "first": np.zeros(tags, np.float32)}
        for way in ("fore", "back"):
            weights[f"{way}_x"], weights[f"{way}_h"] = matrix(embed, 4 * hidden), matrix(hidden, 4 * hidden)
            weights[f"{way}_b"] = np.repeat(np.array([0, 1, 0, 0], np.float32), hidden)  # in, forget, cell, out
        return cls(weights, tags, hidden)

    def _lstm(self, x: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        """States for time-major inputs (T, B, embed); the second result serves the way back."""
        w, n, (steps, batch, _) = self.weights, self.hidden, x.shape
        inputs = x @ w[f"{way}_x"] + w[f"{way}_b"]
        h, c = np.zeros((batch, n), np.float32), np.zeros((batch, n), np.float32)
        states, trace = np.empty((steps, batch, n), np.float32), []
        for t in range(steps):
            gates = inputs[t] + h @ w[f"{way}_h"]
            i, f, o = _sigmoid(gates[:, :n]), _sigmoid(gates[:, n : 2 * n]), _sigmoid(gates[:, 3 * n :])
            g, before = np.tanh(gates[:, 2 * n : 3 * n]), (h, c)
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            states[t] = h
            trace.append((i, f, g, o, squashed, before))
        return states, trace

    def _lstm_back(self, x, way, trace, d_states, grads) -> np.ndarray:
        w, n, (steps, batch, _) = self.weights, self.hidden, x.shape
        d_gates = np.empty((steps, batch, 4 * n), np.float32)
        d_h, d_c = np.zeros((batch, n), np.float32), np.zeros((batch, n), np.float32)
        for t in range(steps - 1, -1, -1):
            i, f, g, o, squashed, (h0, c0) = trace[t]
            d_h = d_h + d_states[t]
            d_c = d_c + d_h * o * (1 - squashed * squashed)
            own = np.concatenate(
                [d_c * g * i * (1 - i), d_c * c0 * f * (1 - f), d_c * i * (1 - g * g), d_h * squashed * o * (1 - o)], axis=1
            )
            d_gates[t] = own
            grads[f"{way}_h"] += h0.T @ own
            d_h, d_c = own @ w[f"{way}_h"].T, d_c * f
        flat = d_gates.reshape(-1, 4 * n)
        grads[f"{way}_x"] += x.reshape(-1, x.shape[2]).T @ flat
        grads[f"{way}_b"] += flat.sum(0)
        return d_gates @ w[f"{way}_x"].T

    def _reverse(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Every sequence turned round in place, padding kept behind."""
        steps = x.shape[0]
        at = np.arange(steps)[:, None]
        turned = np.where(at < lengths[None, :], lengths[None, :] - 1 - at, at)
        return x[turned, np.arange(x.shape[1])[None, :]]

    def emissions(self, codes: np.ndarray, lengths: np.ndarray):
        """Tag scores (T, B, tags) for codes (B, T)."""
        w = self.weights
        x = w["embed"][codes.T]
        fore, trace_f = self._lstm(x, "fore")
        turned = self._reverse(x, lengths)
        back, trace_b = self._lstm(turned, "back")
        states = np.concatenate([fore, self._reverse(back, lengths)], axis=2)
        return states @ w["out"] + w["out_b"], (x, turned, trace_f, trace_b, states)

    def marginals(self, scores: np.ndarray, lengths: np.ndarray):
        """CRF tag and transition posteriors and log partition; padding gets zeros."""
        move, first = self.weights["move"].astype(np.float64), self.weights["first"].astype(np.float64)
        scores = scores.astype(np.float64)
        steps, batch, k = scores.shape
        alpha, beta = np.empty((steps, batch, k)), np.zeros((steps, batch, k))
        alpha[0] = first + scores[0]
        for t in range(1, steps):
            alpha[t] = np.where(
                (t < lengths)[:, None], _logsumexp(alpha[t - 1][:, :, None] + move[None], 1) + scores[t], alpha[t - 1]
            )
        whole = _logsumexp(alpha[-1], 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = np.where(
                (t + 1 < lengths)[:, None],
                _logsumexp(move[None] + (scores[t + 1] + beta[t + 1])[:, None, :], 2), 0.0,
            )
        inside = np.arange(steps)[:, None] < lengths[None, :]
        tag = np.exp(np.minimum(alpha + beta - whole[None, :, None], 0)) * inside[:, :, None]
        pair = np.zeros((k, k))
        for t in range(1, steps):
            live = t < lengths
            if live.any():
                joint = alpha[t - 1][live][:, :, None] + move[None] + (scores[t] + beta[t])[live][:, None, :] - whole[live][:, None, None]
                pair += np.exp(np.minimum(joint, 0)).sum(0)
        return tag, pair, whole

    def posteriors(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """P(tag) per character, (B, T, tags)."""
        scores, _ = self.emissions(codes, lengths)
        return self.marginals(scores, lengths)[0].transpose(1, 0, 2)

    def step(self, codes: np.ndarray, lengths: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of tag rows (B, T) and its gradients."""
        scores, (x, turned, trace_f, trace_b, states) = self.emissions(codes, lengths)
        tag, pair, whole = self.marginals(scores, lengths)
        steps, batch, k = scores.shape
        gold = tags.T
        inside = np.arange(steps)[:, None] < lengths[None, :]
        rows, cols = np.arange(steps)[:, None], np.arange(batch)[None, :]
        w = self.weights
        loss = whole.sum() - (scores[rows, cols, gold] * inside).sum() - w["first"][gold[0]].sum()
        loss -= (w["move"][gold[:-1], gold[1:]] * inside[1:]).sum()
        d_scores = tag.copy()
        np.subtract.at(d_scores, (np.broadcast_to(rows, gold.shape), np.broadcast_to(cols, gold.shape), gold), inside)
        d_scores = (d_scores / batch).astype(np.float32)
        grads = {name: np.zeros_like(value) for name, value in w.items()}
        counted = np.zeros((k, k))
        np.add.at(counted, (gold[:-1][inside[1:]], gold[1:][inside[1:]]), 1)
        grads["move"] += ((pair - counted) / batch).astype(np.float32)
        grads["first"] += d_scores[0].sum(0)
        flat = d_scores.reshape(-1, k)
        grads["out"] += states.reshape(-1, states.shape[2]).T @ flat
        grads["out_b"] += flat.sum(0)
        d_states = d_scores @ w["out"].T
        d_x = self._lstm_back(x, "fore", trace_f, d_states[:, :, : self.hidden], grads)
        back = self._reverse(np.ascontiguousarray(d_states[:, :, self.hidden :]), lengths)
        d_x = d_x + self._reverse(self._lstm_back(turned, "back", trace_b, back, grads), lengths)
        np.add.at(grads["embed"], codes.T, d_x * inside[:, :, None])
        return loss / batch, grads

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], epochs: int = 8, batch: int = 32, rate: float = 0.02, seed: int = 7) -> float:
        """Adam over (codes, tags) rows, shuffled by a fixed seed; the last epoch's mean loss."""
        rng = np.random.default_rng(seed)
        m = {n: np.zeros_like(v) for n, v in self.weights.items()}
        v = {n: np.zeros_like(w) for n, w in self.weights.items()}
        at, mean = 0, 0.0
        for epoch in range(epochs):
            losses = []
            order = rng.permutation(len(rows))
            for start in range(0, len(rows), batch):
                codes, tags, lengths = pad([rows[i] for i in order[start : start + batch]])
                loss, grads = self.step(codes, lengths, tags)
                losses.append(loss)
                at += 1
                now = rate * (1 - 0.9 * epoch / max(1, epochs - 1))
                for name, g in grads.items():
                    g = np.clip(g, -1, 1)
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.999 * v[name] + 0.001 * g * g
                    self.weights[name] -= now * (m[name] / (1 - 0.9**at)) / (np.sqrt(v[name] / (1 - 0.999**at)) + 1e-8)
            mean = float(np.mean(losses))
        return mean


def pad(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(c) for c, _ in rows])
    codes = np.zeros((len(rows), lengths.max()), np.int64)
    tags = np.zeros_like(codes)
    for i, (c, t) in enumerate(rows):
        codes[i, : len(c)], tags[i, : len(t)] = c, t
    return codes, tags, lengths


def best_path(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Viterbi tags of one sequence of log scores (T, tags)."""
    back = np.empty(scores.shape, np.int64)
    now = scores[0]
    for t in range(1, len(scores)):
        paths = now[:, None] + move
        back[t] = paths.argmax(0)
        now = paths.max(0) + scores[t]
    tags = [int(now.argmax())]
    for t in range(len(scores) - 1, 0, -1):
        tags.append(int(back[t][tags[-1]]))
    return np.array(tags[::-1])
