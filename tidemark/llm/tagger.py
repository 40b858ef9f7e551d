"""A character tagger in numpy: a bidirectional LSTM under a linear-chain CRF."""

from __future__ import annotations

import io

import numpy as np

# ASCII characters stand for themselves; 0 is padding, and all others are one class.
CLASSES = 129
FORBIDDEN = -1e4


def codes_of(text: str) -> np.ndarray:
    """The class of every code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.clip(points, 1, CLASSES - 1).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Labels sequences of character classes; label 0 is "outside".

    ``allowed`` says which label may follow which, and ``opens`` which may come first. Sequences
    are rows of class numbers, padded with 0 at their ends.
    """

    def __init__(self, allowed: np.ndarray, opens: np.ndarray, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.hidden, self.n_labels = hidden, len(opens)
        self.rule = np.where(allowed, 0.0, FORBIDDEN)
        self.first_rule = np.where(opens, 0.0, FORBIDDEN)
        wide = 4 * hidden
        inputs = rng.normal(0, 0.3, (2, CLASSES, wide))
        inputs[:, :, hidden : 2 * hidden] += 1.0  # forget gates start open
        self.weights = {
            "inputs": inputs,
            "recurrent": rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, wide)),
            "out": rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, self.n_labels)),
            "bias": np.zeros(self.n_labels),
            "steps": np.zeros((self.n_labels, self.n_labels)),
            "first": np.zeros(self.n_labels),
        }

    # Both directions run together: axis 1 is the direction, the second reads backwards.

    def _states(self, codes: np.ndarray) -> dict[str, np.ndarray]:
        w, size = self.weights, self.hidden
        both = np.stack([codes.T, codes.T[::-1]], axis=1)
        steps, _, rows = both.shape
        gates = w["inputs"][np.arange(2)[None, :, None], both]
        live = (both != 0)[..., None].astype(gates.dtype)
        cells = np.zeros((steps + 1, 2, rows, size), gates.dtype)
        hidden = np.zeros_like(cells)
        squashed = np.zeros((steps, 2, rows, size), gates.dtype)
        for t in range(steps):
            z = gates[t]
            z += hidden[t] @ w["recurrent"]
            z[..., : 3 * size] = _sigmoid(z[..., : 3 * size])
            z[..., 3 * size :] = np.tanh(z[..., 3 * size :])
            cell = z[..., size : 2 * size] * cells[t] + z[..., :size] * z[..., 3 * size :]
            squashed[t] = np.tanh(cell)
            cells[t + 1] = cell * live[t]
            hidden[t + 1] = z[..., 2 * size : 3 * size] * squashed[t] * live[t]
        seen = np.concatenate([hidden[1:, 0], hidden[:0:-1, 1]], axis=-1)
        return {
            "both": both,
            "live": live,
            "gates": gates,
            "cells": cells,
            "hidden": hidden,
            "squashed": squashed,
            "seen": seen,
        }

    def _scores(self, seen: np.ndarray) -> np.ndarray:
        return seen @ self.weights["out"] + self.weights["bias"]

    def loss(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the labels, and its gradient."""
        state = self._states(codes)
        scores = self._scores(state["seen"])
        value, up, grad = self._chain(scores, labels.T, state["live"][:, 0, :, 0])
        grad["out"] = np.einsum("tnh,tnl->hl", state["seen"], up)
        grad["bias"] = up.sum((0, 1))
        back = up @ self.weights["out"].T
        half = np.stack([back[..., : self.hidden], back[::-1, :, self.hidden :]], axis=1)
        grad["inputs"], grad["recurrent"] = self._through_time(state, half)
        return value, grad

    def _through_time(self, state, up):
        w, size = self.weights, self.hidden
        gates, cells, hidden, live = (state[k] for k in ("gates", "cells", "hidden", "live"))
        inner = np.empty_like(gates)
        d_hidden = np.zeros_like(cells[0])
        d_cell = np.zeros_like(cells[0])
        for t in range(len(up) - 1, -1, -1):
            i, f, o, g = (gates[t][..., k * size : (k + 1) * size] for k in range(4))
            squashed = state["squashed"][t]
            dh = (up[t] + d_hidden) * live[t]
            dc = d_cell * live[t] + dh * o * (1 - squashed**2)
            z = inner[t]
            z[..., :size] = dc * g * i * (1 - i)
            z[..., size : 2 * size] = dc * cells[t] * f * (1 - f)
            z[..., 2 * size : 3 * size] = dh * squashed * o * (1 - o)
            z[..., 3 * size :] = dc * i * (1 - g**2)
            d_hidden = z @ w["recurrent"].transpose(0, 2, 1)
            d_cell = dc * f
        recurrent = np.einsum("tdnh,tdnz->dhz", hidden[:-1], inner)
        inputs = np.zeros_like(w["inputs"])
        for d in (0, 1):
            flat = state["both"][:, d].ravel()
            order = np.argsort(flat, kind="stable")
            kinds, starts = np.unique(flat[order], return_index=True)
            rows = inner[:, d].reshape(len(flat), -1)[order]
            inputs[d, kinds] = np.add.reduceat(rows, starts, axis=0)
        inputs[:, 0] = 0
        return inputs, recurrent

    def _chain(self, scores, labels, live):
        """Loss of the CRF, its gradient by scores, and by its own weights."""
        steps, rows, kinds = scores.shape
        moves = self.weights["steps"] + self.rule
        first = self.weights["first"] + self.first_rule
        forward = np.empty_like(scores)
        forward[0] = scores[0] + first
        for t in range(1, steps):
            reached = _log_sum(forward[t - 1][:, :, None] + moves, 1) + scores[t]
            forward[t] = np.where(live[t][:, None] > 0, reached, forward[t - 1])
        total = _log_sum(forward[-1], 1)
        behind = np.zeros_like(scores)
        pairs = np.zeros_like(moves)
        for t in range(steps - 1, 0, -1):
            ahead = scores[t] + behind[t]
            joint = forward[t - 1][:, :, None] + moves + ahead[:, None, :] - total[:, None, None]
            pairs += (np.exp(joint) * live[t][:, None, None]).sum(0)
            reached = _log_sum(moves[None] + ahead[:, None, :], 2)
            behind[t - 1] = np.where(live[t][:, None] > 0, reached, behind[t])
        up = np.exp(forward + behind - total[:, None]) * live[..., None]
        at = np.arange(rows)
        value = total - scores[0, at, labels[0]] - first[labels[0]]
        first_grad = up[0].sum(0)
        np.subtract.at(first_grad, labels[0], 1)
        for t in range(steps):
            up[t, at, labels[t]] -= live[t]
            if t:
                value = value - live[t] * (scores[t, at, labels[t]] + moves[labels[t - 1], labels[t]])
                np.subtract.at(pairs, (labels[t - 1], labels[t]), live[t])
        grad = {"steps": pairs / rows, "first": first_grad / rows}
        return float(value.mean()), up / rows, grad

    def cast(self, kind=np.float32) -> Tagger:
        self.weights = {k: v.astype(kind) for k, v in self.weights.items()}
        self.rule, self.first_rule = self.rule.astype(kind), self.first_rule.astype(kind)
        return self

    def fit(self, codes, labels, epochs: int = 6, batch: int = 80, rate: float = 0.03, seed: int = 3):
        """Adam over shuffled batches; the same rows give the same weights."""
        self.cast()
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        total = epochs * -(-len(codes) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(codes))
            for at in range(0, len(codes), batch):
                rows = order[at : at + batch]
                step += 1
                _, grad = self.loss(codes[rows], labels[rows])
                norm = np.sqrt(sum((g**2).sum() for g in grad.values()))
                scale = min(1.0, 5.0 / (norm + 1e-12))
                pace = rate * (1 - 0.9 * step / total)
                for k, g in grad.items():
                    g = g * scale
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g**2
                    own = mean[k] / (1 - 0.9**step)
                    self.weights[k] -= pace * own / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The best labels of every row; padding is outside."""
        scores = self._scores(self._states(codes)["seen"])
        live = codes.T != 0
        moves = self.weights["steps"] + self.rule
        best = scores[0] + self.weights["first"] + self.first_rule
        came = np.zeros(scores.shape, np.int64)
        stay = np.arange(self.n_labels)
        for t in range(1, len(scores)):
            paths = best[:, :, None] + moves
            came[t] = np.where(live[t][:, None], paths.argmax(1), stay)
            best = np.where(live[t][:, None], paths.max(1) + scores[t], best)
        out = np.zeros(codes.shape, np.int64)
        at = np.arange(len(codes))
        label = best.argmax(1)
        for t in range(len(scores) - 1, -1, -1):
            out[:, t] = np.where(live[t], label, 0)
            label = came[t, at, label]
        return out

    def dumped(self) -> bytes:
        file = io.BytesIO()
        np.savez(file, **self.weights)
        return file.getvalue()

    def loaded(self, data: bytes) -> Tagger:
        with np.load(io.BytesIO(data)) as weights:
            self.weights = {k: weights[k] for k in weights.files}
        return self.cast()
