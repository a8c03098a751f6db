"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

EMBEDDED, HIDDEN, EPOCHS, STEPS, BATCH, RATE, SEED = 12, 16, 6, 300, 64, 0.015, 11
#: Code points below 128 stand for themselves; then other letters, other code points and padding.
OTHER_LETTER, OTHER, PADDING, SYMBOLS = 128, 129, 130, 131


def symbols(text: str) -> np.ndarray:
    """The symbol of each code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    high = points >= 128
    if high.any():
        points[high] = [OTHER_LETTER if c.isalpha() else OTHER for c in np.array(list(text))[high]]
    return points


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Tagger:
    """Both directions run side by side: arrays have a leading axis of two, the second direction reads backwards."""

    tags: int
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self) -> None:
        rng = np.random.default_rng(SEED)
        k = HIDDEN**-0.5
        self.weights = {
            "embed": rng.normal(0, 0.3, (SYMBOLS, EMBEDDED)),
            "w": rng.uniform(-k, k, (2, EMBEDDED, 4 * HIDDEN)),
            "u": rng.uniform(-k, k, (2, HIDDEN, 4 * HIDDEN)),
            "b": np.zeros((2, 1, 4 * HIDDEN)),
            "emit": rng.uniform(-k, k, (2 * HIDDEN, self.tags)),
            "emit_b": np.zeros(self.tags),
            "move": np.zeros((self.tags, self.tags)),
            "first": np.zeros(self.tags),
        }
        self.weights["b"][:, :, HIDDEN : 2 * HIDDEN] = 1.0

    def _read(self, x: np.ndarray, keep: bool) -> dict[str, np.ndarray]:
        """Emissions of windows ``x`` (windows by places), with all states if they are to be ``kept``."""
        w = self.weights
        count, length = x.shape
        inputs = np.stack([w["embed"][x], w["embed"][x[:, ::-1]]])  # direction, window, place, embedded
        parts = np.matmul(inputs.reshape(2, count * length, EMBEDDED), w["w"]).reshape(2, count, length, -1) + w["b"][:, :, None]
        h = np.zeros((2, count, HIDDEN), dtype=parts.dtype)
        c = np.zeros_like(h)
        states = np.empty((length, 2, count, HIDDEN), dtype=parts.dtype)
        gates, cells = [], []
        for t in range(length):
            z = parts[:, :, t] + np.matmul(h, w["u"])
            s = _sigmoid(z[..., : 3 * HIDDEN])
            g = np.tanh(z[..., 3 * HIDDEN :])
            before, c = c, s[..., HIDDEN : 2 * HIDDEN] * c + s[..., :HIDDEN] * g
            wide = np.tanh(c)
            h = s[..., 2 * HIDDEN :] * wide
            states[t] = h
            if keep:
                gates.append((s, g, wide))
                cells.append(before)
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=-1).transpose(1, 0, 2)
        found = {"emissions": both @ w["emit"] + w["emit_b"]}
        if keep:
            found |= {"inputs": inputs, "states": states, "gates": gates, "cells": cells, "both": both}
        return found

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags ``y`` and its gradients."""
        w, f = self.weights, self._read(x, keep=True)
        e = f["emissions"]
        count, length, _ = e.shape
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = w["first"] + e[:, 0]
        for t in range(1, length):
            alpha[:, t] = _log_sum(alpha[:, t - 1][:, :, None] + w["move"], 1) + e[:, t]
        for t in range(length - 2, -1, -1):
            beta[:, t] = _log_sum(w["move"] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        whole = _log_sum(alpha[:, -1], 1)
        rows = np.arange(count)
        gold = w["first"][y[:, 0]] + np.take_along_axis(e, y[:, :, None], 2)[..., 0].sum(axis=1) + w["move"][y[:, :-1], y[:, 1:]].sum(axis=1)
        de = np.exp(alpha + beta - whole[:, None, None])
        dmove = np.zeros_like(w["move"])
        for t in range(1, length):
            pair = alpha[:, t - 1][:, :, None] + w["move"] + (e[:, t] + beta[:, t])[:, None, :] - whole[:, None, None]
            dmove += np.exp(pair).sum(axis=0)
        dfirst = de[:, 0].sum(axis=0)
        np.add.at(dmove, (y[:, :-1], y[:, 1:]), -1)
        np.add.at(dfirst, y[:, 0], -1)
        de[rows[:, None], np.arange(length)[None, :], y] -= 1
        de /= count
        grads = {"move": dmove / count, "first": dfirst / count}
        grads["emit"] = np.einsum("nth,ntk->hk", f["both"], de)
        grads["emit_b"] = de.sum(axis=(0, 1))
        dboth = (de @ w["emit"].T).transpose(1, 0, 2)
        dstates = np.stack([dboth[..., :HIDDEN], dboth[::-1, :, HIDDEN:]], axis=1)  # place, direction, window, hidden
        dparts = np.empty((2, count, length, 4 * HIDDEN))
        dh, dc = np.zeros((2, count, HIDDEN)), np.zeros((2, count, HIDDEN))
        du = np.zeros_like(w["u"])
        for t in range(length - 1, -1, -1):
            s, g, wide = f["gates"][t]
            i, forget, o = s[..., :HIDDEN], s[..., HIDDEN : 2 * HIDDEN], s[..., 2 * HIDDEN :]
            dh = dh + dstates[t]
            dc = dc + dh * o * (1 - wide * wide)
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * f["cells"][t] * forget * (1 - forget), dh * wide * o * (1 - o), dc * i * (1 - g * g)], axis=-1
            )
            dparts[:, :, t] = dz
            if t:
                du += np.matmul(f["states"][t - 1].transpose(0, 2, 1), dz)
            dh = np.matmul(dz, w["u"].transpose(0, 2, 1))
            dc = dc * forget
        flat = dparts.reshape(2, count * length, -1)
        grads["u"] = du
        grads["b"] = flat.sum(axis=1, keepdims=True)
        grads["w"] = np.matmul(f["inputs"].reshape(2, count * length, EMBEDDED).transpose(0, 2, 1), flat)
        dinputs = np.matmul(flat, w["w"].transpose(0, 2, 1)).reshape(2, count, length, EMBEDDED)
        grads["embed"] = np.zeros_like(w["embed"])
        np.add.at(grads["embed"], x, dinputs[0])
        np.add.at(grads["embed"], x[:, ::-1], dinputs[1])
        return float((whole - gold).mean()), grads

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Fit by Adam with clipped gradients, for ``EPOCHS`` and at least ``STEPS`` steps; the same windows give the same weights."""
        self.start()
        rng = np.random.default_rng(SEED)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, epochs = 0, max(EPOCHS, -(-STEPS // -(-len(x) // BATCH)))
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            rate = RATE * (1 - 0.9 * epoch / epochs)
            for i in range(0, len(order), BATCH):
                _, grads = self.gradients(x[order[i : i + BATCH]], y[order[i : i + BATCH]])
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                step += 1
                for name, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g * g
                    self.weights[name] = self.weights[name] - rate * (first[name] / (1 - 0.9**step)) / (
                        np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8
                    )
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def decode(self, x: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """Best tags of each window under the learnt transitions; ``allowed`` marks moves that may happen."""
        w = self.weights
        e = self._read(x, keep=False)["emissions"]
        move = np.where(allowed, w["move"], -1e4).astype(e.dtype)
        score = w["first"] + e[:, 0]
        back = np.empty((x.shape[1], len(x), self.tags), dtype=np.int8)
        for t in range(1, x.shape[1]):
            options = score[:, :, None] + move
            back[t] = options.argmax(axis=1)
            score = options.max(axis=1) + e[:, t]
        best = np.empty(x.shape, dtype=np.int64)
        best[:, -1] = score.argmax(axis=1)
        for t in range(x.shape[1] - 1, 0, -1):
            best[:, t - 1] = back[t][np.arange(len(x)), best[:, t]]
        return best
