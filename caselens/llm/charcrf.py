"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN, SCALE = 24, 0.3
# Of the training: windows of a step, rounds over all windows, and the step's size.
STEP, ROUNDS, RATE, SEED = 96, 6, 0.012, 11


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class CharCrf:
    """Scores and tags of windows of characters, given as a matrix of character classes.

    Both directions run at once, on a leading axis of two; the second one reads windows backwards.
    """

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, classes: int, tags: int, hidden: int = HIDDEN, kind: str = "f4") -> "CharCrf":
        rng = np.random.default_rng(SEED)

        def drawn(*shape: int) -> np.ndarray:
            return rng.normal(0, SCALE, shape)

        bias = np.zeros((2, 1, 4 * hidden))
        bias[:, :, hidden : 2 * hidden] = 1  # remember at first
        drawn_weights = {
            "input": drawn(2, classes, 4 * hidden), "state": drawn(2, hidden, 4 * hidden),
            "bias": bias, "out": drawn(2 * hidden, tags), "out_bias": np.zeros(tags),
            "moves": np.zeros((tags, tags)), "first": np.zeros(tags), "last": np.zeros(tags),
        }
        return cls({name: value.astype(kind) for name, value in drawn_weights.items()})

    def _run(self, windows: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """Hidden states ``(length, 2, rows, hidden)`` and what the way back needs."""
        w = self.weights
        hidden = w["state"].shape[1]
        rows, length = windows.shape
        read = np.stack([windows, windows[:, ::-1]])
        h = c = np.zeros((2, rows, hidden), w["state"].dtype)
        states, kept = np.empty((length, 2, rows, hidden), w["state"].dtype), []
        side = np.arange(2)[:, None]
        for t in range(length):
            gates = w["input"][side, read[:, :, t]] + h @ w["state"] + w["bias"]
            keep = _sigmoid(gates[:, :, : 3 * hidden])
            new = np.tanh(gates[:, :, 3 * hidden :])
            i, f, o = np.split(keep, 3, axis=2)
            before = c
            c = f * c + i * new
            squashed = np.tanh(c)
            kept.append((i, f, o, new, before, squashed, h))
            h = o * squashed
            states[t] = h
        return states, kept

    def _emissions(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both directions side by side, and the score of each tag at each place."""
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
        return both, both @ self.weights["out"] + self.weights["out_bias"]

    def gradient(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tags, and its gradient."""
        w, rows, length = self.weights, *windows.shape
        states, kept = self._run(windows)
        both, scores = self._emissions(states)
        moves, at = w["moves"], np.arange(rows)
        ahead, back = np.empty_like(scores), np.empty_like(scores)
        ahead[0] = scores[0] + w["first"]
        for t in range(1, length):
            ahead[t] = scores[t] + _logsum(ahead[t - 1][:, :, None] + moves, 1)
        back[-1] = w["last"]
        for t in range(length - 2, -1, -1):
            back[t] = _logsum(moves + (scores[t + 1] + back[t + 1])[:, None, :], 2)
        total = _logsum(ahead[-1] + w["last"], 1)
        grad = {name: np.zeros_like(value) for name, value in w.items()}
        wrong = np.exp(ahead + back - total[:, None])
        pairs = ahead[:-1, :, :, None] + moves + (scores[1:] + back[1:])[:, :, None, :]
        grad["moves"] += np.exp(pairs - total[:, None, None]).sum(axis=(0, 1))
        place = np.arange(length)[:, None]
        truth = tags.T
        gold = scores[place, at, truth].sum(axis=0) + w["first"][truth[0]] + w["last"][truth[-1]]
        gold = gold + moves[truth[:-1], truth[1:]].sum(axis=0)
        np.subtract.at(grad["moves"], (truth[:-1], truth[1:]), 1)
        wrong[place, at, truth] -= 1
        grad["first"], grad["last"] = wrong[0].sum(axis=0), wrong[-1].sum(axis=0)
        grad["out"] = np.tensordot(both, wrong, ((0, 1), (0, 1)))
        grad["out_bias"] = wrong.sum(axis=(0, 1))
        back_both = wrong @ w["out"].T
        hidden = w["state"].shape[1]
        from_out = np.stack([back_both[:, :, :hidden], back_both[::-1, :, hidden:]], axis=1)
        read = np.stack([windows, windows[:, ::-1]])
        dh = dc = np.zeros_like(states[0])
        came = np.empty((length, 2, rows, 4 * hidden), states.dtype)
        for t in range(length - 1, -1, -1):
            i, f, o, new, before, squashed, h = kept[t]
            dh = dh + from_out[t]
            dc = dc + dh * o * (1 - squashed**2)
            gates = np.concatenate(
                [dc * new * i * (1 - i), dc * before * f * (1 - f),
                 dh * squashed * o * (1 - o), dc * i * (1 - new**2)], axis=2,
            )
            came[t] = gates
            grad["state"] += h.transpose(0, 2, 1) @ gates
            grad["bias"] += gates.sum(axis=1, keepdims=True)
            dh = gates @ w["state"].transpose(0, 2, 1)
            dc = dc * f
        for side in (0, 1):
            for value in np.unique(windows):
                grad["input"][side, value] = came[:, side][read[side].T == value].sum(axis=0)
        return float((total - gold).mean()), {name: g / rows for name, g in grad.items()}

    def fit(
        self, windows: np.ndarray, tags: np.ndarray, rounds: int = ROUNDS, seed: int = SEED
    ) -> list[float]:
        """Train by Adam with a falling step; the mean loss of each round."""
        rng = np.random.default_rng(seed)
        mean = {name: np.zeros_like(value) for name, value in self.weights.items()}
        square = {name: np.zeros_like(value) for name, value in self.weights.items()}
        step, losses = 0, []
        steps = rounds * max(1, -(-len(windows) // STEP))
        for _ in range(rounds):
            order, some = rng.permutation(len(windows)), []
            for start in range(0, len(order), STEP):
                chosen = order[start : start + STEP]
                loss, grad = self.gradient(windows[chosen], tags[chosen])
                some.append(loss)
                step += 1
                length = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
                rate = RATE * (1 - 0.9 * step / steps)
                for name, g in grad.items():
                    g = g * min(1.0, 5.0 / max(length, 1e-12))
                    mean[name] = 0.9 * mean[name] + 0.1 * g
                    square[name] = 0.99 * square[name] + 0.01 * g**2
                    self.weights[name] = self.weights[name] - rate * (
                        mean[name] / (1 - 0.9**step)
                    ) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-8)
            losses.append(float(np.mean(some)))
        return losses

    def decode(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags of each window, and how much better each place's tag scores than no span
        (tag 0) there."""
        w = self.weights
        scores = self._emissions(self._run(windows)[0])[1]
        length, rows, tags = scores.shape
        best, came = scores[0] + w["first"], np.empty((length, rows, tags), np.int8)
        for t in range(1, length):
            reached = best[:, :, None] + w["moves"]
            came[t] = reached.argmax(axis=1)
            best = reached.max(axis=1) + scores[t]
        at, path = np.arange(rows), np.empty((length, rows), np.int64)
        path[-1] = (best + w["last"]).argmax(axis=1)
        for t in range(length - 1, 0, -1):
            path[t - 1] = came[t, at, path[t]]
        chosen = scores[np.arange(length)[:, None], at, path]
        return path.T, (chosen - scores[:, :, 0]).T
