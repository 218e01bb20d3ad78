"""A character tagger in numpy: bidirectional LSTM with CRF transitions.

Windows of equal length go through it in batches. Tags are "outside" and, for each kind, "begin" and "inside".
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Characters with an id of their own; all others share id 0.
KNOWN = {c: i + 1 for i, c in enumerate("\n\t" + "".join(map(chr, range(32, 127))))}
PADDING = len(KNOWN) + 1


def char_ids(text: str) -> list[int]:
    return [KNOWN.get(c, 0) for c in text]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tagger:
    kinds: list[str]
    width: int = 16
    hidden: int = 24
    seed: int = 1
    params: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        if self.params:
            return
        rng, tags = np.random.default_rng(self.seed), 1 + 2 * len(self.kinds)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.params = {"chars": draw(PADDING + 1, self.width)}
        for way in "fb":
            bias = np.zeros(4 * self.hidden, np.float32)
            bias[self.hidden : 2 * self.hidden] = 1  # remember at first
            self.params |= {f"{way}w": draw(self.width + self.hidden, 4 * self.hidden), f"{way}b": bias}
        self.params |= {"ow": draw(2 * self.hidden, tags), "ob": np.zeros(tags, np.float32), "moves": np.zeros((tags, tags), np.float32)}

    def allowed(self) -> np.ndarray:
        """Penalties: an inside tag only follows a begin or inside tag of its kind."""
        tags = len(self.params["ob"])
        out = np.zeros((tags, tags), np.float32)
        for i in range(2, tags, 2):
            out[:, i] = -1e4
            out[i - 1, i] = out[i, i] = 0
        return out

    def _run(self, x: np.ndarray, way: str, keep: list | None) -> np.ndarray:
        """Hidden states of one direction for inputs ``[time, batch, width]``."""
        w, b, n = self.params[f"{way}w"], self.params[f"{way}b"], self.hidden
        h = c = np.zeros((x.shape[1], n), np.float32)
        out = np.empty((len(x), x.shape[1], n), np.float32)
        for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
            joined = np.concatenate([x[t], h], 1)
            z = joined @ w + b
            gates = _sigmoid(z[:, : 3 * n])
            i, f, o, g = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :], np.tanh(z[:, 3 * n :])
            before, c = c, f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            out[t] = h
            if keep is not None:
                keep.append((t, joined, i, f, o, g, before, squashed))
        return out

    def emissions(self, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Scores ``[time, batch, tag]`` of windows ``[batch, time]``."""
        x = self.params["chars"][ids.T]
        trace = {"f": None, "b": None} if keep is None else {"f": [], "b": []}
        both = np.concatenate([self._run(x, way, trace[way]) for way in "fb"], 2)
        if keep is not None:
            keep |= {"both": both, "trace": trace}
        return both @ self.params["ow"] + self.params["ob"]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The best tags ``[batch, time]``."""
        scores, moves = self.emissions(ids), self.params["moves"] + self.allowed()
        best = scores[0].copy()
        best[:, 2::2] -= 1e4  # nothing begins inside
        back = []
        for t in range(1, len(scores)):
            paths = best[:, :, None] + moves[None]
            back.append(paths.argmax(1))
            best = paths.max(1) + scores[t]
        tags = [best.argmax(1)]
        for step in reversed(back):
            tags.append(np.take_along_axis(step, tags[-1][:, None], 1)[:, 0])
        return np.array(tags[::-1]).T

    def loss_and_slopes(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags ``[batch, time]``, and its gradients."""
        keep: dict = {}
        scores = self.emissions(ids, keep).astype(np.float64)
        moves, time, batch = (self.params["moves"] + self.allowed()).astype(np.float64), ids.shape[1], ids.shape[0]
        lines, path = np.arange(batch), tags.T

        def total(a, axis):
            top = a.max(axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis))

        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, time):
            ahead[t] = total(ahead[t - 1][:, :, None] + moves[None], 1) + scores[t]
        for t in range(time - 2, -1, -1):
            behind[t] = total(moves[None] + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        norm = total(ahead[-1], 1)
        gold = sum(scores[t][lines, path[t]] for t in range(time)) + sum(moves[path[t - 1], path[t]] for t in range(1, time))
        slope = np.exp(ahead + behind - norm[None, :, None])
        for t in range(time):
            slope[t][lines, path[t]] -= 1
        slope = (slope / batch).astype(np.float32)
        by_move = np.zeros_like(moves)
        for t in range(1, time):
            pair = ahead[t - 1][:, :, None] + moves[None] + (scores[t] + behind[t])[:, None, :] - norm[:, None, None]
            by_move += np.exp(pair).sum(0)
            np.add.at(by_move, (path[t - 1], path[t]), -1)
        out = {
            "moves": (by_move / batch).astype(np.float32), "ob": slope.sum((0, 1)),
            "ow": np.einsum("tbh,tbk->hk", keep["both"], slope),
        }
        back, n = slope @ self.params["ow"].T, self.hidden
        by_char = np.zeros((time, batch, self.width), np.float32)
        for way, part in (("f", back[:, :, :n]), ("b", back[:, :, n:])):
            w = self.params[f"{way}w"]
            by_w, by_b = np.zeros_like(w), np.zeros(4 * n, np.float32)
            dh = dc = np.zeros((batch, n), np.float32)
            for t, joined, i, f, o, g, before, squashed in reversed(keep["trace"][way]):
                dh = dh + part[t]
                dc = dc + dh * o * (1 - squashed**2)
                z = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], 1)
                by_w += joined.T @ z
                by_b += z.sum(0)
                down = z @ w.T
                by_char[t] += down[:, : self.width]
                dh, dc = down[:, self.width :], dc * f
            out |= {f"{way}w": by_w, f"{way}b": by_b}
        out["chars"] = np.zeros_like(self.params["chars"])
        np.add.at(out["chars"], ids.T, by_char)
        return float((norm - gold).mean()), out

    def fit(self, ids: np.ndarray, tags: np.ndarray, steps: int = 300, batch: int = 128, rate: float = 0.01) -> "Tagger":
        """Adam over random batches, gradients cut at a norm of 5."""
        rng = np.random.default_rng(self.seed)
        mean = {k: np.zeros_like(p) for k, p in self.params.items()}
        square = {k: np.zeros_like(p) for k, p in self.params.items()}
        for step in range(1, steps + 1):
            some = rng.integers(0, len(ids), min(batch, len(ids)))
            _, slopes = self.loss_and_slopes(ids[some], tags[some])
            size = np.sqrt(sum(float((g**2).sum()) for g in slopes.values()))
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in slopes.items():
                g = g * min(1.0, 5 / (size + 1e-9))
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                self.params[k] -= now * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
        return self
