"""Character-level bidirectional LSTM with CRF transitions, in numpy: training, scores and decoding."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Characters with a class of their own. Other letters, digits and characters share three more.
ALPHABET = "abcdefghijklmnopqrstuvwxyz !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\n\t"
PAD, UPPER, DIGIT, LETTER, OTHER = range(5)
_CLASS = {c: i + 5 for i, c in enumerate(ALPHABET)}
CLASSES = len(ALPHABET) + 5


def char_class(c: str) -> int:
    known = _CLASS.get(c)
    if known is not None:
        return known
    if "A" <= c <= "Z":
        return UPPER
    if "0" <= c <= "9":
        return DIGIT
    return LETTER if c.isalpha() else OTHER


def classes(text: str) -> np.ndarray:
    return np.fromiter(map(char_class, text), np.int64, len(text))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray):
    """Hidden states over time (steps, batch, units), and what the backward pass needs."""
    n = len(u)
    z_in = x @ w + b
    h = c = np.zeros((x.shape[1], n), x.dtype)
    hidden, saved = [], []
    for z_t in z_in:
        z = z_t + h @ u
        gates, g = _sigmoid(z[:, : 3 * n]), np.tanh(z[:, 3 * n :])
        i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
        before, h_before = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        hidden.append(h)
        saved.append((gates, g, before, squashed, h_before))
    return np.stack(hidden), saved


def _lstm_back(dh_all: np.ndarray, x: np.ndarray, saved: list, w: np.ndarray, u: np.ndarray):
    n = len(u)
    dz_all = np.empty((*dh_all.shape[:2], 4 * n), x.dtype)
    dh = dc = np.zeros(dh_all.shape[1:], x.dtype)
    du = np.zeros_like(u)
    for t in range(len(dh_all) - 1, -1, -1):
        gates, g, before, squashed, h_before = saved[t]
        i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
        dh = dh + dh_all[t]
        dc = dc + dh * o * (1 - squashed**2)
        d = np.concatenate([dc * g, dc * before, dh * squashed], axis=1) * gates * (1 - gates)
        dz = dz_all[t] = np.concatenate([d, dc * i * (1 - g**2)], axis=1)
        dc = dc * f
        dh = dz @ u.T
        du += h_before.T @ dz
    flat = dz_all.reshape(-1, 4 * n)
    return dz_all @ w.T, x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(axis=0)


@dataclass(frozen=True)
class Tagger:
    """Parameters by name: embed, and for each direction w, u, b; out, bias; moves (tag to tag) and start."""

    p: dict[str, np.ndarray]

    @property
    def tags(self) -> int:
        return len(self.p["start"])

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (windows, steps, tags) of windows of character classes (windows, steps)."""
        p = self.p
        e = p["embed"][x.T]
        ahead, _ = _lstm(e, p["w0"], p["u0"], p["b0"])
        back, _ = _lstm(e[::-1], p["w1"], p["u1"], p["b1"])
        both = np.concatenate([ahead, back[::-1]], axis=2)
        return (both @ p["out"] + p["bias"]).transpose(1, 0, 2)

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Best tag sequence of one stretch (steps, tags)."""
        moves = self.p["moves"]
        best = self.p["start"] + scores[0]
        back = np.empty(scores.shape, np.int64)
        for t in range(1, len(scores)):
            ways = best[:, None] + moves
            back[t] = ways.argmax(axis=0)
            best = ways.max(axis=0) + scores[t]
        out = np.empty(len(scores), np.int64)
        out[-1] = best.argmax()
        for t in range(len(scores) - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out


def loss_and_gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of the tags ``y`` of windows ``x`` (both windows, steps), and its gradients."""
    x, y = x.T, y.T
    steps, batch = x.shape
    e = p["embed"][x]
    ahead, saved0 = _lstm(e, p["w0"], p["u0"], p["b0"])
    back, saved1 = _lstm(e[::-1], p["w1"], p["u1"], p["b1"])
    both = np.concatenate([ahead, back[::-1]], axis=2)
    scores = both @ p["out"] + p["bias"]
    moves = p["moves"]
    alpha = np.empty_like(scores)
    alpha[0] = p["start"] + scores[0]
    for t in range(1, steps):
        alpha[t] = _logsumexp(alpha[t - 1][:, :, None] + moves, 1) + scores[t]
    total = _logsumexp(alpha[-1], 1)
    beta = np.zeros_like(scores)
    for t in range(steps - 2, -1, -1):
        beta[t] = _logsumexp(moves + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
    rows = np.arange(batch)
    gold = p["start"][y[0]] + scores[0][rows, y[0]]
    for t in range(1, steps):
        gold = gold + moves[y[t - 1], y[t]] + scores[t][rows, y[t]]
    d = np.exp(alpha + beta - total[:, None])
    g = {}
    d[np.arange(steps)[:, None], rows, y] -= 1
    pairs = np.exp(alpha[:-1, :, :, None] + moves + (scores[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None])
    g["moves"] = pairs.sum(axis=(0, 1))
    np.add.at(g["moves"], (y[:-1].ravel(), y[1:].ravel()), -1)
    g["start"] = d[0].sum(axis=0)
    g["bias"] = d.sum(axis=(0, 1))
    g["out"] = both.reshape(-1, both.shape[2]).T @ d.reshape(-1, d.shape[2])
    d_both = d @ p["out"].T
    n = len(p["u0"])
    de0, g["w0"], g["u0"], g["b0"] = _lstm_back(d_both[:, :, :n], e, saved0, p["w0"], p["u0"])
    de1, g["w1"], g["u1"], g["b1"] = _lstm_back(d_both[::-1, :, n:], e[::-1], saved1, p["w1"], p["u1"])
    g["embed"] = np.zeros_like(p["embed"])
    np.add.at(g["embed"], x.ravel(), (de0 + de1[::-1]).reshape(-1, e.shape[2]))
    return float((total - gold).mean()), {k: v / batch for k, v in g.items()}


def initial(tags: int, width: int, units: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    p = {"embed": rng.normal(0, 0.5, (CLASSES, width)), "out": draw(2 * units, tags), "bias": np.zeros(tags)}
    for k in "01":
        p |= {f"w{k}": draw(width, 4 * units), f"u{k}": draw(units, 4 * units), f"b{k}": np.zeros(4 * units)}
        p[f"b{k}"][units : 2 * units] = 1
    return p | {"moves": np.zeros((tags, tags)), "start": np.zeros(tags)}


def train(
    x: np.ndarray, y: np.ndarray, tags: int, width: int = 12, units: int = 20, epochs: int = 8, batch: int = 64,
    rate: float = 0.01, seed: int = 6,
) -> Tagger:
    """Fit by Adam with a falling rate. The same windows in the same order give the same model."""
    p = {k: a.astype(np.float32) for k, a in initial(tags, width, units, seed).items()}
    rng = np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    step, last = 0, epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            _, g = loss_and_gradients(p, x[order[lo : lo + batch]], y[order[lo : lo + batch]])
            step += 1
            size = np.sqrt(sum(float((a**2).sum()) for a in g.values()))
            now = rate * (1 - 0.9 * step / last)
            for k, a in g.items():
                a = a * min(1, 5 / (size + 1e-12))
                m[k] = 0.9 * m[k] + 0.1 * a
                v[k] = 0.999 * v[k] + 0.001 * a**2
                p[k] = p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Tagger(p)
