"""A character tagger in numpy: an LSTM in each direction under a linear-chain CRF.

Tags are O, B and I for each kind. Characters are read as code points; those beyond Latin-1 share one class.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

CLASSES = 257  # Latin-1 code points and one class for all others
EMBED, HIDDEN = 12, 16
BARRED = -1e4  # the score of a transition that cannot be
RATE, CLIP = 0.015, 5.0
Weights = dict[str, np.ndarray]


def tag_count(kinds: int) -> int:
    return 1 + 2 * kinds


def barred(kinds: int, dtype=np.float32) -> np.ndarray:
    """Inside a span of a kind only its beginning or its inside may precede."""
    out = np.zeros((tag_count(kinds) + 1, tag_count(kinds)), dtype)  # the last row: before the first character
    for k in range(kinds):
        inside = 2 + 2 * k
        out[:, inside] = BARRED
        out[[inside - 1, inside], inside] = 0
    return out


def characters(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), CLASSES - 1).astype(np.int64)


def tags_of(length: int, spans: Sequence[tuple[int, int, int]]) -> np.ndarray:
    """Tags from spans ``(start, end, kind)``."""
    out = np.zeros(length, np.int64)
    for a, b, kind in spans:
        out[a:b] = 2 + 2 * kind
        out[a] = 1 + 2 * kind
    return out


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans ``(start, end, kind)`` from tags."""
    out = []
    for a in np.flatnonzero(tags % 2 == 1).tolist():
        b = a + 1
        while b < len(tags) and tags[b] == tags[a] + 1:
            b += 1
        out.append((a, b, int(tags[a] - 1) // 2))
    return out


def new_weights(kinds: int, rng: np.random.Generator, dtype=np.float32) -> Weights:
    def draw(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(dtype)

    w = {"embed": draw(CLASSES, EMBED) * 4, "out": draw(2 * HIDDEN, tag_count(kinds)), "bias": np.zeros(tag_count(kinds), dtype)}
    for side in ("f", "b"):
        w |= {f"{side}x": draw(EMBED, 4 * HIDDEN), f"{side}h": draw(HIDDEN, 4 * HIDDEN), f"{side}c": np.zeros(4 * HIDDEN, dtype)}
        w[f"{side}c"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
    w["moves"] = np.zeros((tag_count(kinds) + 1, tag_count(kinds)), dtype)
    return w


def backwards(lengths: np.ndarray, width: int) -> np.ndarray:
    """The place of each character when its text is read from the end; padding stays where it is."""
    at = np.arange(width)[None, :]
    return np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)


def _lstm(w: Weights, side: str, x: np.ndarray, memory: list | None) -> np.ndarray:
    """States ``[time, row, hidden]`` for inputs ``[time, row, embed]``."""
    n, hidden = x.shape[1], HIDDEN
    gates_in = x @ w[f"{side}x"] + w[f"{side}c"]
    h, c = np.zeros((n, hidden), x.dtype), np.zeros((n, hidden), x.dtype)
    out = np.empty((len(x), n, hidden), x.dtype)
    for t in range(len(x)):
        z = gates_in[t] + h @ w[f"{side}h"]
        gates = 0.5 * (1 + np.tanh(0.5 * z[:, : 3 * hidden]))  # input, forget, output
        new = np.tanh(z[:, 3 * hidden :])
        before = c
        c = gates[:, hidden : 2 * hidden] * c + gates[:, :hidden] * new
        bent = np.tanh(c)
        if memory is not None:
            memory.append((gates, new, before, bent))
        h = gates[:, 2 * hidden :] * bent
        out[t] = h
    return out


def _lstm_back(w: Weights, side: str, x: np.ndarray, states: np.ndarray, memory: list, d_states: np.ndarray, grad: Weights) -> np.ndarray:
    """Adds the gradients of one direction and returns those of its inputs."""
    n, hidden = x.shape[1], HIDDEN
    d_gates = np.empty((len(x), n, 4 * hidden), x.dtype)
    dh, dc = np.zeros((n, hidden), x.dtype), np.zeros((n, hidden), x.dtype)
    back = np.ascontiguousarray(w[f"{side}h"].T)
    for t in range(len(x) - 1, -1, -1):
        gates, new, before, bent = memory[t]
        dh = dh + d_states[t]
        dc = dc + dh * gates[:, 2 * hidden :] * (1 - bent * bent)
        d = d_gates[t]
        d[:, :hidden] = dc * new
        d[:, hidden : 2 * hidden] = dc * before
        d[:, 2 * hidden : 3 * hidden] = dh * bent
        d[:, : 3 * hidden] *= gates * (1 - gates)
        d[:, 3 * hidden :] = dc * gates[:, :hidden] * (1 - new * new)
        dc = dc * gates[:, hidden : 2 * hidden]
        dh = d @ back
    flat = d_gates.reshape(-1, 4 * hidden)
    previous = np.concatenate([np.zeros((1, n, hidden), x.dtype), states[:-1]]).reshape(-1, hidden)
    grad[f"{side}x"] = x.reshape(-1, x.shape[2]).T @ flat
    grad[f"{side}h"] = previous.T @ flat
    grad[f"{side}c"] = flat.sum(axis=0)
    return (flat @ w[f"{side}x"].T).reshape(x.shape)


def emissions(w: Weights, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Scores ``[row, time, tag]`` of texts that are padded to one width."""
    order = backwards(lengths, codes.shape[1])
    rows = np.arange(len(codes))[:, None]
    ahead = _lstm(w, "f", w["embed"][codes].transpose(1, 0, 2), None)
    behind = _lstm(w, "b", w["embed"][codes[rows, order]].transpose(1, 0, 2), None)
    both = np.concatenate([ahead.transpose(1, 0, 2), behind.transpose(1, 0, 2)[rows, order]], axis=2)
    return both @ w["out"] + w["bias"]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis=axis)) + top.squeeze(axis)


def chain_loss(scores: np.ndarray, moves: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of ``tags`` for ``scores`` ``[time, row, tag]``, and its gradients
    by score and by transition (the last row of ``moves`` comes before the first character)."""
    steps, n, tags_n = scores.shape
    pair = moves[:-1]
    ahead, behind = np.empty_like(scores), np.zeros_like(scores)
    ahead[0] = moves[-1] + scores[0]
    for t in range(1, steps):
        ahead[t] = _log_sum(ahead[t - 1][:, :, None] + pair[None], 1) + scores[t]
    for t in range(steps - 2, -1, -1):
        behind[t] = _log_sum(pair[None] + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
    total = _log_sum(ahead[-1], 1)
    d_scores = np.exp(ahead + behind - total[None, :, None])
    d_moves = np.empty_like(moves)
    d_moves[-1] = d_scores[0].sum(axis=0)
    joint = np.exp(ahead[:-1, :, :, None] + pair + (scores[1:] + behind[1:])[:, :, None, :] - total[None, :, None, None])
    d_moves[:-1] = joint.sum(axis=(0, 1))
    at, row = np.arange(steps)[:, None], np.arange(n)[None, :]
    path = scores[at, row, tags].sum(axis=0) + moves[-1][tags[0]] + pair[tags[:-1], tags[1:]].sum(axis=0)
    d_scores[at, row, tags] -= 1
    np.subtract.at(d_moves, (tags[:-1], tags[1:]), 1)
    np.subtract.at(d_moves[-1], tags[0], 1)
    return float((total - path).mean()), d_scores / n, d_moves / n


def loss_and_gradient(w: Weights, codes: np.ndarray, tags: np.ndarray, kinds: int) -> tuple[float, Weights]:
    """For texts of one length: ``codes`` and ``tags`` are ``[row, time]``."""
    forward, reverse = codes.T, codes[:, ::-1].T
    x, y = w["embed"][forward], w["embed"][reverse]
    kept_f, kept_b = [], []
    ahead, behind = _lstm(w, "f", x, kept_f), _lstm(w, "b", y, kept_b)
    both = np.concatenate([ahead, behind[::-1]], axis=2)
    loss, d, d_moves = chain_loss(both @ w["out"] + w["bias"], w["moves"] + barred(kinds, x.dtype), tags.T)
    d_both = d @ w["out"].T
    flat = d.reshape(-1, d.shape[2])
    grad = {"out": both.reshape(-1, both.shape[2]).T @ flat, "bias": flat.sum(axis=0), "moves": d_moves}
    dx = _lstm_back(w, "f", x, ahead, kept_f, d_both[:, :, :HIDDEN], grad)
    dy = _lstm_back(w, "b", y, behind, kept_b, np.ascontiguousarray(d_both[::-1, :, HIDDEN:]), grad)
    grad["embed"] = np.zeros_like(w["embed"])
    np.add.at(grad["embed"], forward, dx)
    np.add.at(grad["embed"], reverse, dy)
    return loss, grad


def train(texts: Sequence[str], spans: Sequence[Sequence[tuple[int, int, int]]], kinds: int, epochs: int = 8, batch: int = 64, seed: int = 7) -> Weights:
    """Weights by Adam over labelled texts of one length."""
    rng = np.random.default_rng(seed)
    w = new_weights(kinds, rng)
    codes = np.stack([characters(t) for t in texts])
    tags = np.stack([tags_of(codes.shape[1], s) for s in spans])
    moment = {k: np.zeros_like(v) for k, v in w.items()}
    spread = {k: np.zeros_like(v) for k, v in w.items()}
    steps = epochs * -(-len(codes) // batch)
    step = 0
    for _ in range(epochs):
        for chosen in np.array_split(rng.permutation(len(codes)), -(-len(codes) // batch)):
            step += 1
            _, grad = loss_and_gradient(w, codes[chosen], tags[chosen], kinds)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            scale = min(1.0, CLIP / (norm + 1e-12))
            rate = RATE * (1 - 0.9 * step / steps)
            for k, g in grad.items():
                g = g * scale
                moment[k] = 0.9 * moment[k] + 0.1 * g
                spread[k] = 0.999 * spread[k] + 0.001 * g * g
                w[k] = w[k] - rate * (moment[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.999**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in w.items()}


def decode(w: Weights, texts: Sequence[str], kinds: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its best tags, and by how much each tag's score exceeds that of O."""
    if not texts:
        return []
    read = [characters(t) for t in texts]
    lengths = np.array([len(r) for r in read])
    codes = np.zeros((len(read), max(1, int(lengths.max()))), np.int64)
    for row, r in zip(codes, read):
        row[: len(r)] = r
    scores = emissions(w, codes, lengths)
    moves = w["moves"] + barred(kinds)
    best = moves[-1] + scores[:, 0]
    came = np.zeros((codes.shape[1], *best.shape), np.int64)
    for t in range(1, codes.shape[1]):
        ways = best[:, :, None] + moves[None, :-1]
        came[t] = ways.argmax(axis=1)
        best = np.where((t < lengths)[:, None], ways.max(axis=1) + scores[:, t], best)
    tags = np.zeros(codes.shape, np.int64)
    rows = np.arange(len(codes))
    now = best.argmax(axis=1)
    for t in range(codes.shape[1] - 1, -1, -1):
        inside = t < lengths
        tags[inside, t] = now[inside]
        now = np.where(inside & (t > 0), came[t, rows, now], now)
    lead = np.take_along_axis(scores, tags[:, :, None], 2)[:, :, 0] - scores[:, :, 0]
    return [(tags[k, :n], lead[k, :n]) for k, n in enumerate(lengths.tolist())]
