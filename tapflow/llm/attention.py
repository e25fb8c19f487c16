"""A small causal self-attention model over subword ids, in numpy: training by hand-made gradients, and scoring.

One attention head, a feed-forward layer and a softmax over classes of ids; within its class an id has its
share of the corpus counts. Documents are read in windows that overlap: a window scores the ids of its second half, its first half
is context only (masked where the document hasn't begun), so each id is scored once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

DIM, HIDDEN, CLASSES = 16, 32, 64
NEAR = 24  # numbers that sum up an id's neighbours on either side
WINDOW, STEP = 24, 12
AT_ONCE = 256  # windows
AHEAD = 64  # steps whose windows are laid out at once
_LARGEST = np.float32(60)  # of what is exponentiated
BATCH, RATE, ID_RATE = 128, 0.01, 0.1
_SCALE = np.float32(1 / np.sqrt(DIM))
_SEEN = np.tri(STEP, WINDOW, WINDOW - STEP, dtype=np.float32)
_PLACES = np.arange(STEP)


@dataclass
class Attention:
    """Parameters; `klass` of each id, and log probability of each id within its class."""

    ids: np.ndarray
    dense: dict[str, np.ndarray]
    klass: np.ndarray
    within: np.ndarray

    def copy(self) -> Attention:
        """One whose fitted parameters may change."""
        return Attention(self.ids.copy(), {k: v.copy() for k, v in self.dense.items()}, self.klass, self.within)


class Neighbours:
    """Sums of what stands beside each id: a neighbour adds its weight, under a random sign, to one of NEAR numbers a side."""

    def __init__(self, counts: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.size = len(counts)
        self.place = rng.integers(0, NEAR, self.size)
        self.weight = rng.choice([-1.0, 1.0], self.size) / np.sqrt(counts + 1.0)  # frequent neighbours say less

    def of(self, ids: np.ndarray) -> np.ndarray:
        """One row per id of the vocabulary; rows of parts of a corpus add up."""
        own, place, weight = ids.astype(np.int64) * NEAR, self.place[ids], self.weight[ids]
        sides = ((own[1:], place[:-1], weight[:-1]), (own[:-1], place[1:], weight[1:]))
        return np.concatenate([np.bincount(a + b, w, self.size * NEAR).reshape(-1, NEAR) for a, b, w in sides], axis=1)


def classes_of(ids: np.ndarray, size: int, seed: int = 5) -> np.ndarray:
    """Classes of ids that stand beside like ids."""
    counts = np.bincount(ids, minlength=size)
    return classes(Neighbours(counts, seed).of(ids), counts)


def classes(near: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Classes by k-means over the sums of neighbours."""
    size = len(counts)
    near = (near / (np.linalg.norm(near, axis=1, keepdims=True) + 1e-6)).astype(np.float32)
    seen = np.flatnonzero(counts)
    out = np.zeros(size, np.int16)
    if len(seen) <= CLASSES:
        out[seen] = np.arange(len(seen))
        return out
    frequent = seen[np.argsort(-counts[seen], kind="stable")]
    middle = near[frequent[:CLASSES]].copy()
    weight = np.sqrt(counts[seen]).astype(np.float32)
    for _ in range(12):
        nearest = (near[seen] @ middle.T).argmax(axis=1)
        total = np.zeros_like(middle)
        np.add.at(total, nearest, near[seen] * weight[:, None])
        middle = total / (np.linalg.norm(total, axis=1, keepdims=True) + 1e-6)
    out[seen] = (near[seen] @ middle.T).argmax(axis=1)
    return out


def shares(klass: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Natural log of each id's share of its class, every id counted once more than it occurs."""
    more = counts + 1.0
    return np.log(more / np.bincount(klass, more, CLASSES)[klass]).astype(np.float32)


def fresh(size: int, klass: np.ndarray, within: np.ndarray, seed: int = 5) -> Attention:
    rng = np.random.default_rng(seed)

    def normal(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    dense = {
        "place": normal(WINDOW, DIM) * 0.3, "q": normal(DIM, DIM), "k": normal(DIM, DIM), "v": normal(DIM, DIM),
        "o": normal(DIM, DIM) * 0.3, "up": normal(DIM, HIDDEN), "bias": np.zeros(HIDDEN, np.float32),
        "down": normal(HIDDEN, DIM) * 0.3, "out": normal(DIM, CLASSES) * 0.3, "constant": np.zeros(CLASSES, np.float32),
    }
    dense["constant"][np.bincount(klass, minlength=CLASSES) == 0] = -_LARGEST  # classes that no id has
    return Attention(rng.normal(0, 0.5, (size, DIM)).astype(np.float32), dense, klass, within)


def _sums(rows: np.ndarray) -> np.ndarray:
    """The sum of each row (a product with ones is faster than a sum along short rows)."""
    return rows @ np.ones(rows.shape[-1], np.float32)


def _exp(values: np.ndarray) -> np.ndarray:
    """Exponentials, in place, of values that are cut at the largest."""
    if values.size and values.max() > _LARGEST:
        np.minimum(values, _LARGEST, out=values)
    return np.exp(values, out=values)


def _weights(q: np.ndarray, x: np.ndarray, opening: np.ndarray) -> np.ndarray:
    """Of windows' places (queries, rows), what they attend to, not yet divided by its sum."""
    a = _exp(np.matmul(q, x.transpose(0, 2, 1)))
    a *= _SEEN
    a[opening, :, : WINDOW - STEP] = 0
    return a


def _folded(p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The parameters as places need them: of two that no other step comes between the product, constants as a last row.

    `down` is halved, as the rows before it are doubled, and keeps the ones that rows end with.
    """
    return {
        "qk": p["q"] @ p["k"].T * _SCALE, "vo": p["v"] @ p["o"],
        "up": np.concatenate([p["up"], p["bias"][None]]), "out": np.concatenate([p["out"], p["constant"][None]]),
        "down": np.concatenate([p["down"] * np.float32(0.5), np.zeros((HIDDEN, 1), np.float32)], axis=1),
    }


def _states(f: dict[str, np.ndarray], x: np.ndarray, opening: np.ndarray) -> dict[str, np.ndarray]:
    """The last STEP places of windows attend to all places up to their own; windows that open a document have no others.

    All but the attention is done on one row per place: a product of few large matrices, not one of each window.
    """
    n = len(x)
    y = x[:, WINDOW - STEP :].reshape(-1, DIM)
    q = y @ f["qk"]
    a = _weights(q.reshape(n, STEP, DIM), x, opening)
    total = _sums(a.reshape(-1, WINDOW))[:, None]
    o = np.matmul(a, x).reshape(-1, DIM)
    o /= total
    h = np.ones((n * STEP, DIM + 1), np.float32)
    np.add(o @ f["vo"], y, out=h[:, :DIM])
    r = h @ f["up"]
    r += np.abs(r)  # twice what is above 0, and 0
    g = r @ f["down"]
    g += h
    return {"y": y, "q": q, "a": a, "total": total, "o": o, "h": h, "r": r, "rows": g}


def _forward(model: Attention, ids: np.ndarray, opening: np.ndarray) -> dict[str, np.ndarray]:
    """What `_states` makes of windows of ids; `g` are the rows without the ones at their ends."""
    f = _folded(model.dense)
    x = model.ids.take(ids, axis=0)
    x += model.dense["place"]
    found = _states(f, x, opening)
    return found | {"x": x.reshape(-1, DIM), "g": found["rows"][:, :DIM].reshape(len(ids), STEP, DIM), "folded": f}


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=-1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=-1, keepdims=True))


class Windows:
    """All windows over documents of so many ids (one at least): what they read, which places they score, and whose id those are.

    The ids are laid out in blocks of STEP, a block of none before each document: a window is two blocks that follow each other.
    """

    def __init__(self, ids: np.ndarray, counts: np.ndarray, end: int):
        first = np.cumsum(counts) - counts
        many = -(-counts // STEP)
        begin = np.cumsum(many + 1) - many  # each document's first block
        self.doc = np.repeat(np.arange(len(counts)), many)
        self.block = np.arange(len(self.doc)) + self.doc + 1
        self.opening = np.zeros(len(self.doc), bool)
        self.opening[np.cumsum(many) - many] = True
        # a window's first scored id, and how many it scores
        place = (np.arange(len(self.doc)) - np.repeat(np.cumsum(many) - many, many)) * STEP
        self.first, self.size = first[self.doc] + place, np.minimum(counts[self.doc] - place, STEP)
        before = np.full((len(self.doc) + len(counts)) * STEP, end, ids.dtype)
        at = np.arange(len(ids)) + np.repeat(begin * STEP - first, counts)
        before[at[1:]] = ids[:-1]
        before[begin * STEP] = end
        self.given = np.lib.stride_tricks.sliding_window_view(before, WINDOW)[::STEP] if len(ids) else before.reshape(-1, WINDOW)

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        inside = _PLACES < self.size[which][:, None]
        return self.given[self.block[which] - 1], self.opening[which], inside, self.first[which][:, None] + _PLACES * inside


class Scorer:
    """The forward pass alone."""

    def __init__(self, model: Attention):
        self.model, self.folded = model, _folded(model.dense)

    def logits(self, ids: np.ndarray, opening: np.ndarray) -> np.ndarray:
        """One row per place of the windows' last STEP, one column per class."""
        x = self.model.ids.take(ids, axis=0)
        x += self.model.dense["place"]
        return _states(self.folded, x, opening)["rows"] @ self.folded["out"]


def log_probabilities(model: Attention, ids: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """Natural log of the probability of each id, given those before it in its document."""
    out = np.empty(len(ids), np.float32)
    all_, scorer = Windows(ids, counts, end), Scorer(model)
    klass = model.klass[ids].astype(np.int64)
    for at in range(0, len(all_.doc), AT_ONCE):
        given, opening, scored, where = all_.take(np.arange(at, min(at + AT_ONCE, len(all_.doc))))
        logits = scorer.logits(given, opening)
        chosen = np.minimum(logits.reshape(-1)[np.arange(0, logits.size, CLASSES) + klass[where].reshape(-1)], _LARGEST)
        chosen -= np.log(_sums(_exp(logits)))
        scored = scored.reshape(-1)
        out[where.reshape(-1)[scored]] = chosen[scored]
    out += model.within[ids]
    return out


@dataclass
class Progress:
    """What the steps so far leave to the next: Adam's means, Adagrad's sums per id, and how often an id was read."""

    mean: dict[str, np.ndarray]
    square: dict[str, np.ndarray]
    sums: np.ndarray
    step: int = 0
    read: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))

    def copy(self) -> Progress:
        return Progress({k: v.copy() for k, v in self.mean.items()}, {k: v.copy() for k, v in self.square.items()}, self.sums.copy(), self.step, self.read.copy())

    @classmethod
    def start(cls, model: Attention) -> Progress:
        return cls(
            {k: np.zeros_like(v) for k, v in model.dense.items()}, {k: np.zeros_like(v) for k, v in model.dense.items()},
            np.full(len(model.ids), 1e-6, np.float32), 0, np.zeros(len(model.ids), np.float32),
        )


def train(
    model: Attention, ids: np.ndarray, counts: np.ndarray, end: int, epochs: int = 1, seed: int = 5,
    progress: Progress | None = None, pace: tuple[float, float] = (1.0, 0.0), batch: int = BATCH,
) -> None:
    """Fit all parameters but the classes, by Adam and (for ids) Adagrad over windows in random order.

    `progress` goes on from earlier steps; `pace` is the share of the rate that an epoch begins and ends with (0.1 at least).
    """
    rng = np.random.default_rng(seed)
    all_ = Windows(ids, counts, end)
    klass = model.klass[ids].astype(np.int64)
    p = Progress.start(model) if progress is None else progress
    # side by side, so that a step is a few operations on all parameters at once; the dictionaries show parts of these
    dense, mean, square = _side_by_side(model.dense), _side_by_side(p.mean), _side_by_side(p.square)
    for _ in range(epochs):
        order = rng.permutation(len(all_.doc))
        for ahead in range(0, len(order), AHEAD * batch):
            given, opening, scored, where = all_.take(order[ahead : ahead + AHEAD * batch])
            target, met = klass[where], []
            for at in range(0, len(given), batch):
                now = slice(at, at + batch)
                grads, touched, rows = _gradients(model, given[now], opening[now], target[now], scored[now])
                p.step += 1
                rate = RATE * min(1.0, p.step / 50) * max(0.1, pace[0] + (pace[1] - pace[0]) * (ahead + at) / len(order))
                g = np.concatenate([grads[k].reshape(-1) for k in model.dense])
                mean += 0.1 * (g - mean)
                square += 0.01 * (g * g - square)
                dense -= rate * (mean / (1 - 0.9**p.step)) / (np.sqrt(square / (1 - 0.99**p.step)) + 1e-8)
                sums = p.sums[touched] + _sums(rows * rows) / DIM
                p.sums[touched] = sums
                rows *= (ID_RATE / np.sqrt(sums))[:, None]
                model.ids[touched] -= rows
                met.append(touched)
            p.read += np.bincount(np.concatenate(met), minlength=len(p.read))


def _side_by_side(parts: dict[str, np.ndarray]) -> np.ndarray:
    """All parts in one array; `parts` then holds views of it."""
    whole, at = np.concatenate([x.reshape(-1) for x in parts.values()]), 0
    for k, x in parts.items():
        parts[k] = whole[at : at + x.size].reshape(x.shape)
        at += x.size
    return whole


def _gradients(model: Attention, ids: np.ndarray, opening: np.ndarray, target: np.ndarray, inside: np.ndarray):
    """Slopes of the mean loss: of each dense parameter, the distinct ids, and of each one's row."""
    p, n, s = model.dense, len(ids), _forward(model, ids, opening)
    f, x = s["folded"], s["x"].reshape(n, WINDOW, DIM)
    # of each place and class the probability, less 1 for the target, times the sum that it is yet to be divided by
    e = _exp(s["rows"] @ f["out"])
    total = _sums(e) + np.float32(1e-30)
    e.reshape(-1)[np.arange(0, e.size, CLASSES) + target.reshape(-1)] -= total
    share = ((inside.reshape(-1) / np.float32(max(1, int(inside.sum())))).astype(np.float32) / total)[:, None]
    both = (s["rows"] * share).T @ e
    grads = {"out": both[:DIM], "constant": both[DIM]}
    dg = e @ p["out"].T
    dg *= share
    grads["down"] = s["r"].T @ dg * np.float32(0.5)
    dz = dg @ p["down"].T
    dz *= s["r"] > 0
    both = s["h"].T @ dz
    grads["up"], grads["bias"] = both[:DIM], both[DIM]
    dh = dz @ p["up"].T
    dh += dg
    both = s["o"].T @ dh
    grads["v"], grads["o"] = both @ p["o"].T, p["v"].T @ both
    do = dh @ f["vo"].T
    do /= s["total"]
    # what a place's weights lose by adding up to 1
    lost = _sums(do * s["o"]).reshape(n, STEP, 1)
    do = do.reshape(n, STEP, DIM)
    ds = np.matmul(do, x.transpose(0, 2, 1))
    ds -= lost
    ds *= s["a"]
    dq = np.matmul(ds, x).reshape(-1, DIM)
    both = s["y"].T @ dq * _SCALE
    grads["q"], grads["k"] = both @ p["k"], both.T @ p["q"]
    dx = np.matmul(s["a"].transpose(0, 2, 1), do)
    dx += np.matmul(ds.transpose(0, 2, 1), s["q"].reshape(n, STEP, DIM))
    dh += dq @ f["qk"].T
    dx[:, WINDOW - STEP :] += dh.reshape(n, STEP, DIM)
    grads["place"] = (np.ones(n, np.float32) @ dx.reshape(n, -1)).reshape(WINDOW, DIM)
    touched, order, begin = _by_id(ids.reshape(-1), len(model.ids))
    pairs = dx.reshape(-1, DIM).view(np.complex64)  # two numbers are added at once
    return grads, touched, np.add.reduceat(pairs.take(order, axis=0), begin, axis=0).view(np.float32)


def _by_id(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, an order of the places that brings equal ids together, and where each of them begins in it."""
    order = np.argsort(ids.astype(np.min_scalar_type(size)), kind="stable")  # numbers of two bytes are sorted by radix
    sorted_ = ids[order]
    begin = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    return sorted_[begin], order, begin
